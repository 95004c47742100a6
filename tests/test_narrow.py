"""Spark's forms of the chain tables: equal to the plain ones on odd rows, and no hash goes through a shuffle."""

import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomspark.plans.query import full_shape
from loomspark.sources import fixtures
from loomspark.sources.tables import scan, store

DATA = "/root/testdata/sf0.001"


def exchanges(df):
    """(name, whether a binary is among the columns) of each shuffle of the plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.initialPlan())
            continue
        if p.nodeName() == "Exchange":
            found.append((p.simpleString(50), any(p.output().apply(i).dataType().simpleString() == "binary" for i in range(p.output().size()))))
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return found


@pytest.fixture
def odd(spark, tmp_path):
    """Orders and lines with values that don't fit the packed form, nulls, and orders that come twice."""
    day = datetime.datetime(1996, 3, 1)
    orders = [(k, 7 * k, "FOP"[k % 3], 100.5 * k, day + datetime.timedelta(days=k % 4)) for k in range(12)] + [(3, 1, "F", 9.99, day), (None, 5, "O", 1.0, day), (20, None, "O", 2.0, day), (-4, -5, "F", 3.0, day)]
    usual = (5, 6, 1, 17.0, 1234.56, 0.05, 0.02, "N", "O", day)
    changed = [{}, {}, {3: 17.5}, {3: 5000.0}, {3: -2.0}, {4: 0.001}, {4: -7.25}, {4: 1e12}, {4: float("nan")}, {4: None}, {5: 0.055}, {5: 3.0}, {6: None}, {7: "NN"}, {7: None}, {8: ""}, {8: "F"}, {8: None}]
    changed += [{0: -21}, {0: None}, {0: 10**15}, {1: 2**40}, {1: -1}, {1: None}, {2: 7}, {2: 300}, {2: None}, {9: day + datetime.timedelta(hours=5)}, {9: None}, {9: datetime.datetime(1950, 1, 1)}, {3: 4095.0, 2: 255}, {3: None}]
    lines = [(k, *(c.get(i, v) for i, v in enumerate(usual))) for k in (*range(6), 3, 20, -4, None, 77) for c in changed]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    kinds = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("by_block", [False, True])
def test_odd_rows_are_those_of_the_plain_form(spark, odd, monkeypatch, by_block):
    got = fixtures.chain_tables(spark, odd, by_block=by_block)
    monkeypatch.setattr(fixtures, "NARROW", {})
    want = fixtures.chain_tables(spark, odd)
    for name in ("transactions", "logs", "traces"):
        assert got[name].schema.simpleString() == want[name].schema.simpleString()
        a, b = got[name], want[name]
        if name == "traces":  # the lines of an order that comes twice have no order of their own there
            a, b = (x.where(F.col("transaction_hash").isNull() | (F.col("transaction_hash") != F.unhex(F.sha2(F.lit(b"t3"), 256)))) for x in (a, b))
        assert b.count() > 10 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_no_hash_is_shuffled(spark):
    t = fixtures.chain_tables(spark, DATA)
    for name in ("transactions", "logs"):
        found = exchanges(t[name])
        assert found and not [x for x, wide in found if wide], found


def test_order_needs_one_range_of_narrow_rows(spark):
    found = [x for x in exchanges(entry.queries()["order_canonical"](spark, DATA)) if "rangepartitioning" in x[0]]
    assert len(found) == 1 and not found[0][1], found


def test_store_uses_the_ranges_that_are_there(spark, tmp_path):
    """A folder gets files from many tasks, each sorted by its block; rows that are dealt by block are not dealt again."""
    t = fixtures.chain_tables(spark, DATA, by_block=True)
    store({"logs": full_shape(t["logs"], "logs")}, str(tmp_path))
    back = scan(spark, str(tmp_path), "logs")
    assert back.drop("block_range").exceptAll(full_shape(t["logs"], "logs")).isEmpty() and back.count() == t["logs"].count()
    files = back.select("block_number", F.input_file_name().alias("f")).groupBy("f").agg(F.min("block_number").alias("a"), F.max("block_number").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(files[:-1], files[1:], strict=True))


def test_receipts_are_collected_where_their_rows_are(spark):
    found = exchanges(entry.queries()["ingest_rpc_logs"](spark, DATA))
    assert not [x for x, wide in found if wide], found

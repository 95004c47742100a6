"""Clustered tables: what the filters leave unread; keys that are found once; guards that don't pile up."""

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomspark.operators.filters import Filter
from loomspark.plans.query import ChainQuery
from loomspark.sources.clustered import manifest, scan_clustered, slices, store_clustered
from loomspark.streaming import follow
from test_streams import H, full


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Logs of 300 blocks, one of which holds as many as all others; slices of 2,000 rows in small row groups."""
    draw, path = random.Random(5), str(tmp_path_factory.mktemp("clustered"))
    sizes = {n: 20 for n in range(300)} | {150: 6000}
    rows = [{"block_number": n, "log_index": i, "transaction_hash": H(f"{n}-{i}"), "address": H(draw.randrange(40))[:20], "topic0": H(draw.randrange(3)), "topic1": H(f"x{draw.randrange(5000)}")} for n, k in sizes.items() for i in range(k)]
    logs = full(spark, "logs", rows)
    small = {"parquet.block.size": "4096", "parquet.page.size": "1024", "parquet.block.size.row.check.min": "50", "parquet.block.size.row.check.max": "50", "parquet.page.size.row.check.min": "50"}
    store_clustered({"logs": logs}, path, rows=2000, **{**small, "parquet.enable.dictionary": "false"})
    return path, logs, rows


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(f"{path}/logs") for f in names if f.endswith(".parquet")]


def rows_read(df) -> int:
    """Rows that the scan gave on, after row groups were left out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_slices_are_of_bounded_files(spark, stored):
    path, logs, rows = stored
    listed = manifest(spark, path, "logs").orderBy("slice").collect()
    assert sum(r.n_rows for r in listed) == len(rows)
    assert all(a.last_block < b.first_block for a, b in zip(listed[:-1], listed[1:], strict=True))
    assert max(pq.read_metadata(f).num_rows for f in files(path)) <= 4000 < max(r.n_rows for r in listed)
    assert scan_clustered(spark, path, "logs").exceptAll(logs).count() == 0 == logs.exceptAll(scan_clustered(spark, path, "logs")).count()


def test_range_reads_only_its_slices(spark, stored):
    path, logs, _ = stored
    for start, end in ((0, 40), (140, 160), (290, None), (40, 40), (900, 999)):
        df = scan_clustered(spark, path, "logs", start, end)
        want = logs.where((F.col("block_number") >= start) & (F.col("block_number") < (end if end is not None else 10_000)))
        assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    assert {f.split("slice=")[1].split("/")[0] for f in scan_clustered(spark, path, "logs", 0, 40).inputFiles()} <= {"0", *map(str, range(20))}
    assert rows_read(scan_clustered(spark, path, "logs", 0, 40).select("log_index", "block_number")) <= 2000


def test_address_reads_few_row_groups(spark, stored):
    path, logs, rows = stored
    query = ChainQuery(join_mode="nothing").where("logs", Filter("logs").where("address", [H(7)[:20]]))
    df = scan_clustered(spark, path, "logs").where(query.predicates()["logs"]).select("address", "log_index")
    groups = sum(pq.read_metadata(f).num_row_groups for f in files(path))
    assert groups > 3 * len(files(path)) and rows_read(df) < len(rows) / 4
    assert df.count() == sum(r["address"] == H(7)[:20] for r in rows)


def test_bloom_filters_leave_out_what_is_nowhere(spark, stored):
    path, _, rows = stored
    some = rows[4000]["transaction_hash"]
    read = lambda h: rows_read(scan_clustered(spark, path, "logs").where(F.col("transaction_hash") == F.lit(h)).select("log_index", "transaction_hash"))
    assert 1 <= read(some) < len(rows) / 4
    assert read(H("150-999999")) < len(rows) / 20  # between the bounds of row groups, in none of them


def test_hot_time_makes_more_slices(spark, stored):
    _, logs, rows = stored
    got = slices(logs, "logs", 500).groupBy("slice").agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).collect()
    assert all(r.n < 500 + 6000 and (r.n < 520 or r.blocks <= 26) for r in got) and sum(r.n for r in got) == len(rows)


@pytest.mark.parametrize("mode", ["default", "all", "nothing"])
def test_keys_are_found_once(spark, stored, tmp_path, mode):
    path, _, _ = stored
    tables = {"logs": spark.read.parquet(f"{path}/logs").drop("slice")}
    for name, rows in {
        "transactions": [{"block_number": n, "hash": H(f"{n}-{i}"), "transaction_index": i} for n in range(20) for i in range(9)],
        "traces": [{"block_number": n, "transaction_hash": H(f"{n}-{i}"), "type": "call"} for n in range(20) for i in range(9)],
        "blocks": [{"number": n, "hash": H(n)} for n in range(300)],
    }.items():
        full(spark, name, rows).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    query = ChainQuery(join_mode=mode).all_fields().where("logs", Filter("logs").where("address", [H(7)[:20]]))
    plain, kept = query.execute(tables), query.execute(tables, f"{tmp_path}/keys")
    for name, df in kept.tables.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, plain.tables[name].collect()))
    plan = kept.tables["transactions"]._jdf.queryExecution().optimizedPlan().toString()
    assert "topic0" not in plan  # no scan of logs
    kept.release()
    assert not os.path.exists(f"{tmp_path}/keys")


def test_guards_are_of_constant_number(spark, tmp_path):
    seen, broken = [], []
    for k in range(6):
        rows = [{"number": n, "hash": H(n), "parent_hash": H(n - 1), "timestamp": b"\x01"} for n in range(10 * k, 10 * k + 10)]
        if k == 4:
            rows = [dict(rows[0], parent_hash=H("other")), *rows[1:]]
        full(spark, "blocks", rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/blocks")
        follow.follow_with_guard(follow.stream_table(spark, f"{tmp_path}/blocks", "blocks"), lambda b, e: seen.append(e), lambda b, n: broken.append(n), f"{tmp_path}/checkpoint").awaitTermination()
    assert seen == list(range(6)) and broken == [39] and sorted(os.listdir(f"{tmp_path}/checkpoint/guards")) == ["epoch=4", "epoch=5"]

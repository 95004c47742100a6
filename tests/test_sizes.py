"""What queries write and evaluate, by count: once each."""

import glob
import os

import __spark_entry__ as entry
from loomspark import jobs_live
from loomspark.functions import abi
from loomspark.sources import fixtures
from loomspark.sources.clustered import store_clustered
from loomspark.plans.query import full_shape
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"


def test_calls_are_built_once(spark):
    plan = entry.queries()["decode_arrays"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("repeat(") <= 4, plan.count("repeat(")


def test_bound_layouts_keep_what_is_malformed_null(spark):
    """Calls with arrays of which some are cut, have wrong padding or another selector."""
    text = "send(address[] to, (uint256 amount, bool last)[] items, string note)"
    word = lambda n: n.to_bytes(32, "big")
    body = word(96) + word(160) + word(256) + word(1) + word(7) + word(1) + word(9) + word(1) + word(2) + b"ok".ljust(32, b"\0")
    selector = bytes(abi.parse_signature(text).selector)
    wrong = body[:128] + b"\xff" + body[129:]
    rows = [(0, selector + body), (1, selector + body[:-33]), (2, selector + wrong), (3, b"none" + body), (4, selector), (5, None), (6, b"ab")]
    df = spark.createDataFrame(rows, "i int, data binary")
    got = {r.i: r.c for r in df.select("i", abi.decode_input(F.col("data"), ["other(uint256 x)", text]).alias("c")).collect()}
    values = [p.value for p in got[0].params]
    assert got[0].function == "send" and values == [f"[0x{7:040x}]", f"[(0x{9:064x},true)]", "ok"]
    assert [got[i] for i in range(1, 7)] == [None] * 6


def test_filters_of_small_files_are_small(spark, tmp_path):
    logs = full_shape(fixtures.chain_tables(spark, DATA, by_block=True)["logs"], "logs")
    store_clustered({"logs": logs}, str(tmp_path), rows=500)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/logs/*/*.parquet")]
    assert sizes and max(sizes) < 500_000, max(sizes)


def test_arriving_files_are_written_once(spark):
    tables = fixtures.chain_tables(spark, DATA, by_block=True)
    path = jobs_live._arriving(spark, tables, "logs", "transactions").removeprefix("file://")
    left = [f for f in glob.glob(f"{os.path.dirname(path)}/whole-*/**/*.parquet", recursive=True)]
    assert not left
    for k, name in enumerate(("logs", "transactions")):
        files = sorted(glob.glob(f"{path}/{name}/*.parquet"), key=os.path.getmtime)
        order = list(dict.fromkeys(int(os.path.basename(f)[0]) for f in files))
        assert order == sorted(range(3), key=lambda p: (p + k) % 3)
        assert spark.read.parquet(f"{path}/{name}").count() == tables[name].count()

"""Streams with joins against the batch operators, and reorganisations against a list that is cut by hand."""

import random

import pytest
from pyspark.sql import functions as F

from loomspark.operators.filters import Filter
from loomspark.operators.joins import events
from loomspark.plans.query import ChainQuery
from loomspark.schema import SCHEMAS
from loomspark.streaming import joined, reorg

H = lambda x: bytes(str(x).ljust(32, "."), "ascii")


def full(spark, table, rows):
    kinds = {f.name: f.dataType for f in SCHEMAS[table]}
    names = list(rows[0])
    from pyspark.sql import types as T

    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], T.StructType([T.StructField(n, kinds[n]) for n in names]))
    return df.select(*((F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in SCHEMAS[table]))


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """Forty blocks; some logs without their transaction, one block that is missing; files in three orders."""
    draw, path = random.Random(1), str(tmp_path_factory.mktemp("chain"))
    blocks = [{"number": n, "hash": H(f"b{n}"), "parent_hash": H(f"b{n - 1}"), "timestamp": b"\x01", "miner": H(n % 3)[:20]} for n in range(40) if n != 17]
    txs = [{"block_number": n, "hash": H(f"t{n}-{i}"), "transaction_index": i, "from": H(i % 2)[:20], "value": b"\x05"} for n in range(40) for i in range(n % 4 + 1) if (n + i) % 7]
    logs = [{"block_number": n, "transaction_hash": H(f"t{n}-{i}"), "log_index": k, "block_hash": H(f"b{n}"), "address": H(k % 3)[:20], "topic0": H(k % 2)} for n in range(40) for k in range(5) for i in [draw.randrange(4)]]
    traces = [{"block_number": n, "transaction_hash": H(f"t{n}-{i}"), "type": "call", "from": H(n % 5)[:20]} for n in range(40) for i in range(4)]
    tables = {}
    for k, (name, rows) in enumerate({"blocks": blocks, "transactions": txs, "logs": logs, "traces": traces}.items()):
        number = "number" if name == "blocks" else "block_number"
        tables[name] = full(spark, name, rows)
        parts = [[r for r in rows if r[number] // 10 == p] for p in range(4)]
        for p in sorted(range(4), key=lambda p: (p * (k + 2) + k) % 5):
            full(spark, name, parts[p]).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        # A last file far ahead moves the clock, so that rows that nothing joins are given on.
        last = dict(rows[0]) | {number: 500} | ({"transaction_hash": H("none"), "topic0": H("none"), "from": H("none")[:20], "address": H("none")[:20]} if name != "blocks" else {})
        full(spark, name, [{c: last[c] for c in rows[0]}]).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
    return path, tables


def drained(stream, out):
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{out}/rows")


QUERY = ChainQuery(0, 400).where("logs", Filter("logs").where("address", [H(1)[:20]]))


def test_events_as_a_stream_are_those_of_the_tables(spark, chain, tmp_path):
    path, tables = chain
    fields = (["address", "log_index"], ["value"], ["timestamp"])
    got = drained(joined.stream_events(spark, path, QUERY, *fields, late=60, files=1), tmp_path)
    logs = tables["logs"].where(QUERY.predicates()["logs"])
    want = events(logs, tables["transactions"], tables["blocks"], *fields)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.where("transaction is null").count() > 0 < want.where("block is null").count()


@pytest.mark.parametrize("mode", ["default", "all", "nothing"])
@pytest.mark.parametrize("table", ["blocks", "transactions", "logs", "traces"])
def test_joins_as_a_stream_are_those_of_the_tables(spark, chain, tmp_path, mode, table):
    from dataclasses import replace

    path, tables = chain
    fields = {"blocks": ["number", "hash"], "transactions": ["hash", "from"], "logs": ["log_index", "block_number"], "traces": ["transaction_hash", "from"]}
    query = replace(QUERY, join_mode=mode, fields=fields).where("traces", Filter("traces").where("from", [H(4)[:20]]))
    want = query.execute(tables).tables[table]
    got = drained(joined.stream_joined(spark, path, query, table, late=60, files=2), tmp_path)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and (mode == "nothing" or want.count() > 0)


def test_what_has_no_streamed_form(spark, chain):
    with pytest.raises(ValueError):
        joined.stream_joined(spark, chain[0], QUERY.limit(logs=3), "logs")


def test_chain_of_pages():
    chain = reorg.Chain(depth=50)
    block = lambda n, b, p=None: (n, H(f"{b}{n}"), H(f"{p or b}{n - 1}"))
    chain.page([block(n, "a") for n in range(1, 11)])
    chain.page([block(n, "a") for n in range(9, 11)])  # again, in place
    assert len(chain.events) == 10
    chain.page([block(8, "x", "a"), block(9, "x")])
    assert [b[:2] for b in chain.blocks] == [(n, H(f"a{n}")) for n in range(1, 8)] + [(8, H("x8")), (9, H("x9"))]
    assert [e[0] for e in chain.events if e[3] is not None] == [10, 9, 8] and {e[4] for e in chain.events if e[3] is not None} == {7}
    chain.page([block(10, "y")])  # its parent y9 isn't there: x9 is of another branch
    assert [b[0] for b in chain.blocks] == [*range(1, 9), 10]
    chain.page([block(8, "a")] + [block(n, "a") for n in range(9, 13)])  # back to the first branch
    assert [b[1] for b in chain.blocks] == [H(f"a{n}") for n in range(1, 13)]
    chain.page([block(n, "a") for n in range(13, 100)])
    assert len(chain.blocks) == 50
    with pytest.raises(ValueError, match="deeper"):
        chain.page([block(3, "z", "a")])


def test_forks_end_in_the_winning_chain_also_after_restarts(spark, tmp_path):
    block = lambda n, b, p=None: {"number": n, "hash": H(f"{b}{n}"), "parent_hash": H(f"{p or b}{n - 1}")}
    pages = [
        [block(n, "a") for n in range(1, 21)],
        [block(15, "b", "a")] + [block(n, "b") for n in range(16, 23)],
        [block(12, "c", "a")] + [block(n, "c") for n in range(13, 24)],
        [block(n, "c") for n in range(20, 24)],
        [block(22, "d", "c")] + [block(n, "d") for n in range(23, 31)],
    ]
    for stops in ((1, 2, 3, 4, 5), (5,), (2, 5)):
        where, done = tmp_path / f"s{len(stops)}", 0
        logs = []
        for stop in stops:
            for page in pages[done:stop]:
                full(spark, "blocks", page).coalesce(1).write.mode("append").parquet(f"{where}/blocks")
                logs += [{"block_number": b["number"], "block_hash": b["hash"], "log_index": k} for b in page for k in (0, 1)]
            done = stop
            reorg.follow_chain(reorg.headers(spark, f"{where}/blocks"), f"{where}/events", f"{where}/checkpoint").awaitTermination()
        found = reorg.events_of(spark, f"{where}/events")
        got = sorted((r.number, bytes(r.hash)) for r in reorg.canonical(found).collect())
        want = [(n, H(f"{'a' if n < 12 else 'c' if n < 22 else 'd'}{n}")) for n in range(1, 31)]
        assert got == want
        assert sorted((r.fork_block, r.n_withdrawn) for r in reorg.forks(found).collect()) == [(11, 11), (14, 6), (21, 2)]
        rows = reorg.live(full(spark, "logs", logs), "logs", reorg.canonical(found)).select("block_number", "block_hash", "log_index").collect()
        assert sorted((r[0], bytes(r[1]), r[2]) for r in rows) == [(n, h, k) for n, h in want for k in (0, 1)]

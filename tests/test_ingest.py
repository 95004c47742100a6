"""Ingestion in one parse, and documents that go to quarantine."""

import json

import pytest
from pyspark.sql import functions as F

from loomspark.sources import ingest

H32, H20 = "0x" + "ab" * 32, "0x" + "cd" * 20
LOG = {"address": H20, "topics": [H32, H32], "data": "0x0102", "blockNumber": "0x10", "transactionHash": H32, "transactionIndex": "0x1", "blockHash": H32, "logIndex": 3, "removed": False}
TX = {"blockHash": H32, "blockNumber": "0x10", "from": H20, "gas": "0x5208", "hash": H32, "input": "0xa9059cbb00", "nonce": "0x1", "to": None, "transactionIndex": 0, "value": "0x0", "type": "0x2", "accessList": [{"address": H20, "storageKeys": [H32]}], "extra": {"a": 1}}


def docs(spark, *rows):
    return spark.createDataFrame([(i, r if r is None or isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)], "i int, json string")


def reasons(spark, table, *rows):
    good, bad = ingest.sorted_out(docs(spark, *rows), table)
    found = {r.i: list(r.reasons) for r in bad.collect()}
    assert sorted([r.i for r in good.collect()] + list(found)) == list(range(len(rows)))
    return [found.get(i) for i in range(len(rows))]


def test_logs_that_fit_and_others(spark):
    without = {k: v for k, v in LOG.items() if k != "data"}
    got = reasons(
        spark, "logs", LOG, None, "", "{", "[]", without, LOG | {"address": "0xzz"}, LOG | {"topics": [H32] * 5}, LOG | {"topics": [H32 + "00"]}, LOG | {"topics": "none"},
        LOG | {"logIndex": "0x" + "f" * 20, "address": None}, LOG | {"topics": []}, LOG | {"data": {"a": 1}},
    )
    assert got[0] is None and got[11] is None
    assert all(got[i] == ["not a document"] for i in (1, 2, 3, 9))
    assert got[4] is not None and got[5] == ["missing: data"] and got[6] == ["malformed: address"]
    assert got[7] == ["topics: 5"] and got[8] == ["malformed: topic0"] and sorted(got[10]) == ["malformed: log_index", "missing: address"]
    assert got[12] == ["malformed: data"]


def test_transactions_blocks_and_traces(spark):
    assert reasons(spark, "transactions", TX, TX | {"type": "0x1ff"}, TX | {"value": -1}) == [None, ["malformed: type"], ["malformed: value"]]
    trace = {"action": {"from": H20, "callType": "call", "input": "0x"}, "result": {"output": "0x"}, "blockHash": H32, "blockNumber": 16, "type": "call", "traceAddress": [0, 1]}
    assert reasons(spark, "traces", trace, trace | {"action": "x"}, {k: v for k, v in trace.items() if k != "blockHash"}) == [None, ["not a document"], ["missing: block_hash"]]
    assert reasons(spark, "blocks", {"number": "0x1"})[0][:1] == ["missing: hash"]


def test_rows_of_what_fits(spark):
    good, _ = ingest.sorted_out(docs(spark, LOG, "{", LOG | {"removed": True}), "logs")
    rows = ingest.rpc_logs(good).collect()
    assert [(r.removed, r.log_index, bytes(r.data), r.topic2) for r in rows] == [(False, 3, b"\x01\x02", None), (True, 3, b"\x01\x02", None)]
    tx = ingest.rpc_transactions(docs(spark, TX)).first()
    assert bytes(tx.sighash).hex() == "a9059cbb" and tx.to is None and tx.type == 2 and len(tx.access_list[0].storage_keys) == 1
    with pytest.raises(Exception, match="not 20 bytes"):
        ingest.rpc_logs(docs(spark, LOG | {"address": "0xzz"})).collect()


@pytest.mark.parametrize("reader", ["rpc_blocks", "rpc_transactions", "rpc_receipts", "rpc_logs", "rpc_traces"])
def test_one_parse_in_the_plan(spark, reader):
    plan = getattr(ingest, reader)(docs(spark)).where(F.col("block_hash" if reader not in ("rpc_blocks", "rpc_receipts") else "logs_bloom").isNotNull())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1 and "get_json_object" not in text


def test_revert_reason_of_a_call(spark):
    call = {"type": "CALL", "from": H20, "to": H20, "revertReason": "no", "calls": [{"type": "CALL", "from": H20, "error": "out of gas", "revertReason": "x"}]}
    df = docs(spark, call).selectExpr("1L AS block_number", "unhex('aa') AS block_hash", "unhex('bb') AS transaction_hash", "0L AS transaction_position", "json")
    assert sorted(r.error for r in ingest.debug_traces(df).select("error").collect()) == ["no", "out of gas"]

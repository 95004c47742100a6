"""Decoding by many signatures: one decoder for each layout, names from the catalog."""

import pytest
from pyspark.sql import functions as F

from loomspark.functions import abi

WORD = lambda n: n.to_bytes(32, "big")
KINDS = ["uint256 a, address indexed b", "address indexed c, address indexed d, uint256 e", "bytes32 f, bool g", "uint8[] h"]


def logs(spark, rows):
    return spark.createDataFrame(rows, "i int, topic0 binary, topic1 binary, topic2 binary, topic3 binary, data binary")


def hash_of(text: str) -> bytes:
    return bytes(abi.parse_signature(text).hash)


def test_a_thousand_signatures_share_four_decoders(spark):
    many = [f"Event{i}({KINDS[i % 4]})" for i in range(1000)]
    rows, layouts = abi.event_catalog(many)
    assert len(rows) == 1000 and len(layouts) == 4
    address = WORD(0xABCD)
    df = logs(
        spark,
        [
            (0, hash_of(many[0]), address, None, None, WORD(7)), (1, hash_of(many[997]), address, address, None, WORD(8)), (2, hash_of(many[502]), None, None, None, WORD(9) + WORD(1)),
            (3, hash_of(many[3]), None, None, None, WORD(32) + WORD(2) + WORD(4) + WORD(5)), (4, hash_of(many[0]), None, None, None, WORD(7)), (5, b"x" * 32, None, None, None, b""), (6, None, None, None, None, b""),
        ],
    )
    found = abi.decode_events(df, many)
    assert found.columns == [*df.columns, "event", "params"]
    got = {r.i: (r.event, [(p.name, p.value) for p in r.params] if r.params else None) for r in found.collect()}
    short = "0x" + address[12:].hex()
    assert got[0] == ("Event0", [("b", short), ("a", "0x" + WORD(7).hex())])
    assert got[1] == ("Event997", [("c", short), ("d", short), ("e", "0x" + WORD(8).hex())])
    assert got[2] == ("Event502", [("f", "0x" + WORD(9).hex()), ("g", "true")]) and got[3][0] == "Event3" and got[3][1][0][0] == "h"
    assert got[4] == got[5] == got[6] == (None, None)  # another number of topics, unknown, no topics
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Event997" not in plan and plan.count("CASE WHEN") < 100


def test_first_of_equal_signatures_counts_and_none_at_all(spark):
    df = logs(spark, [(0, hash_of("A(uint256 x)"), None, None, None, WORD(1))])
    assert [p.name for p in abi.decode_events(df, ["A(uint256 x)", "A(uint256 y)"]).first().params] == ["x"]
    none = abi.decode_events(df, []).first()
    assert none.event is None and none.params is None


def test_lenient_decoding_keeps_what_can_be_read(spark):
    text = "T(address indexed from, address indexed to, uint256 n)"
    bad = b"\xff" + WORD(5)[1:]
    df = logs(spark, [(0, hash_of(text), bad, WORD(6), None, WORD(1)), (1, hash_of(text), WORD(5), WORD(6), None, b"\x01"), (2, hash_of(text), WORD(5), None, None, WORD(2))])
    got = {r.i: r for r in abi.decode_logs(df, text, ("i",), strict=False).collect()}
    assert got[0]["from"] is None and got[0].n is not None and got[1].n is None and got[1].to is not None and got[2].to is None
    with pytest.raises(Exception, match="topic is not a"):
        abi.decode_logs(df, text, strict=True).select(F.count("from")).collect()

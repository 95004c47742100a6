"""Casts of 256-bit numbers against Python's integers."""

import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import cast


def words(n: int) -> list[bytes]:
    draw = random.Random(7)
    out = []
    for _ in range(n):
        bits = draw.randint(0, 255)
        x = draw.getrandbits(bits) if bits else 0
        if draw.random() < 0.3 and bits > 60:  # close to a tie
            x = (x >> (bits - 54) << (bits - 54)) + draw.choice((-1, 0, 1)) * draw.choice((0, 1, 1 << draw.randrange(bits - 54)))
        out.append((x if draw.random() < 0.5 else -x).to_bytes(32, "big", signed=True))
    edges = [0, 1, -1, 69, -69, (1 << 63) - 1, -(1 << 63), 1 << 126, -(1 << 126), (1 << 255) - 1, -(1 << 255), 10**76, 10**76 - 1, -(10**76), -(10**76) + 1, 10**38, 10**38 - 1, 1 << 128, (1 << 128) - (1 << 103), 1 << 32, -(1 << 64), -(1 << 224)]
    return out + [x.to_bytes(32, "big", signed=True) for x in edges] + [b"", b"\x00", b"\xff", b"\xff" * 31, b"\x80" + b"\0" * 16]


def value(b: bytes) -> int:
    return int.from_bytes(b, "big", signed=len(b) == 32)


def nearest_float(x: int) -> float:
    """The nearest 32-bit float by exact comparison; ties to even, infinite beyond the range."""
    if abs(x) >= (1 << 128) - (1 << 103):
        return float("inf") if x > 0 else float("-inf")
    near = struct.unpack("f", struct.pack("f", min(abs(float(x)), 3.4028234663852886e38)))[0]
    code = struct.unpack("I", struct.pack("f", near))[0]
    options = [(abs(Fraction(f) - abs(x)), c % 2, f) for c in (code - 1, code, code + 1) if c >= 0 and (f := struct.unpack("f", struct.pack("I", c))[0]) < float("inf")]
    return min(options)[2] * (1 if x >= 0 else -1)


@pytest.fixture(scope="module")
def frame(spark):
    rows = words(10_000)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(rows)], "i int, b binary").repartition(4)
    return rows, df


def collected(df, column):
    return dict(df.select("i", column.alias("x")).collect())


def test_text_of_any_number(frame):
    rows, df = frame
    got = collected(df, cast.int_text(F.col("b")))
    assert all(got[i] == str(value(b)) for i, b in enumerate(rows))


def test_doubles_and_floats_are_rounded_once(frame):
    rows, df = frame
    got = collected(df, cast.map_column(F.col("b"), T.BinaryType(), "float64"))
    assert [i for i, b in enumerate(rows) if got[i] != float(value(b))] == []
    got = collected(df, cast.map_column(F.col("b"), T.BinaryType(), "float32"))
    assert [i for i, b in enumerate(rows) if got[i] != nearest_float(value(b))] == []


def test_decimals_of_76_digits(frame):
    rows, df = frame
    got = collected(df, cast.decimal256(F.col("b")))
    for i, b in enumerate(rows):
        x = value(b)
        assert got[i] is None if abs(x) >= 10**76 else int(got[i].high) * 10**38 + int(got[i].low) == x
    got = collected(df, cast.map_column(F.col("b"), T.BinaryType(), "decimal256", "permissive"))
    assert all(got[i] == (None if abs(value(b)) >= 10**76 else str(value(b))) for i, b in enumerate(rows))
    with pytest.raises(Exception, match="out of range of decimal256"):
        df.select(cast.map_column(F.col("b"), T.BinaryType(), "decimal256", "strict", "b")).collect()


def test_decimal128_and_nulls(frame, spark):
    rows, df = frame
    got = collected(df, cast.decimal128(F.col("b")))
    for i, b in enumerate(rows):
        x = value(b)
        assert got[i] is None if not -(1 << 126) <= x < 1 << 126 or not b else int(got[i]) == x
    none = spark.createDataFrame([(None,)], "b binary").select(*(cast.map_column(F.col("b"), T.BinaryType(), t) for t in cast.TARGETS)).first()
    assert list(none) == [None] * len(cast.TARGETS)


def test_no_python_in_the_plan(frame):
    _, df = frame
    plan = df.select(*(cast.map_column(F.col("b"), T.BinaryType(), t, "permissive").alias(t) for t in cast.TARGETS))
    assert "Python" not in plan._jdf.queryExecution().toString()

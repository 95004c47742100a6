"""Values in hex text against plain Python, good ones and bad ones."""

import re

import pytest
from pyspark.sql import functions as F

from loomspark.functions import values as V

TEXTS = [
    None, "", "0x", "0x0", "0x00", "0x1", "0x01", "0x0f0", "0xABC", "0xabcd", "0xzz", "0xz", "0x1 ", "0x1\n", "12", "12\n", "007", "-1", "0x-1", "0X1", "x",
    "0x" + "0" * 40, "0x" + "0" * 39 + "1", "0x" + "f" * 40, "0x" + "f" * 41, "0x0" + "f" * 40, "0x" + "0" * 50, "0x" + "g" * 40,
    "0x" + "f" * 16, "0x7" + "f" * 15, "0x0007" + "f" * 15, "0x1" + "0" * 16, str(2**63 - 1), str(2**63), "0x" + "ab" * 5000,
]


def digits(s):
    return s[2:] if s is not None and re.fullmatch(r"0x[0-9a-fA-F]*", s) else None


def even(d):
    return bytes.fromhex("0" * (len(d) % 2) + d)


def data(s):
    return None if (d := digits(s)) is None else even(d)


def fixed(s):
    d = digits(s)
    return None if d is None or len(d.lstrip("0")) > 40 else even(d.lstrip("0").rjust(40, "0"))


def quantity(s):
    return even(d.lstrip("0") or "0") if (d := digits(s)) else None


def number(s):
    if s is not None and re.fullmatch(r"[0-9]+", s) and int(s) < 2**63:
        return even(f"{int(s):x}")
    return quantity(s)


def uint64(s):
    return int(d, 16) if (d := digits(s)) and int(d, 16) < 2**63 else None


CASES = {
    "data": (V.hex_to_data, data), "fixed": (lambda c, strict: V.hex_to_fixed(c, 20, strict), fixed), "quantity": (V.hex_to_quantity, quantity),
    "number": (V.number_to_quantity, number), "uint64": (V.hex_to_uint64, uint64),
}


def test_lenient_values(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(TEXTS)], "i int, s string")
    for name, (column, plain) in CASES.items():
        rows = df.select("i", column(F.col("s"), False).alias("x")).collect()
        got = {r.i: bytes(r.x) if isinstance(r.x, bytearray) else r.x for r in rows}
        assert [got[i] for i in range(len(TEXTS))] == [plain(s) for s in TEXTS], name


def test_strict_values(spark):
    for name, (column, plain) in CASES.items():
        good = [s for s in TEXTS if s is None or plain(s) is not None]
        df = spark.createDataFrame([(s,) for s in good], "s string").select("s", column(F.col("s"), True).alias("x"))
        got = {r.s: bytes(r.x) if isinstance(r.x, bytearray) else r.x for r in df.collect()}
        assert got == {s: plain(s) if s is not None else None for s in good}, name
        with pytest.raises(Exception, match="not a|not hex|not 20"):
            spark.createDataFrame([("0xzz",)], "s string").select(column(F.col("s"), True)).collect()

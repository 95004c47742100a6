"""Casts of 256-bit numbers and hex output, by native expressions.

A binary of 32 bytes is read as two's complement, a shorter one as positive. Numbers up to 126 bits are put together from
32-bit limbs as decimal(38,0). Wider ones become decimal text: each limb times the digits of its power of two, summed by
column, and one pass of carries; floating-point numbers are read from that text, which rounds once. In strict mode what
doesn't fit is an error, in permissive mode it is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB = 1 << 32
#: Digits of one column of the decimal text, and columns: 80 digits hold 256 bits. Eight limbs times a column of digits
#: stay below 63 bits.
DIGITS, COLUMNS = 8, 10
#: Digits of the widest decimal target, of which Spark's own decimal holds half.
WIDE, HALF = 76, 38


def bound(value: Column, use) -> Column:
    """`use(value)`, with the value computed once however often `use` takes it."""
    return F.transform(F.array(value), use)[0]


def decimal128(c: Column) -> Column:
    """decimal(38,0), or null where the number doesn't fit in 126 bits and a sign, or there are no bytes. Plain
    expressions over the four lower limbs, for generated code; the others are all zeros or, in a negative number, ones."""
    digits = F.lpad(F.hex(c), 64, "0")
    head = F.substring(digits, 1, 32)
    minus = (F.length(c) == 32) & (head == "F" * 32)
    raw = [F.conv(F.substring(digits, 33 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    limbs = [F.when(minus, F.lit(LIMB - 1) - x).otherwise(x) for x in raw]
    parts = [(x.cast("decimal(10,0)") * F.lit(str(1 << (32 * (3 - i)))).cast("decimal(38,0)")).cast("decimal(38,0)") for i, x in enumerate(limbs)]
    size = parts[0]
    for part in parts[1:]:
        size = (size + part).cast("decimal(38,0)")
    # A decimal's own minus sign rounds to 34 digits; a difference is exact.
    below = (F.lit(-1).cast("decimal(38,0)") - size).cast("decimal(38,0)")
    fits = (minus | (head == "0" * 32)) & (limbs[0] < 1 << 30) & (F.length(c) > 0)
    return F.when(fits, F.when(minus, below).otherwise(size))


def _wide_text(c: Column) -> Column:
    """The decimal text of any number, by columns of DIGITS digits; a negative number is its complement and one more."""
    base = 10**DIGITS

    def limbs(digits: Column) -> Column:
        minus = (F.length(c) == 32) & (F.substring(digits, 1, 1) >= "8")
        size = F.when(minus, F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(digits)
        return bound(F.struct(minus.cast("bigint").alias("minus"), size.alias("size")), numbers)

    def numbers(x: Column) -> Column:
        parts = [F.conv(F.substring(x["size"], 57 - 8 * i, 8), 16, 10).cast("bigint").alias(f"l{i}") for i in range(8)]
        return bound(F.struct(x["minus"].alias("minus"), *parts), text)

    def text(x: Column) -> Column:
        columns = []
        for j in range(COLUMNS):
            total = x["minus"] if j == 0 else F.lit(0).cast("bigint")
            for i in range(8):
                if digits := (1 << 32 * i) // base**j % base:
                    total = total + x[f"l{i}"] * F.lit(digits).cast("bigint")
            columns.append(total)
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit("").alias("text"))
        digits = F.ltrim(F.aggregate(F.array(*columns), start, carried)["text"], F.lit("0"))
        return F.concat(F.when(x["minus"] == 1, F.lit("-")).otherwise(F.lit("")), F.when(digits == "", F.lit("0")).otherwise(digits))

    def carried(acc: Column, total: Column) -> Column:
        def cut(now: Column) -> Column:
            digits = F.lpad((now % base).cast("string"), DIGITS, "0")
            return F.struct(F.call_function("div", now, F.lit(base)).alias("carry"), F.concat(digits, acc["text"]).alias("text"))

        return bound(total + acc["carry"], cut)

    return F.when(c.isNotNull(), bound(F.lpad(F.hex(c), 64, "0"), limbs))


def int_text(c: Column) -> Column:
    """The decimal text of any number; of no bytes "0"."""
    return F.coalesce(decimal128(c).cast("string"), _wide_text(c))


def decimal256(c: Column) -> Column:
    """struct(high, low) of decimal(38,0), the number being high * 10^38 + low and both of its sign; null beyond 76 digits."""

    def parts(text: Column) -> Column:
        sign, digits = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), F.ltrim(text, F.lit("-"))
        size = F.length(digits)
        high = F.when(size > HALF, F.substring(digits, F.lit(1), size - HALF)).otherwise(F.lit("0"))
        low = F.when(size > HALF, F.substring(digits, size - HALF + 1, F.lit(HALF))).otherwise(digits)
        pair = [F.concat(sign, x).cast("decimal(38,0)").alias(n) for x, n in ((high, "high"), (low, "low"))]
        return F.when(size <= WIDE, F.struct(*pair))

    return F.when(c.isNotNull(), bound(int_text(c), parts))


def _rounded(c: Column, kind: str) -> Column:
    """The nearest float or double, ties to even, by one rounding; a float beyond its range is infinite."""
    return F.coalesce(decimal128(c).cast(kind), _wide_text(c).cast(kind))


_RANGES = {
    "uint64": (0, (1 << 64) - 1, "decimal(20,0)"),
    "uint32": (0, (1 << 32) - 1, "bigint"),
    "int64": (-(1 << 63), (1 << 63) - 1, "bigint"),
    "int32": (-(1 << 31), (1 << 31) - 1, "int"),
}
TARGETS = ("float64", "float32", "uint64", "uint32", "int64", "int32", "intstr", "decimal256", "decimal128")


def map_column(c: Column, kind: T.DataType, target: str, mode: str = "strict", name: str = "") -> Column:
    """One column to one of TARGETS; sources are binary and bigint, anything else is an error."""
    if target not in TARGETS:
        raise ValueError(f"unknown type {target!r}")
    if name == "l1_fee_scalar":
        number = F.decode(c, "utf-8").cast("double")
        return number.cast("float") if target == "float32" else number if target == "float64" else number.cast(
            {"intstr": "string", "decimal256": "string", "decimal128": "decimal(38,0)"}.get(target)
            or _RANGES[target][2]
        )
    binary = isinstance(kind, T.BinaryType)
    if not binary and not isinstance(kind, T.LongType):
        raise TypeError(f"{name}: a {kind.simpleString()} column can't be mapped to {target}")
    if target in ("intstr", "decimal256"):
        if not binary:
            raise TypeError(f"{name}: only binary columns map to {target}")
        text = int_text(c)
        if target == "intstr":
            return text
        fits = lambda x: F.length(F.ltrim(x, F.lit("-"))) <= WIDE
        return F.when(c.isNotNull(), bound(text, lambda x: F.when(fits(x), x).otherwise(_misfit(mode, name, target).cast("string"))))
    if target in ("float64", "float32"):
        kind_to = "double" if target == "float64" else "float"
        return _rounded(c, kind_to) if binary else c.cast(kind_to)
    number = decimal128(c) if binary else c.cast("decimal(38,0)")
    if target in _RANGES:
        low, high, kind_to = _RANGES[target]
        number = F.when(
            (number >= F.lit(str(low)).cast("decimal(38,0)")) & (number <= F.lit(str(high)).cast("decimal(38,0)")),
            number,
        ).cast(kind_to)
    return F.when(c.isNull(), F.lit(None)).when(number.isNull(), _misfit(mode, name, target)).otherwise(number)


def _misfit(mode: str, name: str, target: str) -> Column:
    return F.raise_error(F.lit(f"{name}: out of range of {target}")) if mode == "strict" else F.lit(None)


def column_mapping(df: DataFrame, mapping: dict[str, str], mode: str = "strict") -> DataFrame:
    """Map the named columns; others pass, unknown names are ignored."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {n: map_column(F.col(f"`{n}`"), kinds[n], t, mode, n) for n, t in mapping.items() if n in kinds}
    )


def _hex(c: Column, kind: T.DataType, prefix: str) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit(prefix), F.lower(F.hex(c)))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _hex(x, kind.elementType, prefix)) if _has_binary(kind) else c
    if isinstance(kind, T.StructType) and _has_binary(kind):
        return F.when(c.isNotNull(), F.struct(*(_hex(c[f.name], f.dataType, prefix).alias(f.name) for f in kind)))
    return c


def _has_binary(kind: T.DataType) -> bool:
    return isinstance(
        kind, T.BinaryType
    ) or isinstance(kind, T.ArrayType) and _has_binary(kind.elementType) or isinstance(
        kind, T.StructType
    ) and any(
        _has_binary(f.dataType) for f in kind
    )


def hex_output(df: DataFrame, mode: str = "prefixed") -> DataFrame:
    """All binary columns, nested ones too, as lower-case hex: `prefixed` (0x…), `non_prefixed`, or `none` (unchanged)."""
    if mode not in ("prefixed", "non_prefixed", "none"):
        raise ValueError(f"unknown hex mode {mode!r}")
    if mode == "none":
        return df
    return df.select(
        *(_hex(F.col(f"`{f.name}`"), f.dataType, "0x" if mode == "prefixed" else "").alias(f.name) for f in df.schema)
    )

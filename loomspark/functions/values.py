"""Values of the chain as Column functions: hex text to bytes and back, numbers, statuses, lists of hashes.

Each takes and gives Columns. In strict use a bad value raises; with strict=False it becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: str | bytes, size: int | None = None) -> bytearray:
    """A filter value: bytes, or 0x hex text, of exactly `size` bytes."""
    if isinstance(value, str):
        if not value.startswith("0x"):
            raise ValueError(f"{value!r} has no 0x prefix")
        value = bytes.fromhex(value[2:])
    if size is not None and len(value) != size:
        raise ValueError(f"{len(value)} bytes, expected {size}")
    return bytearray(value)


def _checked(value: Column, source: Column, what: str, strict: bool) -> Column:
    """The value; where it is null though the source isn't, an error in strict use. It is computed once."""
    if not strict:
        return value
    return F.coalesce(value, F.when(source.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: "), source.cast("string")))))


def _digits(c: Column) -> Column:
    """What stands behind 0x; null without it. (`unhex` is null for other digits and fills up an odd number of them.)"""
    return F.when(c.startswith("0x"), F.substring(c, 3, 1 << 30))


def _minimal(c: Column) -> Column:
    """Hex digits without leading zeros, of which the last stays; null for none at all."""
    digits = F.ltrim(_digits(c), F.lit("0"))
    return F.when(F.length(c) > 2, F.when(digits == "", F.lit("0")).otherwise(digits))


def hex_to_quantity(c: Column, strict: bool = True) -> Column:
    """0x text -> big-endian bytes without leading zero bytes; zero is one zero byte; bare 0x is an error."""
    return _checked(F.unhex(_minimal(c)), c, "not a quantity", strict)


def number_to_quantity(c: Column, strict: bool = True) -> Column:
    """Text of a JSON value, 0x hex or a decimal integer -> quantity; negative numbers are an error."""
    plain = F.unhex(F.hex(F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("bigint"))))
    return _checked(F.when(c.startswith("0x"), hex_to_quantity(c, False)).otherwise(plain), c, "not a quantity", strict)


def quantity_to_hex(c: Column) -> Column:
    """Minimal digits; zero is 0x0."""
    return F.concat(F.lit("0x"), F.regexp_replace(F.lower(F.hex(c)), "^0+(?=.)", ""))


def hex_to_data(c: Column, strict: bool = True) -> Column:
    """0x text -> bytes; 0x is empty."""
    return _checked(F.unhex(_digits(c)), c, "not hex data", strict)


def hex_to_fixed(c: Column, size: int, strict: bool = True) -> Column:
    """0x text -> exactly `size` bytes; another length loses leading zeros and is padded, a longer value is an error."""
    digits = F.ltrim(_digits(c), F.lit("0"))
    padded = F.when(F.length(digits) <= 2 * size, F.lpad(digits, 2 * size, "0"))
    exact = F.when(F.length(c) == 2 * size + 2, _digits(c)).otherwise(padded)
    return _checked(F.unhex(exact), c, f"not {size} bytes", strict)


def hex_to_uint64(c: Column, strict: bool = True) -> Column:
    """0x text -> bigint; beyond 63 bits an error."""
    digits = F.when(c.rlike(r"^0x[0-9a-fA-F]+\z"), F.ltrim(_digits(c), F.lit("0")))
    number = F.when(F.length(digits) <= 16, F.conv(F.concat(F.lit("0"), digits), 16, 10))
    return _checked(number.try_cast("bigint"), c, "not a 64-bit integer", strict)


def tx_status(c: Column, strict: bool = True) -> Column:
    """0x1, 0x0, 1 or 0 -> smallint."""
    return _checked(
        F.when(c.isin("0x1", "1"), 1).when(c.isin("0x0", "0"), 0).cast("smallint"), c, "not a status", strict
    )


def tx_type(c: Column, strict: bool = True) -> Column:
    """0x text -> smallint within one byte."""
    n = hex_to_uint64(c, False)
    return _checked(F.when(n <= 255, n).cast("smallint"), c, "not a transaction type", strict)


def split_hashes(c: Column, strict: bool = True) -> Column:
    """Concatenated 32-byte hashes -> array; a short last one is an error."""
    n = (F.length(c) / 32).cast("int")
    parts = F.when(F.length(c) == 0, F.array().cast("array<binary>")).otherwise(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(c, i * 32 + 1, F.lit(32)))
    )
    return _checked(F.when(F.length(c) % 32 == 0, parts), F.hex(c), "not whole hashes", strict)


def address_to_topic(c: Column) -> Column:
    """An address padded to 32 bytes, as topics hold it."""
    return F.lpad(c, 32, bytes(1))

"""Block-aligned limits, order, ranges and page metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspark.schema import BLOCK_COLUMN, ORDER, RANGE

#: Blocks whose counts are summed in one window of the prefix sum.
BUCKET = 1000


def blocks_within(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Block numbers to keep so that a block goes only when the rows of the blocks before it reach the limit.

    The prefix sum has two levels, sums of buckets and then blocks within a bucket, so that no window holds all blocks."""
    counts = (
        df.groupBy(F.col(column).alias("n")).agg(F.count("*").alias("c")).withColumn("b", F.floor(F.col("n") / BUCKET))
    )
    sums = counts.groupBy("b").agg(F.sum("c").alias("s"))
    before = sums.select(
        "b",
        F.coalesce(F.sum("s").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("base"),
    )
    inside = F.coalesce(
        F.sum("c").over(Window.partitionBy("b").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        counts.join(before, "b")
        .withColumn("seen", F.col("base") + inside)
        .where(F.col("seen") < limit)
        .select(F.col("n").alias(column))
    )


def limit_blocks(tables: dict, limits: dict, start: int, end: int) -> tuple[dict, int | None]:
    """Cut all tables after the block where a table's limit was reached; the last block kept, or None without a cut.

    Counts go over ranges of blocks from `start` on, each twice as long as the one before, and end where the limit is
    reached: what lies behind is neither read nor counted. The driver reads one row a range.
    """
    cuts = [
        c
        for t, n in limits.items()
        if n is not None and (c := _cut(tables[t], BLOCK_COLUMN[t], n, start, end)) is not None
    ]
    if not cuts:
        return tables, None
    last = min(cuts)
    return {t: within(df, BLOCK_COLUMN[t], start, last + 1) for t, df in tables.items()}, last


def within(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    """Blocks of [start, end), by the block column and, in a stored table, by the folders of ranges."""
    kept = (F.col(column) >= start) & (F.col(column) < end)
    return df.where(
        kept & F.col("block_range").between(start // RANGE, max(0, end - 1) // RANGE)
        if "block_range" in df.columns
        else kept
    )


def _cut(df: DataFrame, column: str, limit: int, start: int, end: int) -> int | None:
    """The last block to keep, or None when the table has fewer rows than the limit."""
    low, step, left = start, RANGE, limit
    while low < end:
        high = min(low + step, end)
        part = within(df, column, low, high)
        n = part.count()
        if n >= left:
            return blocks_within(part, column, left).agg(F.max(column)).first()[0] if left > 0 else low - 1
        low, step, left = high, 2 * step, left - n
    return None


def ordered(df: DataFrame, table: str, reverse: bool = False) -> DataFrame:
    """Rows in the total order of their table, or its exact mirror."""
    return df.orderBy(*((F.col(c).desc() if reverse else F.col(c).asc()) for c in ORDER[table] if c in df.columns))


def row_counts(tables: dict) -> DataFrame:
    return reduce(
        DataFrame.union,
        (df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), "n") for t, df in tables.items()),
    )


def reduce_pages(pages: DataFrame) -> DataFrame:
    """Page metadata folded: height of the last page, next block, summed time."""
    return pages.agg(
        F.max_by("archive_height", "next_block").alias("archive_height"),
        F.max("next_block").alias("next_block"),
        F.sum("total_execution_time").alias("total_execution_time"),
    )


def split_range(spark: SparkSession, start: int, end: int, step: int, reverse: bool = False) -> DataFrame:
    """[start, end) cut into steps, the last one short; descending ranges are cut from the end."""
    ids = spark.range(start, end, step)
    if reverse:
        return ids.select(
            F.greatest(F.lit(end) - (F.col("id") - start) - step, F.lit(start)).alias("from_block"),
            (F.lit(end) - (F.col("id") - start)).alias("to_block"),
        )
    return ids.select(F.col("id").alias("from_block"), F.least(F.col("id") + step, F.lit(end)).alias("to_block"))

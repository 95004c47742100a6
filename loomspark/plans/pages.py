"""Pages of a query: its range cut at the blocks where a limit is reached, a log of them, and the loop over it.

The rows of the result are counted by block in one pass over each table. Where a page ends depends on where the one
before did, so the cut itself goes over the counts (a few numbers a block) in order, in steps of a bounded number of
blocks: a step is one task, takes up the open page of the step before, and writes its pages; the driver handles one row
a step, and never the log.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from loomspark.plans.query import ChainQuery, ChainResult
from loomspark.schema import BLOCK_COLUMN, SCHEMAS
from loomspark.sinks import shared_folder

#: Blocks of one step of the cut.
STEP = 1_000_000
COUNTS = [f"n_{t}" for t in SCHEMAS]
LOG = "from_block bigint, next_block bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)


def block_counts(tables: dict) -> DataFrame:
    """(number, n_blocks, n_transactions, n_logs, n_traces) of the blocks that have rows in any of the tables."""
    rows = None
    for t, df in tables.items():
        one = df.groupBy(F.col(BLOCK_COLUMN[t]).alias("number")).agg(F.count("*").alias("n")).select(
            "number", *(F.when(F.lit(t == x), F.col("n")).otherwise(0).alias(f"n_{x}") for x in SCHEMAS)
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("number").agg(*(F.sum(c).alias(c) for c in COUNTS))


def cut(numbers: np.ndarray, counts: np.ndarray, limits: list, start: int, held: list[int]) -> Iterator[tuple]:
    """(from_block, next_block, counts) of pages over blocks in order; the last one is open and has no next block.

    `held` are the counts of the page that begins at `start`, from blocks before these. A page ends with the block at
    which one of the limits (None: no limit) is reached.
    """
    sums = counts.cumsum(0)
    base, at, n = -np.array(held, np.int64), 0, len(numbers)
    while True:
        ends = [np.searchsorted(sums[:, i], base[i] + limit) for i, limit in enumerate(limits) if limit is not None]
        end = max(at, min(ends, default=n))
        if end >= n:
            last = sums[-1] if n else np.zeros(len(limits), np.int64)
            yield start, None, (last - base).tolist()
            return
        yield start, int(numbers[end]) + 1, (sums[end] - base).tolist()
        start, base, at = int(numbers[end]) + 1, sums[end], end + 1


def _cut_step(limits: list, start: int, held: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([c.to_numpy() for c in b.columns], 1) for b in batches]
        rows = np.concatenate(parts) if parts else np.zeros((0, 1 + len(COUNTS)), np.int64)
        held_rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [[r[0] for r in held_rows], [r[1] for r in held_rows], *([r[2][i] for r in held_rows] for i in range(len(COUNTS)))]
            held_rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["from_block", "next_block", *COUNTS])

        for page in cut(rows[:, 0], rows[:, 1:], limits, start, held):
            held_rows.append(page)
            if len(held_rows) == 10_000:
                yield batch()
        yield batch()

    return run


def page_log(query: ChainQuery, tables: dict, step: int = STEP) -> DataFrame:
    """LOG of the pages in which a query with limits returns its range: each begins where the one before ends and goes up
    to the block at which a limit is reached; the last one ends with the range, or with the highest block there is."""
    spark = tables["blocks"].sparkSession
    path = shared_folder(spark, "pages")
    shapes = replace(query, limits={}, fields={t: [BLOCK_COLUMN[t]] for t in SCHEMAS})
    counts = block_counts(shapes.execute(tables).tables)
    k = F.floor((F.col("number") - query.from_block) / step)
    counts.withColumn("step", k).repartition("step").sortWithinPartitions("number").write.partitionBy("step").parquet(f"{path}/counts")
    stored = spark.read.schema("number bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", step bigint").parquet(f"{path}/counts")
    height = tables["blocks"].agg(F.max("number")).first()[0]
    end = query.to_block if query.to_block is not None else query.from_block if height is None else height + 1
    limits = [query.limits.get(t) for t in SCHEMAS]
    if any(n is not None and n < 1 for n in limits):
        raise ValueError("a page holds at least one row of each limited table")
    start, held = query.from_block, [0] * len(COUNTS)
    for i in range(-(-max(0, end - query.from_block) // step)):
        part = stored.where(F.col("step") == i).drop("step").coalesce(1).sortWithinPartitions("number")
        part.mapInArrow(_cut_step(limits, start, held), LOG).write.parquet(f"{path}/log/step={i}")
        if (open_ := spark.read.schema(LOG).parquet(f"{path}/log/step={i}").where("next_block is null").first()) is not None:
            start, held = open_.from_block, [open_[c] for c in COUNTS]
    last = spark.createDataFrame([(start, end, *held)] if start < end else [], LOG)
    if end <= query.from_block:
        return last
    return spark.read.schema(LOG).parquet(f"{path}/log").where("next_block is not null").select(*last.columns).union(last)


def run_pages(query: ChainQuery, tables: dict, handle: Callable[[Row, ChainResult], None], step: int = STEP) -> DataFrame:
    """Each page's result to `handle`, in order, as it would come from a loop that asks for one page after the other; the
    log of it, with archive_height and the milliseconds that each page took."""
    spark = tables["blocks"].sparkSession
    height = tables["blocks"].agg(F.max("number")).first()[0]
    path, log = shared_folder(spark, "page-times"), page_log(query, tables, step)
    kinds = LOG + ", archive_height bigint, total_execution_time bigint"
    for i, page in enumerate(log.orderBy("from_block").toLocalIterator()):
        began = time.monotonic_ns()
        handle(page, replace(query, from_block=page.from_block, to_block=page.next_block, limits={}).execute(tables))
        took = -(-(time.monotonic_ns() - began) // 1_000_000)
        spark.createDataFrame([(*page, height, took)], kinds).write.parquet(f"{path}/page={i}")
    if log.isEmpty():
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(path).drop("page")

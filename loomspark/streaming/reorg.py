"""Reorganisations: block headers as they arrive, the fork that a page turns away at, and tables that take rows back.

A keyed state holds the last blocks of the chain. A page whose first block is not after the last one, or whose parent is
another, makes the chain end before it: the blocks from there on are withdrawn, each by number and version, and the
page's blocks come in with versions of their own. The versioned sink appends these events, one file an epoch, so that an
epoch's withdrawals and arrivals are seen together or not at all; tables of rows are appended beside it and are live as
far as their block is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomspark.plans.query import ChainResult
from loomspark.schema import BLOCK_COLUMN
from loomspark.streaming.follow import stream_table

#: Blocks that the state holds, and thus the deepest fork.
DEPTH = 10_000
EVENTS = "chain string, number bigint, hash binary, version bigint, withdrawn_by bigint, fork_block bigint"
STATE = "numbers array<bigint>, hashes array<binary>, versions array<bigint>, next bigint, cut boolean"


def headers(spark: SparkSession, path: str, files: int = 100) -> DataFrame:
    """(chain, arrived, page, number, hash, parent_hash): block headers in the order of the files that hold them."""
    blocks = stream_table(spark, path, "blocks", files)
    return blocks.select(
        F.lit("").alias("chain"), F.col("_metadata.file_modification_time").alias("arrived"),
        F.col("_metadata.file_path").alias("page"), "number", "hash", "parent_hash",
    )


class Chain:
    """The last blocks of one chain, by rising number, and the events that a page makes."""

    def __init__(self, numbers=(), hashes=(), versions=(), next_version: int = 0, cut: bool = False, depth: int = DEPTH):
        self.blocks = [tuple(x) for x in zip(numbers, hashes, versions, strict=True)]
        self.next, self.cut, self.depth = next_version, cut, depth
        self.events: list[tuple] = []

    def _withdraw(self, number: int) -> None:
        """Take back all blocks from a number on; the version to come is the one that does it."""
        fork = max((b[0] for b in self.blocks if b[0] < number), default=None)
        while self.blocks and self.blocks[-1][0] >= number:
            n, h, v = self.blocks.pop()
            self.events.append((n, h, v, self.next, fork))

    def add(self, number: int, hash_: bytes, parent: bytes) -> None:
        if self.blocks and number <= self.blocks[-1][0]:
            if (number, hash_) in self.known:
                return
            if self.cut and number < self.blocks[0][0]:
                raise ValueError(f"a fork at block {number} is deeper than the {self.depth} blocks that are held")
            self._withdraw(number)
        if self.blocks and self.blocks[-1][1] != parent:
            # The block before is not the parent: it is of another branch, whatever comes in its place.
            self._withdraw(self.blocks[-1][0])
        self.events.append((number, hash_, self.next, None, None))
        self.blocks.append((number, hash_, self.next))

    def page(self, rows: list[tuple[int, bytes, bytes]]) -> None:
        """One page of consecutive blocks; all of it that is there already, in place, changes nothing."""
        self.known = {b[:2] for b in self.blocks}
        for row in sorted(rows, key=lambda r: r[0]):
            self.add(*row)
        if len(self.blocks) > self.depth:
            self.blocks, self.cut = self.blocks[-self.depth :], True
        self.next += 1


def _follow(depth: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ((), (), (), 0, False)
        chain = Chain(*held, depth=depth)
        rows = pd.concat(list(frames))
        for _, page in rows.sort_values(["arrived", "page"], kind="stable").groupby(["arrived", "page"], sort=False):
            chain.page(list(zip(page["number"], page["hash"], page["parent_hash"], strict=True)))
        state.update((*(([b[i] for b in chain.blocks]) for i in range(3)), chain.next, chain.cut))
        out = pd.DataFrame([(key[0], *e) for e in chain.events], columns=[c.split()[0] for c in EVENTS.split(", ")])
        yield out.astype({c: "Int64" for c in ("number", "version", "withdrawn_by", "fork_block")})

    return run


def chain_events(headers: DataFrame, depth: int = DEPTH) -> DataFrame:
    """EVENTS of a stream of headers: an arrival of a block with its version, or the withdrawal of an earlier version
    (`withdrawn_by` is the version that does it, `fork_block` the last block that stays).

    All headers of a chain meet in one task a micro-batch: they are a few numbers a block, in an order that matters, and
    the files of a trigger bound them. A block that comes again in place changes nothing. A fork deeper than `depth` stops the
    stream with an error.
    """
    return headers.groupBy("chain").applyInPandasWithState(_follow(depth), EVENTS, STATE, "append", GroupStateTimeout.NoTimeout)


def follow_chain(headers: DataFrame, path: str, checkpoint: str, depth: int = DEPTH, **trigger):
    """The versioned sink: events of each epoch to one file below `path`; an epoch that is repeated replaces itself."""

    def step(batch: DataFrame, epoch: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        chain_events(headers, depth).writeStream.outputMode("append").foreachBatch(step)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def events_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS + ", epoch bigint").parquet(path)


def canonical(events: DataFrame) -> DataFrame:
    """(chain, number, hash, version): the blocks that no later page took back."""
    arrived = events.where("withdrawn_by is null").select("chain", "number", "hash", "version")
    gone = events.where("withdrawn_by is not null").select("chain", "number", "version")
    return arrived.join(gone, ["chain", "number", "version"], "left_anti")


def forks(events: DataFrame) -> DataFrame:
    """(chain, version, fork_block, n_withdrawn) of each page that took blocks back."""
    return (
        events.where("withdrawn_by is not null")
        .groupBy("chain", F.col("withdrawn_by").alias("version"))
        .agg(F.min("fork_block").alias("fork_block"), F.count("*").alias("n_withdrawn"))
    )


def live(df: DataFrame, table: str, blocks: DataFrame) -> DataFrame:
    """The rows of a table of one chain whose block is among `blocks` (number, hash): a withdrawn block's rows are gone
    with it, and come back if it does. A row that was appended twice, with a block that came again, is one."""
    hash_ = "hash" if table == "blocks" else "block_hash"
    keys = blocks.select(F.col("number").alias("_number"), F.col("hash").alias("_hash"))
    on = (F.col(BLOCK_COLUMN[table]) == F.col("_number")) & (F.col(hash_) == F.col("_hash"))
    return df.join(keys, on, "left_semi").distinct()


def live_result(result: ChainResult, blocks: DataFrame) -> dict:
    """All tables of a result, as far as they are live; tables need their block number and hash among their fields."""
    return {t: None if df is None else live(df, t, blocks) for t, df in result.tables.items()}

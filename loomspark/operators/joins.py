"""Cross-table join modes, and events: logs with their transaction and block.

Keys always go together with the block number, so that partition pruning reaches all tables. Key tables are distinct,
so a flag join can't repeat rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.schema import SCHEMAS

KEYS = ["block_number", "transaction_hash"]


def _flagged(df: DataFrame, keys: DataFrame, on: list[str], direct: Column) -> DataFrame:
    """Rows that match directly or whose key is in `keys` (distinct)."""
    return (
        df.withColumn("_direct", F.coalesce(direct, F.lit(False)))
        .join(keys.withColumn("_hit", F.lit(True)), on, "left")
        .where(F.col("_direct") | F.col("_hit").isNotNull())
        .select(*df.columns)
    )


def _tx_keys(df: DataFrame, column: str = "transaction_hash") -> DataFrame:
    return df.where(F.col(column).isNotNull()).select("block_number", F.col(column).alias("transaction_hash"))


def _reach(blocks: DataFrame, direct: Column, parts: list[DataFrame]) -> DataFrame:
    """Blocks that match directly or hold a returned row."""
    numbers = parts[0].select(F.col("block_number").alias("number"))
    for p in parts[1:]:
        numbers = numbers.union(p.select("block_number"))
    return _flagged(blocks, numbers.distinct(), ["number"], direct)


def as_planned(keys: DataFrame) -> DataFrame:
    """Matched keys as part of the plan of each table that they bring rows of."""
    return keys


def join_nothing(tables: dict, match: dict, keep=as_planned) -> dict:
    """Each table has only its direct matches."""
    return {n: df.where(match[n]) for n, df in tables.items()}


def join_default(tables: dict, match: dict, keep=as_planned) -> dict:
    """Logs bring their transactions, transactions their traces, every row its block; nothing flows back. `keep` may
    write the matched keys, so that the tables don't each find them again."""
    logs = tables["logs"].where(match["logs"])
    tx = tables["transactions"]
    keys = keep(_tx_keys(logs).union(_tx_keys(tx.where(match["transactions"]), "hash")).distinct())
    txs = tx.join(
        keys.withColumnRenamed("transaction_hash", "hash"), ["block_number", "hash"], "left_semi"
    ).select(*tx.columns)
    traces = _flagged(tables["traces"], keys, KEYS, match["traces"])
    return {
        "blocks": _reach(tables["blocks"], match["blocks"], [logs, txs, traces]),
        "transactions": txs,
        "logs": logs,
        "traces": traces,
    }


def join_all(tables: dict, match: dict, keep=as_planned) -> dict:
    """A matched row brings its transaction with all its logs, traces and block. A directly matched block brings all its
    transactions; a block that is only reached through a row does not."""
    tx = tables["transactions"]
    found = tables["blocks"].where(match["blocks"]).select(F.col("number").alias("block_number"))
    keys = (
        _tx_keys(tables["logs"].where(match["logs"]))
        .union(_tx_keys(tables["traces"].where(match["traces"])))
        .union(_tx_keys(tx.where(match["transactions"]), "hash"))
    )
    keys = keep(keys.union(_tx_keys(tx.join(found, "block_number", "left_semi"), "hash")).distinct())
    txs = tx.join(
        keys.withColumnRenamed("transaction_hash", "hash"), ["block_number", "hash"], "left_semi"
    ).select(*tx.columns)
    logs, traces = (_flagged(tables[n], keys, KEYS, match[n]) for n in ("logs", "traces"))
    return {
        "blocks": _reach(tables["blocks"], match["blocks"], [logs, txs, traces]),
        "transactions": txs,
        "logs": logs,
        "traces": traces,
    }


MODES = {"default": join_default, "all": join_all, "nothing": join_nothing}


def event_fields(log_fields: list[str], tx_fields: list[str], block_fields: list[str]) -> tuple[list[str], list[str]]:
    """(log fields with the join keys that the selection needs, those and both keys), sorted."""
    fields = sorted(
        {*log_fields} | ({"block_number"} if block_fields else set()) | ({"transaction_hash"} if tx_fields else set())
    )
    return fields, sorted({*fields, "block_number", "transaction_hash"})


def events(
    logs: DataFrame, transactions: DataFrame, blocks: DataFrame, log_fields: list[str], tx_fields: list[str],
    block_fields: list[str],
) -> DataFrame:
    """One row per log: struct columns log, transaction, block; null where nothing matches.

    Join keys are added to the selection. A side of which only its join key is selected is made from the log without a
    join, and a side of which nothing is selected is a null of its full type.
    """

    def side(
        df: DataFrame, other: DataFrame, name: str, fields: list[str], key: str, log_key: str, block: str
    ) -> DataFrame:
        if not fields:
            return df.withColumn(name, F.lit(None).cast(SCHEMAS[name + "s"]))
        if set(fields) == {key}:
            return df.withColumn(name, F.struct(F.col(log_key).alias(key)))
        chosen = other.select(
            F.col(key).alias("_key"),
            F.col(block).alias("_block"),
            F.struct(*(f"`{f}`" for f in sorted({*fields, key}))).alias(name),
        )
        on = F.col("block_number") == F.col("_block")
        return df.join(
            chosen, on if key == block else on & (F.col(log_key) == F.col("_key")), "left"
        ).drop("_key", "_block")

    fields, keys = event_fields(log_fields, tx_fields, block_fields)
    df = side(
        side(logs.select(*keys), transactions, "transaction", tx_fields, "hash", "transaction_hash", "block_number"),
        blocks,
        "block",
        block_fields,
        "number",
        "block_number",
        "number",
    )
    return df.select(F.struct(*fields).alias("log"), "transaction", "block")

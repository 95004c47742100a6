"""Ready-made queries over [from_block, to_block)."""

from __future__ import annotations

from loomspark.operators.filters import Filter
from loomspark.plans.query import ChainQuery
from loomspark.schema import SCHEMAS


def blocks_and_transactions(start: int, end: int | None = None) -> ChainQuery:
    q = ChainQuery(start, end, include_all_blocks=True).where("transactions", Filter("transactions"))
    return q.select("blocks", SCHEMAS["blocks"].names).select("transactions", SCHEMAS["transactions"].names)


def blocks_and_transaction_hashes(start: int, end: int | None = None) -> ChainQuery:
    return blocks_and_transactions(start, end).select("transactions", ["block_hash", "block_number", "hash"])


def logs(start: int, end: int | None, address: str) -> ChainQuery:
    return (
        ChainQuery(start, end)
        .where("logs", Filter("logs").where("address", [address]))
        .select("logs", SCHEMAS["logs"].names)
    )


def logs_of_event(start: int, end: int | None, topic0: str, address: str) -> ChainQuery:
    return logs(start, end, address).where("logs", Filter("logs").where("address", [address]).where("topic0", [topic0]))


def transactions(start: int, end: int | None = None) -> ChainQuery:
    return (
        ChainQuery(start, end)
        .where("transactions", Filter("transactions"))
        .select("transactions", SCHEMAS["transactions"].names)
    )


def transactions_from_address(start: int, end: int | None, address: str) -> ChainQuery:
    return transactions(start, end).where("transactions", Filter("transactions").where("from", [address]))

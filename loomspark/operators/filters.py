"""Selections as Columns: AND across fields, IN within a field, OR across clauses, one exclusion per selection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.values import literal

#: Fields of each table's filter, with the size of their values in bytes (None: text, 0: integer).
FIELDS = {
    "blocks": {"hash": 32, "miner": 20},
    "logs": {"address": 20, "topic0": 32, "topic1": 32, "topic2": 32, "topic3": 32},
    "transactions": {"from": 20, "to": 20, "sighash": 4, "status": 0, "type": 0, "contract_address": 20, "hash": 32},
    "traces": {"from": 20, "to": 20, "address": 20, "call_type": None, "reward_type": None, "type": None, "sighash": 4},
}


@dataclass(frozen=True)
class AuthorizationSelection:
    chain_id: tuple = ()
    address: tuple = ()


@dataclass(frozen=True)
class Filter:
    """One clause. Building methods replace a field's list; an empty list is no constraint."""

    table: str
    lists: dict = field(default_factory=dict)
    authorizations: tuple[AuthorizationSelection, ...] = ()

    def where(self, name: str, values: Iterable) -> Filter:
        size = FIELDS[self.table].get(name, "missing")
        if size == "missing":
            raise ValueError(f"{self.table} has no filter field {name!r}")
        checked = []
        for i, v in enumerate(values):
            try:
                checked.append(literal(v, size) if size else v)
            except ValueError as e:
                raise ValueError(f"{name}[{i}]: {e}") from None
        return Filter(self.table, self.lists | {name: checked}, self.authorizations)

    def authorized(self, *selections: AuthorizationSelection) -> Filter:
        return Filter(self.table, self.lists, selections)

    def column(self) -> Column:
        parts = [F.col(n).isin(v) for n, v in self.lists.items() if v]
        if self.authorizations:
            parts.append(
                F.exists(
                    "authorization_list",
                    lambda a: reduce(lambda x, y: x | y, (self._authorized(a, s) for s in self.authorizations)),
                )
            )
        return reduce(lambda x, y: x & y, parts) if parts else F.lit(True)

    @staticmethod
    def _authorized(a: Column, s: AuthorizationSelection) -> Column:
        one = a["chain_id"].isin([literal(v) for v in s.chain_id]) if s.chain_id else F.lit(True)
        return one & a["address"].isin([literal(v, 20) for v in s.address]) if s.address else one


@dataclass(frozen=True)
class Selection:
    """Rows that any included clause keeps and no excluded one; a null comparison excludes nothing."""

    include: tuple[Filter, ...]
    exclude: tuple[Filter, ...] | None = None

    def and_not(self, *exclude: Filter) -> Selection:
        return Selection(self.include, exclude)

    def column(self) -> Column:
        kept = any_of(self.include)
        return kept if self.exclude is None else kept & ~F.coalesce(any_of(self.exclude), F.lit(False))


def any_of(clauses: Iterable) -> Column:
    """One predicate; no clause at all keeps nothing."""
    columns = [c.column() for c in clauses]
    return reduce(lambda x, y: x | y, columns) if columns else F.lit(False)


def key_set(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose value is in a table of keys (first column): exact, whatever its size; the join broadcasts a small one."""
    return df.join(
        keys.select(F.col(keys.columns[0]).alias(column)).distinct(), column, "left_semi"
    ).select(*df.columns)

"""The query builder: a block range, selections, fields, a join mode and limits, over four tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions.cast import column_mapping, hex_output
from loomspark.operators.filters import FIELDS, AuthorizationSelection, Filter, Selection, any_of
from loomspark.operators.joins import MODES, as_planned
from loomspark.operators.order import limit_blocks, ordered
from loomspark.schema import BLOCK_COLUMN, RANGE, SCHEMAS


def block_range(df: DataFrame, table: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Blocks of [start, end); a stored table's partition folders are pruned by a predicate of their own."""
    c = F.col(BLOCK_COLUMN[table])
    kept = c >= start if end is None else (c >= start) & (c < end)
    if "block_range" in df.columns:
        kept &= F.col("block_range") >= start // RANGE if end is None else F.col("block_range").between(
            start // RANGE, max(0, end - 1) // RANGE
        )
    return df.where(kept)


def full_shape(df: DataFrame, table: str) -> DataFrame:
    """All columns of the table; one that isn't there is a null, one of the wrong type an error."""
    have = {f.name: f.dataType for f in df.schema}
    for f in SCHEMAS[table]:
        if f.name in have and have[f.name].simpleString() != f.dataType.simpleString():
            raise TypeError(f"{table}.{f.name} is {have[f.name].simpleString()}, expected {f.dataType.simpleString()}")
    return df.select(
        *(
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in SCHEMAS[table]
        )
    )


def null_violations(df: DataFrame, table: str) -> DataFrame:
    """(column, violations): nulls in the columns that are there and may not be null."""
    names = [f.name for f in SCHEMAS[table] if not f.nullable and f.name in df.columns]
    counts = df.agg(*(F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names))
    return counts.select(
        F.explode(F.array(*(F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("violations")) for n in names)))
        .alias("x")
    ).select("x.*")


def assert_not_null(df: DataFrame, table: str) -> DataFrame:
    """The same rows; a null where none may be is an error when the rows are read."""
    names = [f.name for f in SCHEMAS[table] if not f.nullable and f.name in df.columns]
    return df.withColumns(
        {
            n: F
            .when(F.col(f"`{n}`").isNull(), F.raise_error(F.lit(f"unexpected null in {n}")))
            .otherwise(F.col(f"`{n}`"))
            for n in names
        }
    )


@dataclass(frozen=True)
class ChainResult:
    """Lazy frames; a table without selected fields is None. `last_block` is the last one of a page that a limit cut."""

    tables: dict
    decoded_logs: DataFrame | None = None
    last_block: int | None = None
    to_block: int | None = None
    #: Folders of matched keys that the frames read; `release` removes them.
    keys: tuple[str, ...] = ()

    def release(self) -> None:
        """Remove what `execute` wrote; the frames can't be read any more."""
        spark = next(df.sparkSession for df in self.tables.values() if df is not None) if self.keys else None
        for name in self.keys:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

    def transform(
        self, decode=None, reverse: bool = False, mapping: dict | None = None, hex_mode: str = "none"
    ) -> ChainResult:
        """In this order: decode logs, reverse, map columns, hex."""
        tables, decoded = dict(self.tables), decode(self.tables["logs"]) if decode else self.decoded_logs
        if reverse:
            tables = {t: ordered(df, t, True) if df is not None else None for t, df in tables.items()}
        done = lambda df, name: None if df is None else hex_output(column_mapping(df, (mapping or {}).get(name, {})), hex_mode)
        return replace(
            self, tables={t: done(df, t) for t, df in tables.items()}, decoded_logs=done(decoded, "decoded_logs")
        )

    def next_block(self, tables: dict) -> DataFrame:
        """One row: where the next page starts."""
        end = F.lit(self.to_block) if self.to_block is not None else F.col("height") + 1
        height = tables["blocks"].agg(F.coalesce(F.max("number"), F.lit(-1)).alias("height"))
        if self.last_block is None:
            return height.select(end.cast("bigint").alias("next_block"))
        return height.select(F.least(F.lit(self.last_block + 1), end).cast("bigint").alias("next_block"))


@dataclass(frozen=True)
class ChainQuery:
    from_block: int = 0
    to_block: int | None = None
    selections: dict = field(default_factory=dict)
    fields: dict = field(default_factory=dict)
    join_mode: str = "default"
    include_all_blocks: bool = False
    limits: dict = field(default_factory=dict)

    def where(self, table: str, *selections: Selection | Filter) -> ChainQuery:
        """The table's selections (replacing earlier ones); a row is kept when any of them keeps it."""
        done = tuple(s if isinstance(s, Selection) else Selection((s,)) for s in selections)
        return replace(self, selections=self.selections | {table: done})

    def select(self, table: str, names) -> ChainQuery:
        """The table's fields, replacing an earlier choice."""
        bad = set(names) - set(SCHEMAS[table].names)
        if bad:
            raise ValueError(f"{table} has no fields {sorted(bad)}")
        return replace(self, fields=self.fields | {table: list(names)})

    def extend(self, table: str, names) -> ChainQuery:
        """More fields, as a sorted set."""
        return self.select(table, sorted({*self.fields.get(table, ()), *names}))

    def all_fields(self) -> ChainQuery:
        return replace(self, fields={t: list(s.names) for t, s in SCHEMAS.items()})

    def limit(self, **tables: int) -> ChainQuery:
        return replace(self, limits=self.limits | tables)

    def predicates(self) -> dict:
        return {t: any_of(self.selections.get(t, ())) for t in SCHEMAS}

    def execute(self, tables: dict, keys_folder: str | None = None) -> ChainResult:
        """The result over four tables. Without `to_block` the range ends with the highest block there is. Only limits
        read anything here: counts of ranges of blocks, until one is reached.

        With a `keys_folder`, a new one in the folder that the cluster shares, the matched keys are found here, once, and
        written there; all four tables read them from it. Without it each table's plan finds them by itself.
        """

        def keep(keys: DataFrame) -> DataFrame:
            keys.write.parquet(keys_folder)
            return keys.sparkSession.read.schema(keys.schema).parquet(keys_folder)

        ranged = {t: block_range(df, t, self.from_block, self.to_block) for t, df in tables.items()}
        match = self.predicates()
        out = MODES[self.join_mode](ranged, match, keep if keys_folder else as_planned)
        if self.include_all_blocks:
            out["blocks"] = ranged["blocks"]
        last = None
        if any(n is not None for n in self.limits.values()):
            end = self.to_block if self.to_block is not None else (
                tables["blocks"].agg(F.max("number")).first()[0] or -1
            ) + 1
            out, last = limit_blocks(out, self.limits, self.from_block, end)
        chosen = {
            t: df.select(*(f"`{c}`" for c in self.fields[t] if c in df.columns))
            if self.fields.get(t) else None
            for t, df in out.items()
        }
        written = (keys_folder,) if keys_folder and self.join_mode != "nothing" else ()
        return ChainResult(chosen, last_block=last, to_block=self.to_block, keys=written)

    @staticmethod
    def from_dict(document: dict) -> ChainQuery:
        """A query from its JSON document; unknown names are errors."""
        known = {
            "from_block", "to_block", "logs", "transactions", "traces", "blocks", "field_selection", "join_mode",
            "include_all_blocks", "max_num_blocks", "max_num_transactions", "max_num_logs", "max_num_traces",
        }
        if bad := set(document) - known:
            raise ValueError(f"unknown names {sorted(bad)}")
        mode = {"Default": "default", "JoinAll": "all", "JoinNothing": "nothing"}[document.get("join_mode", "Default")]
        limits = {t: document[f"max_num_{t}"] for t in SCHEMAS if document.get(f"max_num_{t}") is not None}
        q = ChainQuery(
            document.get("from_block", 0),
            document.get("to_block"),
            join_mode=mode,
            include_all_blocks=document.get("include_all_blocks", False),
            limits=limits,
        )
        for t in SCHEMAS:
            if t in document:
                q = q.where(t, *(_selection(t, s) for s in document[t]))
            if names := document.get("field_selection", {}).get(t.rstrip("s"), []):
                q = q.select(t, names)
        return q


def _clause(table: str, d: dict) -> Filter:
    f = Filter(table)
    for name, values in d.items():
        if name == "topics" and table == "logs":
            if len(values) > 4:
                raise ValueError("a log has at most four topics")
            for i, v in enumerate(values):
                f = f.where(f"topic{i}", v)
        elif name == "authorization_list" and table == "transactions":
            f = f.authorized(
                *(AuthorizationSelection(tuple(a.get("chain_id", ())), tuple(a.get("address", ()))) for a in values)
            )
        elif name in FIELDS[table]:
            if values is not None:
                f = f.where(name, values if isinstance(values, list) else [values])
        else:
            raise ValueError(f"unknown filter field {name!r} of {table}")
    return f


def _selection(table: str, d: dict) -> Selection:
    include = _clause(table, {k: v for k, v in d.items() if k != "exclude"})
    return Selection((include,), (_clause(table, d["exclude"]),) if d.get("exclude") is not None else None)

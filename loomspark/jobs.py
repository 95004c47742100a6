"""All registered queries of the chain engine, each with its DuckDB SQL where SQL can express it.

Both sides run over the chain-shaped tables derived from `orders` and `lineitem`; binaries are shown as 0x hex.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import abi, values
from loomspark.functions.cast import column_mapping, decimal256, hex_output
from loomspark.operators import joins, order
from loomspark.operators.filters import AuthorizationSelection, Filter, Selection, key_set
from loomspark.plans import presets
from loomspark.plans.query import ChainQuery, assert_not_null, block_range, full_shape, null_violations
from loomspark.registry import ORACLES, QUERIES, query
from loomspark.schema import SCHEMAS
from loomspark.ship import ship
from loomspark.sinks import follow_sink, shared_folder, write_arrow_ipc, write_parquet
from loomspark.sources import ingest
from loomspark.sources.fixtures import APPROVAL, TRANSFER, chain_tables, oracle_tables
from loomspark.sources.tables import archive_height, chain_id, scan, scan_arrow_ipc, store
from loomspark.streaming import follow

__all__ = ["ORACLES", "QUERIES"]

ORACLE = oracle_tables()
BL = ["number", "hash", "parent_hash", "miner", "timestamp", "gas_limit"]
TX = [
    "block_number", "hash", "from", "to", "transaction_index", "value", "status", "type", "input", "sighash",
    "contract_address",
]
LG = [
    "removed", "log_index", "transaction_index", "transaction_hash", "block_hash", "block_number", "address", "data",
    "topic0", "topic1", "topic2", "topic3",
]
TR = [
    "from", "to", "call_type", "input", "value", "author", "reward_type", "block_hash", "block_number", "output",
    "transaction_hash", "transaction_position", "type", "sighash",
]
#: Integers that may be null are shown as text.
MAYBE = ("transaction_position", "trace_place", "n_topic3")
COLUMNS = {"blocks": BL, "transactions": TX, "logs": LG, "traces": TR}
EVENT = {
    TRANSFER: "Transfer(address indexed from, address indexed to, uint256 amount)",
    APPROVAL: "Approval(address indexed owner, address indexed spender, uint256 amount)",
}
LOW, HIGH = 300, 900


def sha(x: str) -> str:
    return "0x" + hashlib.sha256(x.encode()).hexdigest()


def addr(x: str) -> str:
    return sha(x)[:42]


def topic(address: str) -> str:
    return "0x" + "0" * 24 + address[2:]


def cols(names: list[str], of: str = "") -> str:
    return ", ".join(f'CAST({of}"{n}" AS VARCHAR) AS "{n}"' if n in MAYBE else f'{of}"{n}"' for n in names)


def inside(names) -> str:
    return ", ".join(f"'{n}'" if isinstance(n, str) else str(n) for n in names)


def shown(df: DataFrame) -> DataFrame:
    """Binaries as 0x text, arrays as comma-joined text."""
    df = hex_output(df)
    df = df.withColumns({n: F.col(n).cast("string") for n in MAYBE if n in df.columns})
    return df.withColumns(
        {
            f.name: F.array_join(F.transform(f"`{f.name}`", lambda x: x.cast("string")), ",")
            for f in df.schema
            if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, T.StructType)
        }
    )


def job(name: str, sql: str | None, by_block: bool = False):
    """Register a callable over (spark, sf_dir, tables); with `by_block` the logs are dealt by ranges of blocks."""

    def add(fn):
        def run(spark, sf_dir):
            ship(spark)
            # What a finished write has shuffled isn't needed by what reads it.
            spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)
            return shown(fn(spark, sf_dir, chain_tables(spark, sf_dir, by_block=by_block)))

        query(name, ORACLE + sql if sql is not None else None)(run)
        return fn

    return add


def _stored(spark, tables, *names) -> str:
    path = shared_folder(spark, "chain")
    store({n: full_shape(tables[n], n) for n in names}, path)
    return path


# Sources

def _scanned(table: str):
    """The stored table, read as a whole; blocks by a range, which prunes folders."""

    def run(spark, d, t):
        df = scan(spark, _stored(spark, t, table), table)
        return (
            block_range(df, table, LOW, HIGH) if table == "blocks" else df
        ).select(*(f"`{c}`" for c in COLUMNS[table]))

    return run


for _t in COLUMNS:
    job(
        f"scan_{_t}",
        f"SELECT {cols(COLUMNS[_t])} FROM {_t}"
        + (f" WHERE number >= {LOW} AND number < {HIGH}" if _t == "blocks" else ""),
        by_block=_t == "logs",
    )(_scanned(_t))


@job("scan_arrow_ipc", f"SELECT {cols(BL)} FROM blocks")
def _ipc(spark, d, t):
    folder = shared_folder(spark, "ipc")
    df = t["blocks"].select(*BL)
    write_arrow_ipc(df, folder)
    return scan_arrow_ipc(spark, folder, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))


def _hexed(df: DataFrame, renamed: dict) -> DataFrame:
    """JSON documents from a table: columns renamed, binaries as 0x text, numbers as 0x quantities."""
    df = hex_output(df)
    number = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    kinds = dict(df.dtypes)
    return df.select(
        F.to_json(
            F.struct(
                *(
                    (number(F.col(f"`{a}`")) if kinds[a] in ("bigint", "smallint", "int") else F.col(f"`{a}`")).alias(b)
                    for a, b in renamed.items()
                )
            )
        )
        .alias("json")
    )


@job("ingest_rpc_blocks", f"SELECT {cols(BL)}, '' AS uncles FROM blocks")
def _rpc_blocks(spark, d, t):
    docs = _hexed(
        t["blocks"],
        {
            "number": "number", "hash": "hash", "parent_hash": "parentHash", "miner": "miner", "timestamp": "timestamp",
            "gas_limit": "gasLimit",
        },
    )
    docs = docs.select(
        F.concat(F.expr("substring(json, 1, length(json) - 1)"), F.lit(',"uncles":[],"size":12}')).alias("json")
    )
    return ingest.rpc_blocks(docs).select(*BL, "uncles")


_TXDOC = {
    "block_hash": "blockHash", "block_number": "blockNumber", "from": "from", "hash": "hash", "input": "input",
    "to": "to", "transaction_index": "transactionIndex", "value": "value", "chain_id": "chainId", "type": "type",
}


@job(
    "ingest_rpc_transactions",
    'SELECT block_hash, block_number, "from", hash, input, "to", transaction_index, value, chain_id, type, '
    'sighash FROM transactions',
)
def _rpc_transactions(spark, d, t):
    return ingest.rpc_transactions(_hexed(t["transactions"], _TXDOC)).select(
        "block_hash", "block_number", "from", "hash", "input", "to", "transaction_index", "value", "chain_id", "type",
        "sighash",
    )


@job(
    "ingest_rpc_receipts",
    "SELECT block_number, hash, contract_address, status, '0x00' AS effective_gas_price, sighash FROM transactions",
)
def _rpc_receipts(spark, d, t):
    docs = _hexed(
        t["transactions"],
        {
            "hash": "transactionHash", "block_number": "blockNumber", "contract_address": "contractAddress",
            "status": "status",
        },
    )
    tx = ingest.rpc_transactions(_hexed(t["transactions"], _TXDOC))
    return ingest.complete(tx, ingest.rpc_receipts(docs)).select(
        "block_number", "hash", "contract_address", "status", "effective_gas_price", "sighash"
    )


@job("ingest_rpc_logs", f"SELECT {cols(LG)} FROM logs")
def _rpc_logs(spark, d, t):
    hexed = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    doc = lambda x: F.struct(
        x["removed"].alias("removed"),
        hexed(x["log_index"]).alias("logIndex"),
        hexed(x["transaction_index"]).alias("transactionIndex"),
        hexed(F.col("transaction_hash")).alias("transactionHash"),
        hexed(x["block_hash"]).alias("blockHash"),
        hexed(F.col("block_number")).alias("blockNumber"),
        hexed(x["address"]).alias("address"),
        hexed(x["data"]).alias("data"),
        F.array_compact(F.array(*(hexed(x[f"topic{i}"]) for i in range(4)))).alias("topics"),
    )
    # A transaction's logs are of one block, and rows of a block are together already; they become text when they are collected.
    held = ("removed", "log_index", "transaction_index", "block_hash", "address", "data", *(f"topic{i}" for i in range(4)))
    receipts = (
        t["logs"].groupBy("block_number", "transaction_hash")
        .agg(F.collect_list(F.struct(*held)).alias("logs"))
        .select(F.to_json(F.struct(F.transform("logs", doc).alias("logs"))).alias("json"))
    )
    return ingest.rpc_logs(ingest.receipt_logs(receipts))


@job("ingest_rpc_traces", f"SELECT {cols(TR)}, CAST(trace_place AS STRING) AS trace_address FROM traces")
def _rpc_traces(spark, d, t):
    df = hex_output(t["traces"])
    action = F.struct(
        "from", "to", F.col("call_type").alias("callType"), "input", "value", "author",
        F.col("reward_type").alias("rewardType"),
    )
    doc = F.struct(
        action.alias("action"),
        F.struct("output").alias("result"),
        F.col("block_hash").alias("blockHash"),
        F.col("block_number").alias("blockNumber"),
        F.col("transaction_hash").alias("transactionHash"),
        F.col("transaction_position").alias("transactionPosition"),
        "type",
        F.col("trace_address").alias("traceAddress"),
    )
    return ingest.rpc_traces(df.select(F.to_json(doc).alias("json"))).select(*(f"`{c}`" for c in TR), "trace_address")


@job("ingest_debug_traces", """
SELECT block_number, hash AS transaction_hash, p.path AS trace_address, p.n::BIGINT AS subtraces, p.kind AS type, "from", CASE WHEN p.path = '' THEN "to" END AS "to"
FROM transactions, (VALUES ('', 2, 'call'), ('0', 1, 'call'), ('0,0', 0, 'call'), ('1', 0, 'create')) p(path, n, kind)""")
def _debug_traces(spark, d, t):
    df = hex_output(t["transactions"].drop("authorization_list"))
    leaf = F.struct(F.lit("STATICCALL").alias("type"), "from")
    first = F.struct(F.lit("CALL").alias("type"), "from", F.array(leaf).alias("calls"))
    second = F.struct(F.lit("CREATE2").alias("type"), "from")
    text = F.to_json(F.struct(F.lit("CALL").alias("type"), "from", "to"))
    json = F.concat(
        F.regexp_replace(text, r"\}$", ""), F.lit(',"calls":['), F.to_json(first), F.lit(","), F.to_json(second),
        F.lit("]}"),
    )
    docs = df.select(
        "block_number",
        F.unhex(F.substring("block_hash", 3, 64)).alias("block_hash"),
        F.unhex(F.substring("hash", 3, 64)).alias("transaction_hash"),
        F.col("transaction_index").alias("transaction_position"),
        json.alias("json"),
    )
    return ingest.debug_traces(docs).select(
        "block_number", "transaction_hash", "trace_address", "subtraces", "type", "from", "to"
    )


job("archive_height", "SELECT max(number) AS height FROM blocks")(lambda spark, d, t: archive_height(t["blocks"]))
job("chain_id", "SELECT 1 AS chain_id")(lambda spark, d, t: chain_id(t["transactions"]))


# Range, pages, order, limits

job(
    "block_range", f"SELECT {cols(LG)} FROM logs WHERE block_number >= {LOW} AND block_number < {HIGH}"
)(lambda spark, d, t: block_range(t["logs"], "logs", LOW, HIGH).select(*LG))
job("default_to_tip", f"SELECT {cols(LG)} FROM logs WHERE block_number >= 2000")(
    lambda spark, d, t: ChainQuery(2000).where("logs", Filter("logs")).select("logs", LG).execute(t).tables["logs"]
)


def _limited(t: dict) -> ChainQuery:
    return (
        ChainQuery(LOW, None)
        .where("logs", Filter("logs").where("topic0", ["0x" + TRANSFER]))
        .select("logs", LG)
        .select("transactions", TX)
        .select("blocks", BL)
        .select("traces", TR)
    )


_CUT = (
    "c AS (SELECT n, coalesce(sum(k) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "
    "seen FROM (SELECT {key} AS n, count(*) AS k FROM {rows} GROUP BY ALL))"
)
_MATCHED = (
    f"ml AS (SELECT * FROM logs WHERE block_number >= {LOW} AND topic0 = '0x{TRANSFER}'), mt AS (SELECT * FROM "
    f"transactions WHERE hash IN (SELECT transaction_hash FROM ml)), mr AS (SELECT * FROM traces WHERE "
    f"transaction_hash IN (SELECT transaction_hash FROM ml)), mb AS (SELECT * FROM blocks WHERE number IN (SELECT "
    f"block_number FROM ml))"
)
for _t, _rows, _n in (("blocks", "mb", 40), ("transactions", "mt", 100), ("logs", "ml", 500), ("traces", "mr", 300)):
    _key = "number" if _t == "blocks" else "block_number"
    job(
        f"max_num_{_t}",
        f", {_MATCHED}, {_CUT.format(key=_key, rows=_rows)} SELECT {cols(COLUMNS[_t])} FROM {_rows} WHERE {_key} "
        f"<= (SELECT max(n) FROM c WHERE seen < {_n})",
    )(lambda spark, d, t, n=_t, k=_n: _limited(t).limit(**{n: k}).execute(t).tables[n])
job(
    "next_block",
    f", {_MATCHED}, {_CUT.format(key='block_number', rows='ml')} SELECT max(n) + 1 AS next_block FROM c WHERE "
    f"seen < 500",
)(lambda spark, d, t: _limited(t).limit(logs=500).execute(t).next_block(t))
for _name, _rev in (("order_canonical", False), ("reverse_order", True)):
    job(
        _name,
        f"SELECT {cols(LG)} FROM logs ORDER BY block_number {'DESC' if _rev else ''}, log_index "
        f"{'DESC' if _rev else ''}",
        by_block=not _rev,
    )(lambda spark, d, t, r=_rev: order.ordered(t["logs"].select(*LG), "logs", r))
job(
    "row_counts",
    "SELECT 'blocks' AS \"table\", count(*) AS n FROM blocks UNION ALL SELECT 'transactions', count(*) FROM "
    "transactions UNION ALL SELECT 'logs', count(*) FROM logs UNION ALL SELECT 'traces', count(*) FROM traces",
)(lambda spark, d, t: order.row_counts(t))


@job(
    "block_range_split",
    ", r AS (SELECT min(number) AS a, max(number) + 1 AS b FROM blocks) SELECT s AS from_block, least(s + 250, "
    "b) AS to_block, (SELECT count(*) FROM logs WHERE block_number >= s AND block_number < least(s + 250, b)) AS "
    "n FROM (SELECT unnest(range(a, b, 250)) AS s, b FROM r)",
)
def _split(spark, d, t):
    low, high = t["blocks"].agg(F.min("number"), F.max("number") + 1).first()
    steps = order.split_range(spark, low, high, 250)
    counts = (
        t["logs"]
        .groupBy((F.floor((F.col("block_number") - low) / 250) * 250 + low).alias("from_block"))
        .agg(F.count("*").alias("n"))
    )
    return steps.join(counts, "from_block", "left").select(
        "from_block", "to_block", F.coalesce("n", F.lit(0)).alias("n")
    )


# Projection

for _t, _pick in (
    ("blocks", ["number", "hash", "miner"]),
    ("transactions", ["hash", "from", "to", "value"]),
    ("logs", ["address", "data", "topic0", "log_index"]),
    ("traces", ["from", "to", "type", "call_type"]),
):
    job(f"select_{_t[:-1]}_fields", f"SELECT {cols(_pick)} FROM {_t}")(
        lambda spark, d, t, n=_t, p=_pick: (
            ChainQuery(join_mode="nothing").where(n, Filter(n)).select(n, p).execute(t).tables[n]
        )
    )
job("field_selection_extend", "SELECT address, block_number, data, topic0 FROM logs")(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing")
        .where("logs", Filter("logs"))
        .extend("logs", ["topic0", "address"])
        .extend("logs", ["data", "address", "block_number"])
        .execute(t).tables["logs"]
    )
)
_BLOCK_SQL = ", ".join(
    f'"{f.name}"'
    if f.name in BL
    else f'CAST(NULL AS {"BIGINT" if f.dataType.simpleString() == "bigint" else "VARCHAR"}) AS "{f.name}"'
    for f in SCHEMAS["blocks"]
)
job("all_fields", f"SELECT {_BLOCK_SQL.replace(', CAST(NULL AS VARCHAR) AS \"withdrawals\"', '')} FROM blocks")(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing")
        .where("blocks", Filter("blocks"))
        .all_fields()
        .execute({n: full_shape(df, n) for n, df in t.items()}).tables["blocks"]
        .drop("withdrawals")
    )
)
job("empty_selection", "SELECT 'logs' AS \"table\", count(*) AS n FROM logs")(
    lambda spark, d, t: (
        order.row_counts(
            {
                n: df
                for n, df in ChainQuery(join_mode="nothing")
                .where("logs", Filter("logs"))
                .where("blocks", Filter("blocks"))
                .select("logs", LG)
                .execute(t).tables
                .items()
                if df is not None
            }
        )
    )
)
job(
    "full_shape", f"SELECT {_BLOCK_SQL.replace(', CAST(NULL AS VARCHAR) AS \"withdrawals\"', '')} FROM blocks"
)(lambda spark, d, t: full_shape(t["blocks"], "blocks").drop("withdrawals"))


@job(
    "assert_not_null",
    "SELECT 'transactions' AS \"table\", 'to' AS \"column\", count(*) FILTER (\"to\" IS NULL) AS violations FROM "
    "transactions UNION ALL SELECT 'logs', 'data', count(*) FILTER (data IS NULL) FROM logs",
)
def _not_null(spark, d, t):
    logs = (
        null_violations(assert_not_null(t["logs"], "logs"), "logs")
        .where("column = 'data'")
        .select(F.lit("logs").alias("table"), "column", "violations")
    )
    moved = null_violations(t["transactions"].select(F.col("to").alias("hash")), "transactions").select(
        F.lit("transactions").alias("table"), F.lit("to").alias("column"), "violations"
    )
    return moved.union(logs)


# Filters

def _direct(name: str, table: str, flt: Filter, where: str) -> None:
    job(name, f"SELECT {cols(COLUMNS[table])} FROM {table} WHERE {where}")(
        lambda spark, d, t: (
            ChainQuery(join_mode="nothing").where(table, flt).select(table, COLUMNS[table]).execute(t).tables[table]
        )
    )


_FILTERS = [
    ("filter_block_hash", "blocks", "hash", [sha("b10"), sha("b500"), sha("b2000")]),
    ("filter_block_miner", "blocks", "miner", [addr("m2"), addr("m5")]),
    ("filter_log_address", "logs", "address", [addr("tok3"), addr("tok11")]),
    ("filter_log_topic0", "logs", "topic0", ["0x" + TRANSFER]),
    ("filter_log_topic1", "logs", "topic1", [topic(addr(f"c{i}")) for i in range(1, 40)]),
    ("filter_log_topic2", "logs", "topic2", [topic(addr("s7")), topic(addr("s9"))]),
    ("filter_log_topic3", "logs", "topic3", ["0x" + f"{i:064x}" for i in range(1, 30)]),
    ("filter_tx_from", "transactions", "from", [addr(f"c{i}") for i in range(1, 40)]),
    ("filter_tx_to", "transactions", "to", [addr("p7"), addr("p21")]),
    ("filter_tx_sighash", "transactions", "sighash", ["0xa9059cbb"]),
    ("filter_tx_status", "transactions", "status", [0]),
    ("filter_tx_type", "transactions", "type", [2, 4]),
    ("filter_tx_contract_address", "transactions", "contract_address", [addr(f"k{i}") for i in range(0, 2000, 10)]),
    ("filter_tx_hash", "transactions", "hash", [sha(f"t{i}") for i in range(1, 50)]),
    ("filter_trace_from", "traces", "from", [addr(f"c{i}") for i in range(1, 40)]),
    ("filter_trace_to", "traces", "to", [addr("tok1")]),
    ("filter_trace_address", "traces", "address", [addr("k1"), addr("k6")]),
    ("filter_trace_call_type", "traces", "call_type", ["delegatecall"]),
    ("filter_trace_reward_type", "traces", "reward_type", ["block", "uncle"]),
    ("filter_trace_type", "traces", "type", ["reward"]),
    ("filter_trace_sighash", "traces", "sighash", ["0x70a08231"]),
]
for _name, _t, _f, _v in _FILTERS:
    _direct(_name, _t, Filter(_t).where(_f, _v), f'"{_f}" IN ({inside(_v)})')


@job(
    "filter_tx_authorization",
    f"SELECT {cols(TX)} FROM transactions WHERE auth_address IN ('{addr('a2')}', '{addr('a4')}')",
)
def _authorized(spark, d, t):
    f = Filter("transactions").authorized(
        AuthorizationSelection(("0x01",), (addr("a2"),)),
        AuthorizationSelection((), (addr("a4"),)),
        AuthorizationSelection(("0x05",), ()),
    )
    return (
        ChainQuery(join_mode="nothing")
        .where("transactions", f)
        .select("transactions", TX)
        .execute(t).tables["transactions"]
    )


job("filter_all", "SELECT 'logs' AS \"table\", count(*) AS n FROM logs UNION ALL SELECT 'traces', 0")(
    lambda spark, d, t: (
        order.row_counts(
            {
                k: v
                for k, v in ChainQuery(join_mode="nothing")
                .where("logs", Filter("logs"))
                .select("logs", LG)
                .select("traces", TR)
                .execute(t).tables
                .items()
                if v is not None
            }
        )
    )
)
_EITHER = Selection(
    (
        Filter("logs").where("address", [addr("tok3")]),
        Filter("logs").where("topic0", ["0x" + APPROVAL]).where("topic2", [topic(addr("s7"))]),
    )
)
_EITHER_SQL = f"(address = '{addr('tok3')}' OR (topic0 = '0x{APPROVAL}' AND topic2 = '{topic(addr('s7'))}'))"
job("filter_or", f"SELECT {cols(LG)} FROM logs WHERE {_EITHER_SQL}")(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing").where("logs", _EITHER).select("logs", LG).execute(t).tables["logs"]
    )
)
job(
    "filter_and_not",
    f"SELECT {cols(LG)} FROM logs WHERE {_EITHER_SQL} AND NOT coalesce(topic3 IN "
    f"({inside(['0x' + f'{i:064x}' for i in range(1, 60)])}), false)",
)(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing")
        .where("logs", _EITHER.and_not(Filter("logs").where("topic3", ["0x" + f"{i:064x}" for i in range(1, 60)])))
        .select("logs", LG)
        .execute(t).tables["logs"]
    )
)
for _t, _f, _v in (
    ("logs", "address", [addr("tok5")]), ("transactions", "to", [addr("p3")]), ("traces", "to", [addr("tok5")]),
    ("blocks", "miner", [addr("m3")]),
):
    _direct(f"where_{_t}", _t, Filter(_t).where(_f, _v), f'"{_f}" IN ({inside(_v)})')
job(
    "filter_key_set",
    f"SELECT {cols(TX)} FROM transactions WHERE \"from\" IN (SELECT \"from\" FROM transactions WHERE "
    f"transaction_index = 0)",
)(
    lambda spark, d, t: (
        key_set(
            t["transactions"], "from", t["transactions"].where("transaction_index = 0").select("from")
        ).select(*(f"`{c}`" for c in TX))
    )
)
_DOCUMENT = {
    "from_block": LOW, "to_block": HIGH, "join_mode": "JoinNothing", "field_selection": {"log": LG},
    "logs": [{"address": [addr("tok1"), addr("tok2")], "topics": [["0x" + TRANSFER]], "exclude": {"topics": [[], [], [topic(addr("s7"))]]}}],
}
job(
    "query_from_dict",
    f"SELECT {cols(LG)} FROM logs WHERE block_number >= {LOW} AND block_number < {HIGH} AND address IN "
    f"('{addr('tok1')}', '{addr('tok2')}') AND topic0 = '0x{TRANSFER}' AND topic2 <> '{topic(addr('s7'))}'",
)(lambda spark, d, t: ChainQuery.from_dict(_DOCUMENT).execute(t).tables["logs"])


# Joins

_L = (
    Filter("logs")
    .where("address", [addr("tok3")])
    .where("topic2", [topic(addr("s7")), topic(addr("s9")), topic(addr("s11"))])
)
_LSQL = (
    f"address = '{addr('tok3')}' AND topic2 IN ({inside([topic(addr('s7')), topic(addr('s9')), topic(addr('s11'))])})"
)
_KEYED = (
    ChainQuery()
    .where("logs", _L)
    .where("transactions", Filter("transactions").where("to", [addr("p7")]))
    .where("traces", Filter("traces").where("reward_type", ["block"]).where("type", ["reward"]))
    .where("blocks", Filter("blocks").where("hash", [sha("b10")]))
)


def _keys_of(result) -> DataFrame:
    """All rows of a result as (table, block, key)."""
    part = {
        "blocks": ("number", "hash"),
        "transactions": ("block_number", "hash"),
        "logs": ("block_number", "log_index"),
        "traces": ("block_number", "transaction_hash"),
    }
    frames = [
        result.tables[t]
        .select(
            F.lit(t).alias("table"),
            F.col(b).alias("block"),
            (F.concat(F.lit("0x"), F.lower(F.hex(k))) if k != "log_index" else F.col(k).cast("string")).alias("key"),
        )
        for t, (b, k) in part.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


_UNION = (
    "SELECT 'blocks' AS \"table\", number AS block, hash AS key FROM rb UNION ALL SELECT 'transactions', "
    "block_number, hash FROM rt UNION ALL SELECT 'logs', block_number, CAST(log_index AS VARCHAR) FROM rl UNION "
    "ALL SELECT 'traces', block_number, transaction_hash FROM rr"
)
_DIRECT_TX, _DIRECT_TRACE, _DIRECT_BLOCK = f"\"to\" = '{addr('p7')}'", "type = 'reward'", f"hash = '{sha('b10')}'"
_REACHED = (
    f"rb AS (SELECT * FROM blocks WHERE {_DIRECT_BLOCK} OR number IN (SELECT block_number FROM rl UNION SELECT "
    f"block_number FROM rt UNION SELECT block_number FROM rr))"
)
_JOINED = {
    "join_default": f", rl AS (SELECT * FROM logs WHERE {_LSQL}), rt AS (SELECT * FROM transactions WHERE {_DIRECT_TX} OR hash IN (SELECT transaction_hash FROM rl)), rr AS (SELECT * FROM traces WHERE {_DIRECT_TRACE} OR transaction_hash IN (SELECT hash FROM rt)), {_REACHED} {_UNION}",
    "join_all": f", k AS (SELECT transaction_hash AS h FROM logs WHERE {_LSQL} UNION SELECT hash FROM transactions WHERE {_DIRECT_TX} UNION SELECT hash FROM transactions WHERE block_number IN (SELECT number FROM blocks WHERE {_DIRECT_BLOCK})), rl AS (SELECT * FROM logs WHERE transaction_hash IN (SELECT h FROM k)), rt AS (SELECT * FROM transactions WHERE hash IN (SELECT h FROM k)), rr AS (SELECT * FROM traces WHERE {_DIRECT_TRACE} OR transaction_hash IN (SELECT h FROM k)), {_REACHED} {_UNION}",
    "join_nothing": f", rl AS (SELECT * FROM logs WHERE {_LSQL}), rt AS (SELECT * FROM transactions WHERE {_DIRECT_TX}), rr AS (SELECT * FROM traces WHERE {_DIRECT_TRACE}), rb AS (SELECT * FROM blocks WHERE {_DIRECT_BLOCK}) {_UNION}",
}
for _name, _sql in _JOINED.items():
    job(_name, _sql)(
        lambda spark, d, t, m=_name[5:]: (
            _keys_of(ChainQuery(**{**_KEYED.__dict__, "join_mode": m, "fields": COLUMNS}).execute(t))
        )
    )
_TO_LOGS = ChainQuery(0, 1000).where("logs", _L).select("blocks", BL)
job("include_all_blocks", f"SELECT {cols(BL)} FROM blocks WHERE number < 1000")(
    lambda spark, d, t: (
        ChainQuery(0, 1000, include_all_blocks=True).where("logs", _L).select("blocks", BL).execute(t).tables["blocks"]
    )
)
job(
    "block_reach",
    f"SELECT {cols(BL)} FROM blocks WHERE number < 1000 AND number IN (SELECT block_number FROM logs WHERE {_LSQL})",
)(lambda spark, d, t: _TO_LOGS.execute(t).tables["blocks"])


def _events(t: dict, tx: list[str], bl: list[str]) -> DataFrame:
    return joins.events(
        t["logs"].where(_L.column()), t["transactions"], t["blocks"], ["log_index", "address", "data"], tx, bl
    )


_EV = 'l.log_index, l.block_number, l.data'
job(
    "events_full_join",
    f"SELECT {_EV}, l.transaction_hash, t.hash AS tx_hash, t.value AS tx_value, b.number AS b_number, b.miner AS "
    f"b_miner FROM logs l LEFT JOIN transactions t ON l.transaction_hash = t.hash LEFT JOIN blocks b ON "
    f"l.block_number = b.number WHERE {_LSQL}",
)(
    lambda spark, d, t: (
        _events(t, ["value"], ["miner"]).select(
            "log.log_index", "log.block_number", "log.data", "log.transaction_hash",
            F.col("transaction.hash").alias("tx_hash"), F.col("transaction.value").alias("tx_value"),
            F.col("block.number").alias("b_number"), F.col("block.miner").alias("b_miner"),
        )
    )
)
job(
    "events_key_only",
    f"SELECT {_EV}, l.transaction_hash AS tx_hash, l.block_number AS b_number FROM logs l WHERE {_LSQL}",
)(
    lambda spark, d, t: (
        _events(t, ["hash"], ["number"]).select(
            "log.log_index", "log.block_number", "log.data", F.col("transaction.hash").alias("tx_hash"),
            F.col("block.number").alias("b_number"),
        )
    )
)
job(
    "events_not_selected",
    f"SELECT l.log_index, l.data, true AS no_transaction, true AS no_block FROM logs l WHERE {_LSQL}",
)(
    lambda spark, d, t: (
        _events(t, [], []).select(
            "log.log_index",
            "log.data",
            F.col("transaction").isNull().alias("no_transaction"),
            F.col("block").isNull().alias("no_block"),
        )
    )
)
job(
    "join_key_injection",
    "SELECT unnest(['address', 'block_number', 'data', 'log_index', 'transaction_hash']) AS log_field, (SELECT "
    "count(*) FROM logs) AS n",
)(
    lambda spark, d, t: (
        joins.events(t["logs"], t["transactions"], t["blocks"], ["log_index", "address", "data"], ["value"], ["miner"])
        .agg(F.count("*").alias("n"))
        .select(
            F.explode(
                F.array(
                    *(
                        F.lit(n)
                        for n in joins
                        .events(
                            t["logs"], t["transactions"], t["blocks"], ["log_index", "address", "data"], ["value"],
                            ["miner"],
                        ).schema["log"].dataType.names
                    )
                )
            )
            .alias("log_field"),
            "n",
        )
    )
)


# Presets

job(
    "preset_blocks_and_transactions",
    f"SELECT {cols(TX, 't.')}, b.miner FROM transactions t JOIN blocks b ON number = block_number WHERE number >= "
    f"{LOW} AND number < {HIGH}",
)(
    lambda spark, d, t: (
        (
            lambda r: (
                r["transactions"]
                .join(r["blocks"].select("number", "miner"), F.col("number") == F.col("block_number"))
                .select(*(f"`{c}`" for c in TX), "miner")
            )
        )(presets.blocks_and_transactions(LOW, HIGH).execute(t).tables)
    )
)
job(
    "preset_blocks_and_transaction_hashes",
    f"SELECT block_hash, block_number, hash FROM transactions WHERE block_number >= {LOW} AND block_number < {HIGH}",
)(lambda spark, d, t: presets.blocks_and_transaction_hashes(LOW, HIGH).execute(t).tables["transactions"])
job(
    "preset_logs",
    f"SELECT {cols(LG)} FROM logs WHERE block_number >= {LOW} AND block_number < {HIGH} AND address = '{addr('tok4')}'",
)(lambda spark, d, t: presets.logs(LOW, HIGH, addr("tok4")).execute(t).tables["logs"].select(*LG))
job(
    "preset_logs_of_event",
    f"SELECT {cols(LG)} FROM logs WHERE block_number >= {LOW} AND block_number < {HIGH} AND address = "
    f"'{addr('tok4')}' AND topic0 = '0x{TRANSFER}'",
)(
    lambda spark, d, t: (
        presets.logs_of_event(LOW, HIGH, "0x" + TRANSFER, addr("tok4")).execute(t).tables["logs"].select(*LG)
    )
)
job(
    "preset_transactions", f"SELECT {cols(TX)} FROM transactions WHERE block_number >= {LOW} AND block_number < {HIGH}"
)(
    lambda spark, d, t: (
        presets.transactions(LOW, HIGH).execute(t).tables["transactions"].select(*(f"`{c}`" for c in TX))
    )
)
job("preset_transactions_from_address", f"SELECT {cols(TX)} FROM transactions WHERE \"from\" = '{addr('c10')}'")(
    lambda spark, d, t: (
        presets.transactions_from_address(0, None, addr("c10"))
        .execute(t).tables["transactions"]
        .select(*(f"`{c}`" for c in TX))
    )
)


# Casts

_VALUE = "CAST('0x' || substr(value, 3) AS BIGINT)"
_KINDS = {
    "float64": "DOUBLE", "float32": "FLOAT", "uint64": "DECIMAL(20,0)", "uint32": "BIGINT", "int64": "BIGINT",
    "int32": "INTEGER", "intstr": "VARCHAR", "decimal128": "DECIMAL(38,0)", "decimal256": "VARCHAR",
}
for _k, _sqltype in _KINDS.items():
    job(f"map_{_k}", f"SELECT hash, CAST({_VALUE} AS {_sqltype}) AS value FROM transactions")(
        lambda spark, d, t, k=_k: column_mapping(t["transactions"].select("hash", "value"), {"value": k})
    )
_SUM = "list_reduce([(strpos('0123456789abcdef', c) - 1)::BIGNUM for c in string_split({}, '')], lambda a, x: " + " + ".join(["a"] * 16) + " + x)"


@job(
    "map_wide",
    f""", w AS (SELECT hash, substr(sha256('w' || hash), 1, CASE block_number % 4 WHEN 0 THEN 62 WHEN 1 THEN 34 ELSE 64 END) AS h FROM transactions),
m AS (SELECT hash, length(h) = 64 AND substr(h, 1, 1) >= '8' AS minus, h FROM w),
d AS (SELECT hash, CASE WHEN minus THEN '-' || ({_SUM.format("translate(h, '0123456789abcdef', 'fedcba9876543210')")} + 1::BIGNUM)::VARCHAR ELSE {_SUM.format("h")}::VARCHAR END AS text FROM m)
SELECT hash, text, text::DOUBLE AS f64, text::FLOAT AS f32, CASE WHEN length(ltrim(text, '-')) <= 76 THEN text END AS d256,
  CASE WHEN length(ltrim(text, '-')) <= 76 THEN right(ltrim(text, '-'), 38)::DECIMAL(38, 0)::VARCHAR END AS low FROM d""",
)
def _wide(spark, d, t):
    """Words of 17, 31 and 32 bytes, half of the last negative, beyond what SQL's own numbers hold."""
    size = F.when(F.col("block_number") % 4 == 0, 31).when(F.col("block_number") % 4 == 1, 17).otherwise(32)
    word = F.substring(F.unhex(F.sha2(F.concat(F.lit("w0x"), F.lower(F.hex("hash"))), 256)), F.lit(1), size)
    low = F.ltrim(decimal256(F.col("word"))["low"].cast("string"), F.lit("-"))
    words = t["transactions"].select("hash", word.alias("word"))
    words = words.select("hash", *(F.col("word").alias(n) for n in ("text", "f64", "f32", "d256")), low.alias("low"))
    return column_mapping(words, {"text": "intstr", "f64": "float64", "f32": "float32", "d256": "decimal256"}, "permissive")


job(
    "column_mapping",
    f"SELECT hash, CAST({_VALUE} AS DOUBLE) AS value, CAST(block_number AS DOUBLE) AS block_number, \"from\" FROM "
    f"transactions",
)(
    lambda spark, d, t: (
        column_mapping(
            t["transactions"].select("hash", "value", "block_number", "from"),
            {"value": "float64", "block_number": "float64", "unknown": "int64"},
        )
    )
)
job("map_l1_fee_scalar", "SELECT hash, CAST('0.' || type AS DOUBLE) AS l1_fee_scalar FROM transactions")(
    lambda spark, d, t: (
        column_mapping(
            t["transactions"].select(
                "hash", F.encode(F.concat(F.lit("0."), F.col("type").cast("string")), "utf-8").alias("l1_fee_scalar")
            ),
            {"l1_fee_scalar": "float64"},
        )
    )
)
job("hex_output", "SELECT hash, substr(hash, 3) AS plain, data FROM (SELECT transaction_hash AS hash, data FROM logs)")(
    lambda spark, d, t: (
        (
            lambda df: hex_output(df).select("hash", F.substring("hash", 3, 64).alias("plain"), "data")
        )(t["logs"].select(F.col("transaction_hash").alias("hash"), "data"))
    )
)
_AMOUNT = "CAST(CASE WHEN length(data) = 66 THEN '0x' || substr(data, 51) END AS BIGINT)"
job(
    "post_process_order",
    f"SELECT '0x' || substr(topic1, 27) AS \"from\", '0x' || substr(topic2, 27) AS \"to\", CAST({_AMOUNT} AS "
    f"DOUBLE) AS amount FROM logs WHERE topic0 = '0x{TRANSFER}'",
)(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing")
        .where("logs", Filter("logs").where("topic0", ["0x" + TRANSFER]))
        .select("logs", LG)
        .execute(t)
        .transform(
            lambda df: abi.decode_logs(df, EVENT[TRANSFER]), True, {"decoded_logs": {"amount": "float64"}}, "prefixed"
        ).decoded_logs
    )
)


# ABI

job(
    "decode_logs",
    "SELECT log_index, block_number, '0x' || substr(topic1, 27) AS \"from\", '0x' || substr(topic2, 27) AS "
    "\"to\", CASE WHEN length(data) = 66 THEN data END AS amount FROM logs",
)(lambda spark, d, t: abi.decode_logs(t["logs"], EVENT[TRANSFER], ("log_index", "block_number")))
job(
    "decode_topic_value",
    "SELECT log_index, block_number, '0x' || substr(topic1, 27) AS account, CASE WHEN topic3 IS NOT NULL THEN "
    "CAST(CAST('0x' || substr(topic3, 51) AS BIGINT) AS VARCHAR) END AS n_topic3 FROM logs",
)(
    lambda spark, d, t: (
        column_mapping(
            t["logs"].select(
                "log_index",
                "block_number",
                abi.decode_topic(F.col("topic1"), "address").alias("account"),
                abi.decode_topic(F.col("topic3"), "uint256").alias("n_topic3"),
            ),
            {"n_topic3": "int64"},
        )
    )
)
job(
    "decode_body_value",
    "SELECT log_index, block_number, length(data) = 66 AS valid, CASE WHEN length(data) = 66 THEN data END AS "
    "amount FROM logs",
)(
    lambda spark, d, t: (
        (
            lambda v: (
                t["logs"].select(
                    "log_index", "block_number", v[0].alias("valid"), F.when(v[0], v[1][0]).alias("amount")
                )
            )
        )(abi.decode_body(F.col("data"), abi.parse_signature("x(uint256 amount)").params))
    )
)


@job(
    "abi_word_types",
    "SELECT hash, status = 1 AS flag, coalesce(\"to\", '0x' || repeat('00', 20)) AS who, 'n-' || block_number AS "
    "name, '0x' || repeat('ab', (block_number % 40)::INT) AS raw FROM transactions",
)
def _word_types(spark, d, t):
    word = lambda n: F.lpad(F.unhex(F.hex(n.cast("bigint"))), 32, bytes(1))
    fill = lambda b: F.concat(b, F.rpad(F.lit(b""), F.pmod(-F.length(b), F.lit(32)), F.lit(bytes(1))))
    name = F.encode(F.concat(F.lit("n-"), F.col("block_number").cast("string")), "utf-8")
    raw = F.unhex(F.repeat(F.lit("ab"), F.pmod("block_number", F.lit(40)).cast("int")))
    head = F.concat(
        word(F.col("status")),
        values.address_to_topic(F.coalesce("to", F.lit(bytes(20)))),
        word(F.lit(128)),
        word(F.lit(160) + F.length(fill(name))),
    )
    data = F.concat(head, word(F.length(name)), fill(name), word(F.length(raw)), fill(raw))
    df = t["transactions"].select("hash", data.alias("data"))
    valid, parts = abi.decode_body(
        F.col("data"), abi.parse_signature("f(bool flag, address who, string name, bytes raw)").params
    )
    return df.select(
        "hash", *(F.when(valid, p).alias(n) for n, p in zip(("flag", "who", "name", "raw"), parts, strict=True))
    )


@job("decode_arrays", """
SELECT hash, '[' || rtrim(repeat("from" || ',', type::INT), ',') || ']' AS receivers,
  '[' || rtrim(repeat('(0x' || lpad(lower(to_hex(block_number)), 64, '0') || ',' || (status = 1)::VARCHAR || '),', type::INT), ',') || ']' AS items FROM transactions""")
def _arrays(spark, d, t):
    word = lambda n: F.lpad(F.unhex(F.hex(n.cast("bigint"))), 32, bytes(1))
    n = F.col("type").cast("int")
    receivers = F.concat(word(n), F.unhex(F.repeat(F.hex(values.address_to_topic(F.col("from"))), n)))
    items = F.concat(word(n), F.unhex(F.repeat(F.hex(F.concat(word(F.col("block_number")), word(F.col("status")))), n)))
    data = F.concat(word(F.lit(64)), word(F.lit(64) + F.length(receivers)), receivers, items)
    signature = "send(address[] to, (uint256 amount, bool last)[] items)"
    data = F.concat(F.lit(abi.parse_signature(signature).selector), data)
    # The generators are barriers: each call is built once and decoded once, not anew for every word that is read of it.
    calls = t["transactions"].select("hash", F.explode(F.array(data)).alias("data"))
    done = calls.select("hash", F.explode(F.array(abi.decode_input(F.col("data"), [signature]))).alias("call"))
    return done.select("hash", F.col("call.params")[0]["value"].alias("receivers"), F.col("call.params")[1]["value"].alias("items"))


def _long(df: DataFrame) -> DataFrame:
    return df.select("*", F.posexplode("params").alias("i", "p")).drop("params")


@job("decode_events_multi", f"""
SELECT log_index, block_number, e.name AS event, i::INT AS i, CASE i WHEN 0 THEN e.a WHEN 1 THEN e.b ELSE 'amount' END AS name, CASE i WHEN 0 THEN '0x' || substr(topic1, 27) WHEN 1 THEN '0x' || substr(topic2, 27) ELSE CASE WHEN length(data) = 66 THEN data END END AS value
FROM logs JOIN (VALUES ('0x{TRANSFER}', 'Transfer', 'from', 'to'), ('0x{APPROVAL}', 'Approval', 'owner', 'spender')) e(t, name, a, b) ON topic0 = e.t, (VALUES (0), (1), (2)) n(i) WHERE topic3 IS NULL""")
def _events_multi(spark, d, t):
    df = (
        abi.decode_events(t["logs"], list(EVENT.values()))
        .where("event is not null")
        .select("log_index", "block_number", "event", "params")
    )
    return _long(df).select("log_index", "block_number", "event", "i", "p.name", "p.value")


_CALLS = [
    "transfer(address dst, uint256 wad)",
    "approve(address usr, uint256 wad)",
    "transferFrom(address src, address dst, uint256 wad)",
]
job(
    "decode_call_input",
    "SELECT hash, CASE sighash WHEN '0xa9059cbb' THEN 'transfer' ELSE 'approve' END AS function, '0x' || "
    "substr(input, 35, 40) AS who, '0x' || substr(input, 75) AS wad FROM transactions",
)(
    lambda spark, d, t: (
        t["transactions"]
        .withColumn("call", abi.decode_input(F.col("input"), _CALLS))
        .select(
            "hash",
            "call.function",
            F.col("call.params")[0]["value"].alias("who"),
            F.col("call.params")[1]["value"].alias("wad"),
        )
    )
)
job(
    "decode_call_output",
    "SELECT transaction_hash, CAST(trace_place AS VARCHAR) AS trace_place, output AS balance FROM traces",
)(
    lambda spark, d, t: (
        t["traces"].select(
            "transaction_hash",
            F.get("trace_address", 0).alias("trace_place"),
            F.get(abi.decode_output(F.col("output"), "balanceOf(address)(uint256)"), 0)["value"].alias("balance"),
        )
    )
)
job(
    "address_to_topic", "SELECT hash, '0x000000000000000000000000' || substr(\"from\", 3) AS topic FROM transactions"
)(lambda spark, d, t: t["transactions"].select("hash", values.address_to_topic(F.col("from")).alias("topic")))


# Values

_HEXED = lambda n: F.concat(F.lit("0x"), F.lower(F.hex(n)))
_EVEN = "'0x' || CASE WHEN length(to_hex(block_number)) % 2 = 1 THEN '0' ELSE '' END || lower(to_hex(block_number))"
job("hex_to_quantity", f"SELECT hash, {_EVEN} AS q FROM transactions")(
    lambda spark, d, t: (
        t["transactions"].select(
            "hash", values.hex_to_quantity(F.concat(F.lit("0x0"), F.lower(F.hex("block_number")))).alias("q")
        )
    )
)
job("number_to_quantity", f"SELECT hash, {_EVEN} AS q FROM transactions")(
    lambda spark, d, t: (
        t["transactions"].select(
            "hash",
            values.number_to_quantity(
                F.when(F.col("type") > 2, _HEXED("block_number")).otherwise(F.col("block_number").cast("string"))
            )
            .alias("q"),
        )
    )
)
job(
    "quantity_to_hex",
    "SELECT hash, '0x' || lower(to_hex(CAST('0x' || substr(value, 3) AS BIGINT))) AS q FROM transactions",
)(lambda spark, d, t: t["transactions"].select("hash", values.quantity_to_hex(F.col("value")).alias("q")))
job("hex_to_data", "SELECT hash, input FROM transactions")(
    lambda spark, d, t: t["transactions"].select("hash", values.hex_to_data(_HEXED("input")).alias("input"))
)
job("hex_to_fixed", "SELECT hash, '0x' || lpad(lower(to_hex(block_number)), 40, '0') AS a FROM transactions")(
    lambda spark, d, t: t["transactions"].select("hash", values.hex_to_fixed(_HEXED("block_number"), 20).alias("a"))
)
job("hex_to_uint64", "SELECT hash, block_number AS n FROM transactions")(
    lambda spark, d, t: t["transactions"].select("hash", values.hex_to_uint64(_HEXED("block_number")).alias("n"))
)
job("tx_status", "SELECT hash, status FROM transactions")(
    lambda spark, d, t: (
        t["transactions"].select(
            "hash",
            values.tx_status(
                F.when(F.col("type") > 2, F.concat(F.lit("0x"), F.col("status").cast("string")))
                .otherwise(F.col("status").cast("string"))
            )
            .alias("status"),
        )
    )
)
job("tx_type", "SELECT hash, type FROM transactions")(
    lambda spark, d, t: (
        t["transactions"].select(
            "hash", values.tx_type(F.concat(F.lit("0x"), F.lower(F.hex(F.col("type").cast("bigint"))))).alias("type")
        )
    )
)
job("split_hashes", "SELECT hash, block_hash || ',' || hash AS parts FROM transactions")(
    lambda spark, d, t: (
        hex_output(t["transactions"].select("hash", values.split_hashes(F.concat("block_hash", "hash")).alias("parts")))
    )
)
job(
    "unpack_nested",
    "SELECT hash, '0x01' AS chain_id, auth_address AS address FROM transactions WHERE auth_address IS NOT NULL",
)(
    lambda spark, d, t: (
        t["transactions"]
        .select("hash", F.explode("authorization_list").alias("a"))
        .select("hash", "a.chain_id", "a.address")
    )
)


# Sinks and streams

@job("write_parquet", f"SELECT {cols(LG)} FROM logs WHERE address = '{addr('tok4')}'")
def _write(spark, d, t):
    path = shared_folder(spark, "out")
    write_parquet(presets.logs(0, None, addr("tok4")).execute(t), path)
    return spark.read.parquet(f"{path}/logs.parquet").select(*LG)


job(
    "collect_tables",
    f", rl AS (SELECT * FROM logs WHERE {_LSQL}) SELECT 'logs' AS \"table\", count(*) AS n FROM rl UNION ALL "
    f"SELECT 'transactions', count(*) FROM transactions WHERE hash IN (SELECT transaction_hash FROM rl)",
)(
    lambda spark, d, t: (
        order.row_counts(
            {
                k: v
                for k, v in ChainQuery()
                .where("logs", _L)
                .select("logs", LG)
                .select("transactions", TX)
                .execute(t).tables
                .items()
                if v is not None
            }
        )
    )
)
job(
    "collect_with_decoded",
    f"SELECT '0x' || substr(topic1, 27) AS \"from\", '0x' || substr(topic2, 27) AS \"to\", CAST({_AMOUNT} AS "
    f"VARCHAR) AS amount FROM logs WHERE {_LSQL}",
)(
    lambda spark, d, t: (
        ChainQuery()
        .where("logs", _L)
        .select("logs", LG)
        .execute(t)
        .transform(
            lambda df: abi.decode_logs(df, EVENT[TRANSFER]),
            mapping={"decoded_logs": {"amount": "intstr"}},
            hex_mode="prefixed",
        ).decoded_logs
    )
)


def _followed(spark, t: dict, table: str, make) -> DataFrame:
    """A stored table read as a stream to its end, through `make`, into Parquet."""
    path, out = _stored(spark, t, table), shared_folder(spark, "stream")
    follow_sink(make(f"{path}/{table}"), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


_STREAMED = ChainQuery().where("logs", Filter("logs").where("topic0", ["0x" + TRANSFER])).select("logs", LG)
_STREAM_SQL = f"SELECT {cols(LG)} FROM logs WHERE topic0 = '0x{TRANSFER}'"
job("stream_query", _STREAM_SQL, by_block=True)(
    lambda spark, d, t: _followed(spark, t, "logs", lambda p: follow.stream_query(spark, p, _STREAMED, "logs"))
)
job("follow_sink", f"SELECT {cols(BL)} FROM blocks")(
    lambda spark, d, t: _followed(spark, t, "blocks", lambda p: follow.stream_table(spark, p, "blocks").select(*BL))
)


@job("follow_head", f"SELECT {cols(LG)} FROM logs WHERE topic0 = '0x{TRANSFER}'", by_block=True)
def _follow_head(spark, d, t):
    """Blocks that arrive in three pages, each followed by its matching logs; started anew after the second page."""
    path, out = _stored(spark, t, "logs"), shared_folder(spark, "head")
    low, high = t["blocks"].agg(F.min("number"), F.max("number") + 1).first()
    cuts = [low, low + (high - low) // 3, low + 2 * (high - low) // 3, high]
    logs = scan(spark, path, "logs").where(_STREAMED.predicates()["logs"])

    def page(batch: DataFrame, epoch: int) -> None:
        first, last = batch.agg(F.min("number"), F.max("number")).first()
        block_range(
            logs, "logs", first, last + 1
        ).select(*LG).write.mode("overwrite").parquet(f"{out}/pages/epoch={epoch}")

    def reorganised(batch: DataFrame, block: int) -> None:
        raise ValueError(f"a block after {block} doesn't continue the chain")

    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        full_shape(
            block_range(t["blocks"], "blocks", start, end), "blocks"
        ).write.mode("append").parquet(f"{out}/blocks")
        follow.follow_with_guard(
            follow.stream_table(spark, f"{out}/blocks", "blocks"), page, reorganised, f"{out}/checkpoint"
        ).awaitTermination()
    return spark.read.parquet(f"{out}/pages").select(*LG)


@job("height_stream", "SELECT max(number) AS height FROM blocks")
def _heights(spark, d, t):
    path, out = _stored(spark, t, "blocks"), shared_folder(spark, "heights")
    done = lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{out}/last")
    follow.heights(spark, f"{path}/blocks").writeStream.outputMode("complete").option(
        "checkpointLocation", f"{out}/checkpoint"
    ).foreachBatch(done).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/last")


job(
    "rollback_guard",
    "SELECT max(number) AS block_number, arg_max(timestamp, number) AS timestamp, arg_max(hash, number) AS hash, "
    "min(number) AS first_block_number, arg_min(parent_hash, number) AS first_parent_hash FROM blocks",
)(lambda spark, d, t: follow.rollback_guard(t["blocks"]))


@job(
    "detect_reorg",
    ", m AS (SELECT max(number) - 10 AS last FROM blocks), n AS (SELECT number, CASE WHEN number > last THEN "
    "'0x' || sha256('x' || hash) ELSE hash END AS hash, parent_hash FROM blocks, m), o AS (SELECT *, lag(hash) "
    "OVER (ORDER BY number) AS before FROM n) SELECT number, parent_hash, before AS stored_hash FROM o WHERE "
    "before <> parent_hash",
)
def _reorg(spark, d, t):
    last = t["blocks"].agg((F.max("number") - 10).alias("last"))
    other = F.unhex(F.sha2(F.concat(F.lit("x0x"), F.lower(F.hex("hash"))), 256))
    return follow.detect_reorg(
        t["blocks"]
        .join(F.broadcast(last))
        .withColumn("hash", F.when(F.col("number") > F.col("last"), other).otherwise(F.col("hash")))
    )


# End-to-end jobs

@job(
    "transfer_stats",
    f"SELECT count({_AMOUNT}) AS n, CAST(sum({_AMOUNT}) AS DOUBLE) AS total, CAST(sum({_AMOUNT}) AS DOUBLE) / "
    f"count({_AMOUNT}) AS mean FROM logs WHERE topic0 = '0x{TRANSFER}'",
)
def _transfer_stats(spark, d, t):
    logs = (
        ChainQuery()
        .where("logs", Filter("logs").where("topic0", ["0x" + TRANSFER]))
        .select("logs", ["data", "topic0", "topic1", "topic2", "topic3"])
        .execute(t).tables["logs"]
    )
    amounts = column_mapping(abi.decode_logs(logs, EVENT[TRANSFER]).select("amount"), {"amount": "float64"})
    return amounts.agg(
        F.count("amount").alias("n"),
        F.sum("amount").alias("total"),
        (F.sum("amount") / F.count("amount")).alias("mean"),
    )


_WALLETS = [addr(f"c{i}") for i in range(1, 60)] + [addr("s5"), addr("p9")]
_WTOPICS = [topic(w) for w in _WALLETS]


@job(
    "wallet_activity",
    f"SELECT 'log' AS kind, block_number, transaction_hash AS hash FROM logs WHERE topic0 = '0x{TRANSFER}' AND "
    f"(topic1 IN ({inside(_WTOPICS)}) OR topic2 IN ({inside(_WTOPICS)})) UNION ALL SELECT 'transaction', "
    f"block_number, hash FROM transactions WHERE \"from\" IN ({inside(_WALLETS)}) OR \"to\" IN "
    f"({inside(_WALLETS)})",
)
def _wallets(spark, d, t):
    transfers = Filter("logs").where("topic0", ["0x" + TRANSFER])
    q = (
        ChainQuery(join_mode="nothing")
        .where("logs", transfers.where("topic1", _WTOPICS), transfers.where("topic2", _WTOPICS))
        .where(
            "transactions", Filter("transactions").where("from", _WALLETS), Filter("transactions").where("to", _WALLETS)
        )
    )
    r = q.select(
        "logs", ["block_number", "transaction_hash"]
    ).select("transactions", ["block_number", "hash"]).execute(t).tables
    return (
        r["logs"]
        .select(F.lit("log").alias("kind"), "block_number", F.col("transaction_hash").alias("hash"))
        .union(r["transactions"].select(F.lit("transaction"), "block_number", "hash"))
    )


job(
    "wallet_reverse",
    f"SELECT block_number, transaction_index, hash, value FROM transactions WHERE \"from\" IN "
    f"({inside(_WALLETS)}) OR \"to\" IN ({inside(_WALLETS)}) ORDER BY block_number DESC, transaction_index DESC",
)(
    lambda spark, d, t: (
        ChainQuery(join_mode="nothing")
        .where(
            "transactions", Filter("transactions").where("from", _WALLETS), Filter("transactions").where("to", _WALLETS)
        )
        .select("transactions", ["block_number", "transaction_index", "hash", "value"])
        .execute(t)
        .transform(reverse=True).tables["transactions"]
    )
)
job(
    "call_watch",
    f"SELECT hash, '0x' || substr(input, 35, 40) AS dst, '0x' || substr(input, 75) AS wad FROM transactions WHERE "
    f"\"to\" IN ('{addr('p4')}', '{addr('p8')}') AND sighash = '0xa9059cbb'",
)(
    lambda spark, d, t: (
        t["transactions"]
        .where(
            Filter("transactions")
            .where("to", [addr("p4"), addr("p8")])
            .where("sighash", ["0xa9059cbb", "0x23b872dd"])
            .column()
        )
        .withColumn("call", abi.decode_input(F.col("input"), [_CALLS[0], _CALLS[2]]))
        .select("hash", F.col("call.params")[0]["value"].alias("dst"), F.col("call.params")[1]["value"].alias("wad"))
    )
)
job("balance_calls", f"SELECT transaction_hash, CAST(trace_place AS VARCHAR) AS trace_place, '0x' || substr(input, 35, 40) AS owner, CAST('0x' || substr(output, 51) AS BIGINT) AS balance FROM traces WHERE \"to\" = '{addr('tok6')}' AND sighash = '0x70a08231'")(
    lambda spark, d, t: column_mapping(
        t["traces"].where(Filter("traces").where("to", [addr("tok6")]).where("sighash", ["0x70a08231"]).column()).select(
            "transaction_hash", F.get("trace_address", 0).alias("trace_place"), abi.decode_input(F.col("input"), ["balanceOf(address owner)"])["params"][0]["value"].alias("owner"),
            F.unhex(F.substring(F.get(abi.decode_output(F.col("output"), "balanceOf(address)(uint256)"), 0)["value"], 3, 64)).alias("balance")),
        {"balance": "int64"})
)
job("pool_creations", f"SELECT l.block_number, l.log_index, '0x' || substr(topic1, 27) AS owner, '0x' || substr(topic2, 27) AS spender, CASE WHEN length(data) = 66 THEN data END AS amount, t.\"from\" AS tx_from, b.timestamp AS block_time FROM logs l JOIN transactions t ON l.transaction_hash = t.hash JOIN blocks b ON b.number = l.block_number WHERE l.address = '{addr('tok2')}' AND topic0 = '0x{APPROVAL}'")(
    lambda spark, d, t: (lambda r: abi.decode_logs(r["logs"], EVENT[APPROVAL], ("block_number", "log_index", "transaction_hash")).join(r["transactions"].select(F.col("hash").alias("transaction_hash"), "block_number", F.col("from").alias("tx_from")), ["block_number", "transaction_hash"]).join(r["blocks"].select(F.col("number").alias("block_number"), F.col("timestamp").alias("block_time")), "block_number").drop("transaction_hash"))(
        ChainQuery().where("logs", Filter("logs").where("address", [addr("tok2")]).where("topic0", ["0x" + APPROVAL])).select("logs", LG).select("transactions", TX).select("blocks", BL).execute(t).tables)
)

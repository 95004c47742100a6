"""Registered queries of pages, streams with joins, and reorganisations; the tables and the SQL's are those of `jobs`."""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions import abi
from loomspark.functions.cast import hex_output
from loomspark.jobs import EVENT, LG, TX, cols, job
from loomspark.operators import order
from loomspark.operators.filters import Filter
from loomspark.plans.pages import page_log, run_pages
from loomspark.plans.query import ChainQuery, full_shape
from loomspark.schema import BLOCK_COLUMN, SCHEMAS
from loomspark.sinks import follow_sink, shared_folder
from loomspark.sources import ingest
from loomspark.sources.clustered import scan_clustered, slices, store_clustered
from loomspark.sources.fixtures import TRANSFER
from loomspark.streaming import joined, reorg

_TRANSFERS = ChainQuery().where("logs", Filter("logs").where("topic0", ["0x" + TRANSFER]))
_RECENT = ", m AS (SELECT max(number) AS top FROM blocks)"

# Pages

_COUNTS = f""", rl AS (SELECT block_number, transaction_hash FROM logs WHERE topic0 = '0x{TRANSFER}'),
k AS (SELECT DISTINCT block_number, transaction_hash FROM rl),
c AS (SELECT number, CAST(sum(b) AS BIGINT) AS nb, CAST(sum(t) AS BIGINT) AS nt, CAST(sum(l) AS BIGINT) AS nl, CAST(sum(r) AS BIGINT) AS nr FROM (
  SELECT DISTINCT block_number AS number, 1 AS b, 0 AS t, 0 AS l, 0 AS r FROM rl UNION ALL SELECT block_number, 0, 1, 0, 0 FROM k UNION ALL
  SELECT block_number, 0, 0, 1, 0 FROM rl UNION ALL SELECT block_number, 0, 0, 0, 1 FROM traces SEMI JOIN k USING (block_number, transaction_hash)) GROUP BY number),
s AS MATERIALIZED (SELECT number, sum(nb) OVER o AS b, sum(nt) OVER o AS t, sum(nl) OVER o AS l, sum(nr) OVER o AS r, sum(nb) OVER o - nb AS b0, sum(nt) OVER o - nt AS t0, sum(nl) OVER o - nl AS l0, sum(nr) OVER o - nr AS r0 FROM c WINDOW o AS (ORDER BY number)),
"""


def _pages_sql(limits: str) -> str:
    """`limits`: a query of one row (lb, lt, ll), of which a null is no limit. For each block with rows, the block that ends
    a page which begins there; from page to page by recursion."""
    return f"""{_COUNTS}lim AS (SELECT * FROM ({limits}) x(lb, lt, ll)), e AS (SELECT max(number) + 1 AS hi FROM blocks),
j AS MATERIALIZED (SELECT a.*, lag(a.number) OVER (ORDER BY a.number) AS before, (SELECT min(z.number) FROM s z, lim WHERE z.number >= a.number AND (z.b - a.b0 >= lb OR z.t - a.t0 >= lt OR z.l - a.l0 >= ll)) AS last FROM s a),
pages AS (WITH RECURSIVE p AS (SELECT CAST(0 AS BIGINT) AS from_block, coalesce(last + 1, hi) AS next_block, number AS first FROM j, e WHERE before IS NULL
  UNION ALL SELECT p.next_block, coalesce(f.last + 1, e.hi), f.number FROM p, e, j f WHERE f.number >= p.next_block AND f.before < p.next_block AND p.next_block < e.hi)
  SELECT p.from_block, p.next_block, y.b - f.b0 AS n_blocks, y.t - f.t0 AS n_transactions, y.l - f.l0 AS n_logs, y.r - f.r0 AS n_traces
  FROM p JOIN j f ON f.number = p.first JOIN (SELECT number, b, t, l, r, coalesce(lead(number) OVER (ORDER BY number), 1000000000) AS after FROM s) y ON y.number < p.next_block AND y.after >= p.next_block)
"""


job(
    "page_log",
    _pages_sql("SELECT 40, 300, 500")
    + "SELECT from_block, next_block, n_blocks::BIGINT AS n_blocks, n_transactions::BIGINT AS n_transactions, n_logs::BIGINT AS n_logs, n_traces::BIGINT AS n_traces FROM pages",
)(lambda spark, d, t: page_log(_TRANSFERS.limit(blocks=40, transactions=300, logs=500), t, step=700))


def _fold(spark, d, t):
    """Five pages or so of the Transfer logs, each written by its own turn of the loop; the fold of their log."""
    n = t["logs"].where(_TRANSFERS.predicates()["logs"]).count()
    path = shared_folder(spark, "paged")

    def write(page, result) -> None:
        result.tables["logs"].write.parquet(f"{path}/from={page.from_block}")

    log = run_pages(_TRANSFERS.limit(logs=n // 5 + 1).select("logs", LG), t, write)
    folded = order.reduce_pages(log)
    rows = spark.read.parquet(path).agg(F.count("*").alias("n_rows"))
    pages = log.agg(F.count("*").alias("n_pages"), F.sum("n_logs").alias("n_logs"))
    return folded.select("archive_height", "next_block", (F.col("total_execution_time") > 0).alias("timed")).join(pages).join(rows)


job(
    "collect_reduce",
    _pages_sql(f"SELECT CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), (SELECT count(*) FROM logs WHERE topic0 = '0x{TRANSFER}') // 5 + 1")
    + "SELECT (SELECT max(number) FROM blocks) AS archive_height, max(next_block) AS next_block, true AS timed, count(*) AS n_pages, sum(n_logs)::BIGINT AS n_logs, sum(n_logs)::BIGINT AS n_rows FROM pages",
)(_fold)


# Decoding of bad logs, and by many signatures

@job(
    "decode_logs_lenient",
    "SELECT log_index, block_number, CASE WHEN log_index % 3 <> 0 THEN '0x' || substr(topic1, 27) END AS \"from\", '0x' || substr(topic2, 27) AS \"to\", CASE WHEN length(data) = 66 AND log_index % 4 <> 0 THEN data END AS amount FROM logs",
)
def _lenient(spark, d, t):
    """Logs of which some have an address with a wrong first byte or half a word of data: null there, and the rest is kept."""
    wrong = F.when(F.col("log_index") % 3 == 0, F.concat(F.unhex(F.lit("ff")), F.substring("topic1", 2, 31))).otherwise(F.col("topic1"))
    short = F.when(F.col("log_index") % 4 == 0, F.substring("data", 1, 16)).otherwise(F.col("data"))
    return abi.decode_logs(t["logs"].withColumns({"topic1": wrong, "data": short}), EVENT[TRANSFER], ("log_index", "block_number"), strict=False)


@job(
    "decode_events_catalog",
    f"SELECT log_index, block_number, CASE topic0 WHEN '0x{TRANSFER}' THEN 'Transfer' ELSE 'Approval' END AS event, CASE topic0 WHEN '0x{TRANSFER}' THEN 'from,to,amount' ELSE 'owner,spender,amount' END AS names FROM logs WHERE topic3 IS NULL",
)
def _catalog(spark, d, t):
    """A thousand signatures of a few layouts, of which two match."""
    kinds = ("uint256 a, address indexed b", "address indexed a, address indexed b, uint256 c", "bytes32 a, string b", "uint8[] a")
    many = [f"Other{i}({kinds[i % 4]})" for i in range(1000)]
    found = abi.decode_events(t["logs"], many[:500] + list(EVENT.values()) + many[500:]).where("event is not null")
    return found.select("log_index", "block_number", "event", F.array_join(F.transform("params", lambda p: p["name"]), ",").alias("names"))


# Documents that don't fit

@job(
    "ingest_quarantine",
    """SELECT hash, CASE WHEN block_number % 5 = 0 THEN 'not a document' WHEN block_number % 5 = 1 THEN 'missing: block_number' WHEN block_number % 5 = 2 THEN 'malformed: from,malformed: value' END AS reasons
FROM transactions""",
)
def _quarantine(spark, d, t):
    """Transactions as documents, of which some are cut off, lack a field or hold what is no value; the rest become rows."""
    hexed = hex_output(t["transactions"].select("hash", "from", "input", "transaction_index", "block_number", "block_hash"))
    whole = {"hash": "hash", "from": "from", "input": "input", "block_hash": "blockHash"}
    parts = [F.col(f"`{a}`").alias(b) for a, b in whole.items()] + [F.lit("0x1").alias(n) for n in ("gas", "nonce", "transactionIndex")]
    k = F.col("block_number") % 5
    number = F.when(k != 1, F.concat(F.lit("0x"), F.hex("block_number"))).alias("blockNumber")
    value = F.when(k == 2, F.lit("many")).otherwise(F.lit("0x5")).alias("value")
    sender = F.when(k == 2, F.concat("from", F.lit("zz"))).otherwise(F.col("from")).alias("from")
    text = F.to_json(F.struct(*(sender if p is parts[1] else p for p in parts), number, value))
    docs = hexed.select("hash", k.alias("k"), text.alias("json"))
    docs = docs.select("hash", F.when(F.col("k") == 0, F.substring("json", 1, 40)).otherwise(F.col("json")).alias("json"))
    good, bad = ingest.sorted_out(docs, "transactions")
    rows = ingest.rpc_transactions(good).select(F.concat(F.lit("0x"), F.lower(F.hex("hash"))).alias("hash"), F.lit(None).cast("string").alias("reasons"))
    return rows.union(bad.select("hash", F.array_join(F.array_sort("reasons"), ",")))


# Clustered tables, and keys that are found once

_SOME = "0x" + hashlib.sha256(b"tok7").hexdigest()[:40]


@job("scan_clustered", f"SELECT {cols(LG)} FROM logs WHERE address = '{_SOME}' AND block_number >= 300 AND block_number < 1700", by_block=True)
def _clustered(spark, d, t):
    path = shared_folder(spark, "clustered")
    store_clustered({"logs": full_shape(t["logs"], "logs")}, path, rows=10_000)
    query = ChainQuery(join_mode="nothing").where("logs", Filter("logs").where("address", [_SOME]))
    return scan_clustered(spark, path, "logs", 300, 1700).where(query.predicates()["logs"]).select(*LG)


@job(
    "clustered_manifest",
    ", c AS (SELECT block_number AS number, count(*) AS n FROM logs GROUP BY 1), s AS (SELECT *, CAST((sum(n) OVER (ORDER BY number) - n) // 10000 AS BIGINT) AS slice FROM c) "
    "SELECT slice, min(number) AS first_block, max(number) AS last_block, CAST(sum(n) AS BIGINT) AS n_rows FROM s GROUP BY slice",
)
def _slices(spark, d, t):
    return slices(t["logs"], "logs", 10_000).groupBy("slice").agg(
        F.min("number").alias("first_block"), F.max("number").alias("last_block"), F.sum("n").alias("n_rows")
    )


@job(
    "join_stored_keys",
    f", rl AS (SELECT * FROM logs WHERE topic0 = '0x{TRANSFER}') SELECT 'logs' AS \"table\", count(*) AS n FROM rl UNION ALL SELECT 'transactions', count(*) FROM transactions WHERE hash IN (SELECT transaction_hash FROM rl) "
    "UNION ALL SELECT 'traces', count(*) FROM traces WHERE transaction_hash IN (SELECT transaction_hash FROM rl) UNION ALL SELECT 'blocks', count(*) FROM blocks WHERE number IN (SELECT block_number FROM rl)",
)
def _stored_keys(spark, d, t):
    query = replace(_TRANSFERS, fields={n: [BLOCK_COLUMN[n]] for n in SCHEMAS})
    return order.row_counts(query.execute(t, shared_folder(spark, "keys")).tables)


# Streams with joins

def _arriving(spark, tables: dict, *names: str) -> str:
    """Tables below a folder, in files that arrive in another order for each of them: each third is written once, and its
    files are named into the folder, with the times at which they come."""
    path, low_high = shared_folder(spark, "arriving"), tables["blocks"].agg(F.min("number"), F.max("number") + 1).first()
    cuts = [low_high[0] + (low_high[1] - low_high[0]) * i // 3 for i in range(4)]
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for k, name in enumerate(names):
        number = F.col(BLOCK_COLUMN[name])
        third = F.when(number < cuts[1], 0).when(number < cuts[2], 1).otherwise(2)
        whole = shared_folder(spark, f"whole-{name}")
        # Columns that the table lacks are read as nulls by the stream's schema, so they aren't written.
        full_shape(tables[name], name).select(*(f"`{c}`" for c in tables[name].columns), third.alias("_third")).write.partitionBy("_third").parquet(whole)
        fs.mkdirs(at(f"{path}/{name}"))
        times = sorted(f.getModificationTime() for p in range(3) if fs.exists(at(f"{whole}/_third={p}")) for f in fs.listStatus(at(f"{whole}/_third={p}")))
        for turn, p in enumerate(sorted(range(3), key=lambda p: (p + k) % 3)):
            for f in fs.listStatus(at(f"{whole}/_third={p}")) if fs.exists(at(f"{whole}/_third={p}")) else []:
                arrived = at(f"{path}/{name}/{p}-{f.getPath().getName()}")
                if not fs.rename(f.getPath(), arrived):
                    raise OSError(f"{f.getPath()} can't be moved to {arrived}")
                fs.setTimes(arrived, times[-1] + 1000 * turn, -1)
    return path


def _drained(stream: DataFrame) -> DataFrame:
    out = shared_folder(stream.sparkSession, "drained")
    follow_sink(stream, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return stream.sparkSession.read.parquet(f"{out}/rows")


@job(
    "stream_events",
    f"SELECT l.log_index, l.block_number, l.data, l.transaction_hash, t.value AS tx_value, b.miner AS b_miner FROM logs l LEFT JOIN transactions t ON l.transaction_hash = t.hash "
    f"LEFT JOIN blocks b ON l.block_number = b.number WHERE l.topic0 = '0x{TRANSFER}'",
    by_block=True,
)
def _stream_events(spark, d, t):
    path = _arriving(spark, t, "logs", "transactions", "blocks")
    found = joined.stream_events(spark, path, _TRANSFERS, ["log_index", "data"], ["value"], ["miner"], late=10_000, files=4)
    return _drained(found).select(
        "log.log_index", "log.block_number", "log.data", "log.transaction_hash", F.col("transaction.value").alias("tx_value"), F.col("block.miner").alias("b_miner")
    )


@job("stream_joined", f"SELECT {cols(TX)} FROM transactions WHERE hash IN (SELECT transaction_hash FROM logs WHERE topic0 = '0x{TRANSFER}') OR type = 3", by_block=True)
def _stream_joined(spark, d, t):
    path = _arriving(spark, t, "logs", "transactions")
    query = _TRANSFERS.where("transactions", Filter("transactions").where("type", [3])).select("transactions", TX)
    return _drained(joined.stream_joined(spark, path, query, "transactions", late=10_000, files=4))


# Reorganisations

def _forked(spark, t) -> DataFrame:
    """Events of a feed whose pages turn away three times: branches a, b and c of the last sixty numbers, each from a
    block of the one before; the follower is started anew for every page."""
    where = shared_folder(spark, "forks")
    top = t["blocks"].agg(F.max("number")).first()[0]
    rows = t["blocks"].select("number", "hash", "parent_hash")
    named = lambda c, b: F.unhex(F.sha2(F.concat(F.lit(b + "0x"), F.lower(F.hex(c))), 256))

    def branch(name: str, before: str | None, fork: int, end: int) -> DataFrame:
        """Blocks after `fork` up to `end`; the first one's parent is of the branch before."""
        own = rows.where((F.col("number") > top + fork) & (F.col("number") <= top + end))
        first = own.agg(F.min("number").alias("first"))
        parent = F.when(F.col("number") > F.col("first"), named("parent_hash", name)).otherwise(named("parent_hash", before) if before else F.col("parent_hash"))
        return own.join(F.broadcast(first)).select("number", named("hash", name).alias("hash"), parent.alias("parent_hash"))

    pages = [rows.where(F.col("number") <= top - 20), branch("a", None, -30, -10), branch("b", None, -35, -5), branch("c", "b", -15, 0)]
    for page in pages:
        full_shape(page, "blocks").coalesce(1).write.mode("append").parquet(f"{where}/blocks")
        reorg.follow_chain(reorg.headers(spark, f"{where}/blocks"), f"{where}/events", f"{where}/checkpoint").awaitTermination()
    return reorg.events_of(spark, f"{where}/events")


_BRANCH = "'0x' || sha256('{}' || hash)"


@job(
    "reorg_rollback",
    f"{_RECENT} SELECT number, CASE WHEN number > top - 15 THEN {_BRANCH.format('c')} WHEN number > top - 35 THEN {_BRANCH.format('b')} ELSE hash END AS hash, "
    f"CAST(CASE WHEN number > top - 15 THEN 3 WHEN number > top - 35 THEN 2 ELSE 0 END AS BIGINT) AS version FROM blocks, m",
)
def _rollback(spark, d, t):
    return reorg.canonical(_forked(spark, t)).select("number", "hash", "version")


@job(
    "reorg_forks",
    f"{_RECENT}, f(version, fork, had) AS (VALUES (1, -30, -20), (2, -35, -10), (3, -15, -5)) SELECT CAST(version AS BIGINT) AS version, "
    "max(number) FILTER (WHERE number <= top + fork) AS fork_block, count(*) FILTER (WHERE number > top + fork AND number <= top + had) AS n_withdrawn "
    "FROM blocks, m, f GROUP BY version",
)
def _forks(spark, d, t):
    return reorg.forks(_forked(spark, t)).select("version", "fork_block", "n_withdrawn")

"""Chain-shaped tables derived from `orders` and `lineitem`, once as Spark frames and once as DuckDB SQL.

Both are templates with the same macros: B(x) is a binary from hex digits (in DuckDB 0x text), H(x) the SHA-256 of a text
in hex, and DAY the days from 1995-01-01 to a timestamp. Spark's own forms of three tables (`NARROW`) say the same, but
send only keys and small values through shuffles and sorts: hashes, of which a row holds up to 200 bytes, are computed
behind them. A line is shuffled once by its order, in packed form, and once by its block, with its place in the order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.schema import SCHEMAS

TRANSFER = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL = "8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
_ADDR = lambda x: f"substr(H({x}), 1, 40)"
_PAD = lambda x: f"'000000000000000000000000' || {_ADDR(x)}"
_Q = lambda n: f"lower(CASE WHEN length(hex({n})) % 2 = 1 THEN '0' || hex({n}) ELSE hex({n}) END)"
_WORD = lambda n: f"lpad(lower(hex({n})), 64, '0')"
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"

TABLES = {
    "blocks": f"""
SELECT number, B(H('b' || number)) AS hash, B(CASE WHEN before IS NULL THEN H('genesis') ELSE H('b' || before) END) AS parent_hash,
  B({_ADDR("'m' || number % 7")}) AS miner, B({_Q("CAST(788918400 + number * 86400 AS BIGINT)")}) AS timestamp, B({_Q("CAST(30000000 + number AS BIGINT)")}) AS gas_limit
FROM (SELECT number, lag(number) OVER (ORDER BY number) AS before FROM (SELECT DISTINCT DAY AS number FROM orders))""",
    "transactions": f"""
SELECT B(H('b' || DAY)) AS block_hash, DAY AS block_number, B({_ADDR("'c' || o_custkey")}) AS "from", B(H('t' || o_orderkey)) AS hash,
  B(CASE WHEN o_orderkey % 2 = 0 THEN 'a9059cbb' ELSE '095ea7b3' END || {_PAD("'p' || o_orderkey % 50")} || {_WORD(_CENTS)}) AS input,
  B(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_ADDR("'p' || o_orderkey % 50")} END) AS "to",
  row_number() OVER (PARTITION BY DAY ORDER BY o_orderkey) - 1 AS transaction_index, B({_Q(_CENTS)}) AS value, B({_Q("CAST(1 AS BIGINT)")}) AS chain_id,
  B(CASE WHEN o_orderkey % 10 = 0 THEN {_ADDR("'k' || o_orderkey")} END) AS contract_address, CAST(o_orderkey % 5 AS SMALLINT) AS type,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS SMALLINT) AS status, B(CASE WHEN o_orderkey % 2 = 0 THEN 'a9059cbb' ELSE '095ea7b3' END) AS sighash,
  B(CASE WHEN o_orderkey % 5 = 4 THEN {_ADDR("'a' || o_orderkey % 7")} END) AS auth_address
FROM orders""",
    "logs": f"""
SELECT false AS removed, row_number() OVER (PARTITION BY t.block_number ORDER BY t.transaction_hash, {LINE}) - 1 AS log_index, t.transaction_index, t.transaction_hash, t.block_hash, t.block_number,
  B({_ADDR("'tok' || l_partkey % 20")}) AS address, B(CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN '' ELSE {_WORD(_QTY)} END) AS data,
  B(CASE WHEN l_returnflag = 'N' THEN '{TRANSFER}' ELSE '{APPROVAL}' END) AS topic0, B({_PAD("'c' || o_custkey")}) AS topic1, B({_PAD("'s' || l_suppkey")}) AS topic2,
  B(CASE WHEN l_linenumber = 7 THEN {_WORD("l_suppkey")} END) AS topic3
FROM lineitem JOIN (SELECT o_orderkey, o_custkey, DAY AS block_number, B(H('b' || DAY)) AS block_hash, B(H('t' || o_orderkey)) AS transaction_hash,
  row_number() OVER (PARTITION BY DAY ORDER BY o_orderkey) - 1 AS transaction_index FROM orders) t ON l_orderkey = o_orderkey""",
    "traces": f"""
SELECT B({_ADDR("'c' || o_custkey")}) AS "from", B({_ADDR("'tok' || l_partkey % 20")}) AS "to", CASE WHEN l_linestatus = 'O' THEN 'call' ELSE 'delegatecall' END AS call_type,
  B('70a08231' || {_PAD("'c' || o_custkey")}) AS input, B({_Q(_QTY)}) AS value, B(NULL) AS author, CAST(NULL AS STRING) AS reward_type, t.block_hash, t.block_number,
  B({_WORD(_QTY)}) AS output, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE}) - 1 AS trace_place, t.transaction_hash, t.transaction_position, 'call' AS type, B('70a08231') AS sighash,
  B(CASE WHEN l_linenumber = 2 THEN {_ADDR("'k' || l_partkey % 20")} END) AS address
FROM lineitem JOIN (SELECT o_orderkey, o_custkey, DAY AS block_number, B(H('b' || DAY)) AS block_hash, B(H('t' || o_orderkey)) AS transaction_hash,
  row_number() OVER (PARTITION BY DAY ORDER BY o_orderkey) - 1 AS transaction_position FROM orders) t ON l_orderkey = o_orderkey WHERE l_linenumber <= 2
UNION ALL
SELECT B(NULL), B(NULL), NULL, B(NULL), B('1bc16d674ec80000'), B({_ADDR("'m' || number % 7")}), 'block', B(H('b' || number)), number, B(NULL), NULL, B(NULL), NULL, 'reward', B(NULL), B(NULL)
FROM (SELECT DISTINCT DAY AS number FROM orders)""",
}


_LINE = LINE.split(", ")
#: Values of a line that make up a few bits each, where that is exact (else they go as they are): price in cents, discount
#: and tax in hundredths, whole days; then supplier, line number, quantity and the two flags.
_CENTS_OF = "try_cast(round(l_extendedprice * 100) AS BIGINT)"
_HUNDREDTHS = lambda c: f"try_cast(round({c} * 100) AS BIGINT)"
_DAYS = "datediff(l_shipdate, DATE'1970-01-01')"
_EXACT = f"""coalesce({_CENTS_OF} BETWEEN 0 AND 4294967295 AND {_CENTS_OF} / 100D = l_extendedprice AND {_HUNDREDTHS("l_discount")} BETWEEN 0 AND 255 AND {_HUNDREDTHS("l_discount")} / 100D = l_discount
  AND {_HUNDREDTHS("l_tax")} BETWEEN 0 AND 255 AND {_HUNDREDTHS("l_tax")} / 100D = l_tax AND {_DAYS} BETWEEN 0 AND 65535 AND CAST(date_add(DATE'1970-01-01', {_DAYS}) AS TIMESTAMP) = CAST(l_shipdate AS TIMESTAMP)
  AND l_suppkey BETWEEN 0 AND 268435455 AND l_linenumber BETWEEN 0 AND 255 AND try_cast(l_quantity AS BIGINT) BETWEEN 0 AND 4095 AND try_cast(l_quantity AS BIGINT) = l_quantity
  AND length(l_returnflag) = 1 AND ascii(l_returnflag) BETWEEN 1 AND 127 AND length(l_linestatus) = 1 AND ascii(l_linestatus) BETWEEN 1 AND 127, false)"""
_PACKED = f"""SELECT l_orderkey, l_partkey, CASE WHEN exact THEN shiftleft({_CENTS_OF}, 32) | shiftleft({_HUNDREDTHS("l_discount")}, 24) | shiftleft({_HUNDREDTHS("l_tax")}, 16) | {_DAYS} END AS money,
  CASE WHEN exact THEN shiftleft(l_suppkey, 34) | shiftleft(CAST(l_linenumber AS BIGINT), 26) | shiftleft(CAST(l_quantity AS BIGINT), 14) | shiftleft(ascii(l_returnflag), 7) | ascii(l_linestatus) END AS rest,
  CASE WHEN NOT exact THEN struct({", ".join(_LINE[2:])}) END AS plain
FROM (SELECT *, {_EXACT} AS exact FROM lineitem)"""
_BITS = lambda c, at, n: f"(shiftrightunsigned({c}, {at}) & {(1 << n) - 1})"
_UNPACKED = {
    "l_suppkey": _BITS("rest", 34, 28), "l_linenumber": f"CAST({_BITS('rest', 26, 8)} AS INT)", "l_quantity": f"CAST({_BITS('rest', 14, 12)} AS DOUBLE)",
    "l_extendedprice": f"{_BITS('money', 32, 32)} / 100D", "l_discount": f"{_BITS('money', 24, 8)} / 100D", "l_tax": f"{_BITS('money', 16, 8)} / 100D",
    "l_returnflag": f"chr({_BITS('rest', 7, 7)})", "l_linestatus": f"chr({_BITS('rest', 0, 7)})",
    "l_shipdate": "date_add(DATE'1970-01-01', CAST(money & 65535 AS INT))",
}
_LINES = f"""SELECT l_orderkey, l_partkey, day, o_custkey, transaction_index, {", ".join(f"CASE WHEN plain IS NULL THEN {x} ELSE plain.{c} END AS {c}" for c, x in _UNPACKED.items())}
FROM ({_PACKED}) JOIN (SELECT o_orderkey, o_custkey, DAY AS day, row_number() OVER (PARTITION BY DAY ORDER BY o_orderkey) - 1 AS transaction_index FROM orders) ON l_orderkey = o_orderkey"""
_ORDERED = ", ".join(_LINE[1:])
#: What a log keeps of its line, in one number where it fits.
_SMALL = {
    "place": f"CAST({_BITS('bits', 51, 12)} AS INT)", "quantity": _BITS("bits", 39, 12), "part": _BITS("bits", 34, 5), "bare": f"{_BITS('bits', 33, 1)} = 1",
    "sent": f"{_BITS('bits', 32, 1)} = 1", "seventh": f"{_BITS('bits', 31, 1)} = 1", "l_suppkey": _BITS("bits", 0, 31),
}
#: Addresses of the usual twenty tokens are constants of the plan.
_TOKEN = f"CASE WHEN part BETWEEN 0 AND 19 THEN element_at(array({', '.join(f'B({_ADDR(chr(39) + "tok" + str(i) + chr(39))})' for i in range(20))}), CAST(part AS INT) + 1) ELSE B({_ADDR("'tok' || part")}) END"

#: Spark's forms of tables whose rows are shuffled; DEAL is the hint that deals logs by their block.
NARROW = {
    "transactions": f"""
SELECT B(H('b' || day)) AS block_hash, day AS block_number, B({_ADDR("'c' || o_custkey")}) AS "from", B(H('t' || o_orderkey)) AS hash,
  B(CASE WHEN o_orderkey % 2 = 0 THEN 'a9059cbb' ELSE '095ea7b3' END || {_PAD("'p' || o_orderkey % 50")} || {_WORD(_CENTS)}) AS input,
  B(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE {_ADDR("'p' || o_orderkey % 50")} END) AS "to",
  transaction_index, B({_Q(_CENTS)}) AS value, B({_Q("CAST(1 AS BIGINT)")}) AS chain_id,
  B(CASE WHEN o_orderkey % 10 = 0 THEN {_ADDR("'k' || o_orderkey")} END) AS contract_address, CAST(o_orderkey % 5 AS SMALLINT) AS type,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS SMALLINT) AS status, B(CASE WHEN o_orderkey % 2 = 0 THEN 'a9059cbb' ELSE '095ea7b3' END) AS sighash,
  B(CASE WHEN o_orderkey % 5 = 4 THEN {_ADDR("'a' || o_orderkey % 7")} END) AS auth_address
FROM (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, DAY AS day, row_number() OVER (PARTITION BY DAY ORDER BY o_orderkey) - 1 AS transaction_index FROM orders)""",
    "logs": f"""
SELECT false AS removed, log_index, transaction_index, transaction_hash, B(H('b' || day)) AS block_hash, day AS block_number,
  {_TOKEN} AS address, B(CASE WHEN bare THEN '' ELSE {_WORD("quantity")} END) AS data,
  B(CASE WHEN sent THEN '{TRANSFER}' ELSE '{APPROVAL}' END) AS topic0, B({_PAD("'c' || o_custkey")}) AS topic1, B({_PAD("'s' || l_suppkey")}) AS topic2,
  B(CASE WHEN seventh THEN {_WORD("l_suppkey")} END) AS topic3
FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY transaction_hash, place) - 1 AS log_index FROM (
  SELECT day, l_orderkey, o_custkey, transaction_index, B(H('t' || l_orderkey)) AS transaction_hash, {", ".join(f"CASE WHEN plain IS NULL THEN {x} ELSE plain.{c} END AS {c}" for c, x in _SMALL.items())} FROM (
    SELECT DEAL day, l_orderkey, o_custkey, transaction_index, CASE WHEN small THEN shiftleft(CAST(place AS BIGINT), 51) | shiftleft(quantity, 39) | shiftleft(part, 34) | shiftleft(CAST(bare AS BIGINT), 33) | shiftleft(CAST(sent AS BIGINT), 32) | shiftleft(CAST(seventh AS BIGINT), 31) | l_suppkey END AS bits,
      CASE WHEN NOT small THEN struct({", ".join(_SMALL)}) END AS plain
    FROM (SELECT *, coalesce(place BETWEEN 0 AND 4095 AND quantity BETWEEN 0 AND 4095 AND part BETWEEN 0 AND 31 AND l_suppkey BETWEEN 0 AND 2147483647, false) AND bare IS NOT NULL AND sent IS NOT NULL AND seventh IS NOT NULL AS small FROM (
      SELECT day, l_orderkey, o_custkey, transaction_index, row_number() OVER (PARTITION BY l_orderkey, day ORDER BY {_ORDERED}) AS place, l_suppkey,
        l_partkey % 20 AS part, {_QTY} AS quantity, l_linestatus = 'F' AND l_linenumber = 1 AS bare, l_returnflag = 'N' AS sent, l_linenumber = 7 AS seventh
      FROM ({_LINES}))))))""",
    "traces": f"""
SELECT B({_ADDR("'c' || o_custkey")}) AS "from", B({_ADDR("'tok' || part")}) AS "to", CASE WHEN open THEN 'call' ELSE 'delegatecall' END AS call_type,
  B('70a08231' || {_PAD("'c' || o_custkey")}) AS input, B({_Q("quantity")}) AS value, B(NULL) AS author, CAST(NULL AS STRING) AS reward_type, B(H('b' || day)) AS block_hash, day AS block_number,
  B({_WORD("quantity")}) AS output, trace_place, B(H('t' || l_orderkey)) AS transaction_hash, transaction_index AS transaction_position, 'call' AS type, B('70a08231') AS sighash,
  B(CASE WHEN second THEN {_ADDR("'k' || part")} END) AS address
FROM (SELECT day, l_orderkey, o_custkey, transaction_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDERED}) - 1 AS trace_place,
    l_partkey % 20 AS part, {_QTY} AS quantity, l_linestatus = 'O' AS open, l_linenumber = 2 AS second
  FROM ({_LINES}) WHERE l_linenumber <= 2)
UNION ALL{TABLES["traces"].split("UNION ALL")[1]}""",
}


def _filled(sql: str, binary, sha, day: str) -> str:
    """The template with its macros replaced."""
    sql = re.sub(r"\bDAY\b", day, sql)
    while m := re.search(r"\b([BH])\(", sql):
        depth, at = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            at += 1
        sql = sql[: m.start()] + (binary if m[1] == "B" else sha)(sql[m.end() : at - 1]) + sql[at:]
    return sql


def oracle_tables() -> str:
    """The four tables as DuckDB common table expressions."""
    day = "date_diff('day', TIMESTAMP '1995-01-01', o_orderdate)"
    filled = {t: _filled(sql, lambda x: f"('0x' || ({x}))", lambda x: f"sha256({x})", day) for t, sql in TABLES.items()}
    return "WITH " + ",\n".join(f"{t} AS MATERIALIZED ({sql})" for t, sql in filled.items()) + "\n"


def chain_tables(spark: SparkSession, sf_dir: str, full: bool = False, by_block: bool = False) -> dict[str, DataFrame]:
    """The four tables as lazy frames; with `full` in the shape of the fixed schemas, the other columns null. With `by_block`
    logs are dealt by ranges of blocks, not by their hash, so that an order by block needs no other shuffle (the ranges are
    found by a sample, which reads the lines a second time)."""
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(f"chain_{t}")
    out = {}
    deal = "/*+ REPARTITION_BY_RANGE(day) */" if by_block else "/*+ REPARTITION(day) */"
    for name, sql in (TABLES | NARROW).items():
        text = _filled(
            sql.replace("DEAL", deal),
            lambda x: f"unhex({x})",
            lambda x: f"sha2({x}, 256)",
            "CAST(datediff(o_orderdate, DATE'1995-01-01') AS BIGINT)",
        )
        text = text.replace('"', "`")
        text = re.sub(r"\b(FROM|JOIN) (orders|lineitem)\b", r"\1 chain_\2", text)
        df = spark.sql(text)
        if name == "transactions":
            one = F.struct(
                F.unhex(F.lit("01")).alias("chain_id"),
                F.col("auth_address").alias("address"),
                *(F.lit(None).cast("binary").alias(n) for n in ("nonce", "y_parity", "r", "s")),
            )
            df = df.withColumn(
                "authorization_list", F.when(F.col("auth_address").isNotNull(), F.array(one))
            ).drop("auth_address")
        if name == "traces":
            df = df.withColumn(
                "trace_address", F.when(F.col("trace_place").isNotNull(), F.array(F.col("trace_place").cast("bigint")))
            ).drop("trace_place")
        df = df.withColumns(
            {c: F.col(c).cast("bigint") for c in ("transaction_index", "transaction_position") if c in df.columns}
        )
        if name == "logs":
            df = df.withColumns({c: F.col(c).cast("bigint") for c in ("log_index", "transaction_index")})
        if full:
            df = df.select(
                *(
                    (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in SCHEMAS[name]
                )
            )
        out[name] = df
    return out

"""JSON-RPC documents (one per line) to rows of the four tables.

Readers get a frame with a text column `json`; each document is parsed once, by a fixed schema of texts, so nothing is
inferred. A document that doesn't fit is an error where rows are read, or goes to quarantine with the reasons (`sorted_out`).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.values import hex_to_data, hex_to_fixed, hex_to_uint64, number_to_quantity, tx_status, tx_type
from loomspark.schema import SCHEMAS

#: Sizes of the fixed-size columns of JSON documents.
_FIXED = {"hash": 32, "parent_hash": 32, "sha3_uncles": 32, "transactions_root": 32, "state_root": 32, "receipts_root": 32, "miner": 20, "nonce": 8, "block_hash": 32, "transaction_hash": 32, "from": 20, "to": 20, "contract_address": 20, "address": 20, "parent_beacon_block_root": 32, "withdrawals_root": 32, "mix_hash": 32, "send_root": 32, "root": 32, "source_hash": 32, "author": 20, "action_address": 20, "refund_address": 20, "sighash": 4}
_DATA = {"logs_bloom", "extra_data", "input", "data", "init", "code", "output"}
_LONGS = {"number", "block_number", "transaction_index", "log_index", "subtraces", "transaction_position"}


def _camel(name: str) -> str:
    first, *rest = name.split("_")
    return first + "".join(w.capitalize() for w in rest)


def _value(c: Column, name: str, table: str, strict: bool = True) -> Column:
    """Text of a JSON value to the column's type."""
    if name == "nonce" and table == "transactions":
        return number_to_quantity(c, strict)
    if name in _FIXED:
        return hex_to_fixed(c, _FIXED[name], strict)
    if name in _DATA:
        return hex_to_data(c, strict)
    if name in _LONGS:
        return F.when(c.startswith("0x"), hex_to_uint64(c, False)).otherwise(c.try_cast("bigint"))
    if name == "status":
        return tx_status(c, strict)
    if name == "type" and table == "transactions":
        return tx_type(c, strict)
    return number_to_quantity(c, strict)


def _plain(table: str, skip: tuple[str, ...] = ()) -> list[str]:
    """Columns that a text of the document becomes."""
    kinds = ("binary", "bigint", "smallint")
    return [f.name for f in SCHEMAS[table] if f.dataType.simpleString() in kinds and f.name not in skip]


def _path(name: str, names: dict | None = None) -> str:
    return (names or {}).get(name, _camel(name))


def _parsed(df: DataFrame, paths: list[str], arrays: dict[str, str] | None = None, *more: str) -> DataFrame:
    """The columns `more` and `_doc`: the documents, parsed once, as structs of texts at dotted paths and of arrays; `_bad`
    holds a document that isn't of this form. The generator is a barrier: without it a filter or a second projection would
    take the parse along, once for each field."""
    tree: dict = {}
    for path in paths:
        node = tree
        *outer, last = path.split(".")
        for step in outer:
            node = node.setdefault(step, {})
        node[last] = "string"
    tree |= arrays or {}
    ddl = lambda x: x if isinstance(x, str) else "struct<" + ", ".join(f"`{k}`: {ddl(v)}" for k, v in x.items()) + ">"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return df.select(*more, F.explode(F.array(F.from_json("json", ddl(tree | {"_bad": "string"}), options))).alias("_doc"))


def _at(path: str) -> Column:
    return F.col("_doc." + ".".join(f"`{x}`" for x in path.split(".")))


def _fields(table: str, skip: tuple[str, ...] = (), names: dict | None = None) -> list[Column]:
    return [_value(_at(_path(n, names)), n, table).alias(n) for n in _plain(table, skip)]


#: Where a table's columns stand in its documents, and columns that documents of their own bring.
_WITHOUT = {"blocks": (), "transactions": ("sighash", "l1_fee_scalar"), "logs": ("topic0", "topic1", "topic2", "topic3"), "traces": ("sighash",)}


def sorted_out(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(documents that fit the table, the others with `reasons`), all columns of `df` kept.

    Reasons are an array: "not a document" for text that is no JSON object or has an array where a text must stand, or the
    other way round; "missing: x" for a column that may not be null (a transaction's receipt has its own); "malformed: x"
    for a text that isn't a value of the column; for a log also "topics: n" beyond four. A null text is no document.
    """
    names = _TRACE if table == "traces" else None
    plain = [n for n in _plain(table, _WITHOUT[table]) if table != "transactions" or n not in RECEIPT]
    needed = {f.name for f in SCHEMAS[table] if not f.nullable} & set(plain)
    arrays = {"logs": {"topics": "array<string>"}, "traces": {"traceAddress": "array<bigint>"}}.get(table, {})
    doc = _parsed(df, [_path(n, names) for n in plain], arrays, F.struct("*").alias("_row"))
    reasons = [F.when(F.col("_doc").isNull() | F.col("_doc._bad").isNotNull(), F.lit("not a document"))]
    for n in plain:
        text = _at(_path(n, names))
        wrong = F.when(text.isNotNull() & _value(text, n, table, False).isNull(), F.lit(f"malformed: {n}"))
        reasons.append(F.when(text.isNull(), F.lit(f"missing: {n}")).otherwise(wrong) if n in needed else wrong)
    if table == "logs":
        reasons.append(F.when(F.size(_at("topics")) > 4, F.concat(F.lit("topics: "), F.size(_at("topics")))))
        reasons += [F.when(hex_to_fixed(F.get(_at("topics"), i), 32, False).isNull() & F.get(_at("topics"), i).isNotNull(), F.lit(f"malformed: topic{i}")) for i in range(4)]
    found = F.array_compact(F.array(*reasons))
    judged = doc.select("_row", F.when(reasons[0].isNotNull(), F.array(reasons[0])).otherwise(found).alias("reasons"))
    return judged.where(F.size("reasons") == 0).select("_row.*"), judged.where(F.size("reasons") > 0).select("_row.*", "reasons")


def _array(document: Column, path: str, kind: str) -> Column:
    return F.from_json(F.get_json_object(document, path), f"array<{kind}>")


def rpc_blocks(df: DataFrame) -> DataFrame:
    """Block headers; uncles and withdrawals as arrays."""
    pay = "array<struct<index: string, validatorIndex: string, address: string, amount: string>>"
    doc = _parsed(df, [_path(n) for n in _plain("blocks")], {"uncles": "array<string>", "withdrawals": pay})
    hashes = F.transform(_at("uncles"), lambda h: hex_to_fixed(h, 32))
    pays = F.transform(
        _at("withdrawals"),
        lambda w: (
            F.struct(
                number_to_quantity(w["index"]).alias("index"),
                number_to_quantity(w["validatorIndex"]).alias("validator_index"),
                hex_to_fixed(w["address"], 20).alias("address"),
                number_to_quantity(w["amount"]).alias("amount"),
            )
        ),
    )
    return doc.select(
        *_fields("blocks"),
        hashes.alias("uncles"),
        pays.alias("withdrawals"),
    ).select(*SCHEMAS["blocks"].names)


def rpc_block_transactions(df: DataFrame) -> DataFrame:
    """The transactions within block documents that hold them as objects, as rows of `json`."""
    return df.select(
        F.explode(_array(F.col("json"), "$.transactions", "string")).alias("json")
    ).where(F.col("json").startswith("{"))


def rpc_transactions(df: DataFrame) -> DataFrame:
    """Transactions; what only receipts know is null (see `complete`)."""
    arrays = {
        "accessList": "array<struct<address: string, storageKeys: array<string>>>",
        "authorizationList": "array<struct<chainId: string, address: string, nonce: string, yParity: string, r: string, s: string>>",
        "blobVersionedHashes": "array<string>",
    }
    skip = _WITHOUT["transactions"]
    doc = _parsed(df, [_path(n) for n in _plain("transactions", skip)], arrays)
    access = F.transform(
        _at("accessList"),
        lambda a: (
            F.struct(
                hex_to_fixed(a["address"], 20).alias("address"),
                F.transform(a["storageKeys"], lambda k: hex_to_fixed(k, 32)).alias("storage_keys"),
            )
        ),
    )
    auth = F.transform(
        _at("authorizationList"),
        lambda a: (
            F.struct(
                number_to_quantity(a["chainId"]).alias("chain_id"),
                hex_to_fixed(a["address"], 20).alias("address"),
                *(
                    number_to_quantity(a[j]).alias(n)
                    for j, n in (("nonce", "nonce"), ("yParity", "y_parity"), ("r", "r"), ("s", "s"))
                ),
            )
        ),
    )
    blobs = F.transform(_at("blobVersionedHashes"), lambda h: hex_to_fixed(h, 32))
    own = doc.select(
        *_fields("transactions", skip),
        access.alias("access_list"),
        auth.alias("authorization_list"),
        blobs.alias("blob_versioned_hashes"),
    )
    own = own.withColumns(
        {
            "sighash": F.when(F.length("input") >= 4, F.substring("input", 1, 4)),
            "l1_fee_scalar": F.lit(None).cast("binary"),
        }
    )
    return own.select(*(f"`{n}`" for n in SCHEMAS["transactions"].names))


#: Columns that come from receipts.
RECEIPT = ["cumulative_gas_used", "effective_gas_price", "gas_used", "contract_address", "logs_bloom", "root", "status", "l1_fee", "l1_gas_price", "l1_gas_used", "l1_fee_scalar", "gas_used_for_l1", "blob_gas_price", "blob_gas_used", "deposit_nonce", "deposit_receipt_version", "l1_base_fee_scalar", "l1_blob_base_fee", "l1_blob_base_fee_scalar", "l1_block_number"]


def rpc_receipts(df: DataFrame) -> DataFrame:
    """Receipts: transaction_hash, block_number and RECEIPT; a missing or null effective gas price is zero."""
    doc = _parsed(df, [_camel(n) for n in ("transaction_hash", "block_number", *RECEIPT)])
    text = lambda n: _at(_camel(n))
    special = {
        "effective_gas_price": number_to_quantity(F.coalesce(text("effective_gas_price"), F.lit("0x0"))),
        "l1_fee_scalar": F.encode(text("l1_fee_scalar"), "utf-8"),
    }
    columns = [
        special.get(n, _value(text(n), n, "transactions") if n not in special else None).alias(n) for n in RECEIPT
    ]
    return doc.select(
        hex_to_fixed(text("transaction_hash"), 32).alias("transaction_hash"),
        _value(text("block_number"), "block_number", "transactions").alias("block_number"),
        *columns,
    )


def complete(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Transactions with the columns of their receipts."""
    r = receipts.select(
        "block_number", F.col("transaction_hash").alias("hash"), *(F.col(n).alias(f"r_{n}") for n in RECEIPT)
    )
    joined = transactions.join(r, ["block_number", "hash"], "left")
    return joined.select(
        *(
            (F.coalesce(F.col(f"r_{n}"), F.col(f"`{n}`")) if n in RECEIPT else F.col(f"`{n}`")).alias(n)
            for n in SCHEMAS["transactions"].names
        )
    )


def rpc_logs(df: DataFrame) -> DataFrame:
    """Logs; more than four topics are an error."""
    skip = _WITHOUT["logs"]
    doc = _parsed(df, ["removed", *(_path(n) for n in _plain("logs", skip))], {"topics": "array<string>"})
    topics = _at("topics")
    topics = F.when(F.size(topics) > 4, F.raise_error(F.lit("a log has at most four topics"))).otherwise(topics)
    return doc.select(
        _at("removed").cast("boolean").alias("removed"),
        *_fields("logs", skip),
        *(hex_to_fixed(F.get(topics, i), 32).alias(f"topic{i}") for i in range(4)),
    ).select(*SCHEMAS["logs"].names)


def receipt_logs(df: DataFrame) -> DataFrame:
    """The logs within receipt documents, as rows of `json`."""
    return df.select(F.explode(_array(F.col("json"), "$.logs", "string")).alias("json"))


#: Where the columns of a trace stand in its document.
_TRACE = {"from": "action.from", "to": "action.to", "gas": "action.gas", "input": "action.input", "init": "action.init", "value": "action.value", "author": "action.author", "action_address": "action.address", "balance": "action.balance", "refund_address": "action.refundAddress", "address": "result.address", "code": "result.code", "gas_used": "result.gasUsed", "output": "result.output"}


def rpc_traces(df: DataFrame) -> DataFrame:
    """Traces of the {action, result} form; the action's address is action_address, the result's is address."""
    texts = {"call_type": "action.callType", "reward_type": "action.rewardType", "type": "type", "error": "error"}
    paths = [*(_path(n, _TRACE) for n in _plain("traces", _WITHOUT["traces"])), *texts.values()]
    doc = _parsed(df, paths, {"traceAddress": "array<bigint>"})
    own = doc.select(
        *_fields("traces", _WITHOUT["traces"], _TRACE),
        *(_at(p).alias(n) for n, p in texts.items()),
        _at("traceAddress").alias("trace_address"),
    )
    return own.withColumn(
        "sighash", F.when(F.length("input") >= 4, F.substring("input", 1, 4))
    ).select(*(f"`{n}`" for n in SCHEMAS["traces"].names))


#: What is read from a call of a call tree.
_CALL = ("type", "from", "to", "gas", "gasUsed", "input", "output", "value", "error", "revertReason")
_CALL_ROWS = 10_000


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a call tree in `json` -> one row per call, parents first: the other columns, the path of positions, the
    number of calls below, and the texts of _CALL. A tree of any depth is walked with a stack."""

    def rows(batch: pa.RecordBatch, at: list, paths: list, below: list, calls: list) -> pa.RecordBatch:
        own = batch.drop_columns(["json"]).take(pa.array(at, pa.int64()))
        text = lambda x: x if x is None or isinstance(x, str) else json.dumps(x)
        columns = [
            pa.array(paths, pa.list_(pa.int64())),
            pa.array(below, pa.int64()),
            *(pa.array([text(c.get(n)) for c in calls], pa.string()) for n in _CALL),
        ]
        return pa.RecordBatch.from_arrays(
            [*own.columns, *columns], [*own.schema.names, "trace_address", "subtraces", *(f"call_{n}" for n in _CALL)]
        )

    for batch in batches:
        at, paths, below, calls = [], [], [], []
        for i, text in enumerate(batch.column("json").to_pylist()):
            stack = [([], json.loads(text))] if text else []
            while stack:
                path, call = stack.pop()
                inner = call.get("calls") or []
                at.append(i)
                paths.append(path)
                below.append(len(inner))
                calls.append(call)
                stack += [([*path, j], inner[j]) for j in reversed(range(len(inner)))]
                if len(at) >= _CALL_ROWS:
                    yield rows(batch, at, paths, below, calls)
                    at, paths, below, calls = [], [], [], []
        if at:
            yield rows(batch, at, paths, below, calls)


def debug_traces(df: DataFrame) -> DataFrame:
    """Call trees of any depth (columns block_number, block_hash, transaction_hash, transaction_position, json) as rows
    of traces; trace_address is the path of positions. A null document has no calls."""
    keys = ["block_number", "block_hash", "transaction_hash", "transaction_position"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(
        [f"{k} {kinds[k]}" for k in keys]
        + ["trace_address array<bigint>", "subtraces bigint"]
        + [f"call_{n} string" for n in _CALL]
    )
    rows = df.select(*keys, "json").mapInArrow(_calls, schema)
    text = lambda n: F.col(f"call_{n}")
    call = F.lower(text("type"))
    rows = rows.select(
        *keys, "trace_address", "subtraces", F.when(call.startswith("create"), "create").when(call == "selfdestruct", "suicide").otherwise("call").alias("type"),
        F.when(~call.startswith("create"), call).alias("call_type"), hex_to_fixed(text("from"), 20).alias("from"), hex_to_fixed(text("to"), 20).alias("to"), number_to_quantity(text("gas")).alias("gas"),
        number_to_quantity(text("gasUsed")).alias("gas_used"), hex_to_data(text("input")).alias("input"), hex_to_data(text("output")).alias("output"), number_to_quantity(text("value")).alias("value"), F.coalesce(text("error"), text("revertReason")).alias("error"),
    )
    rows = rows.withColumn("sighash", F.when(F.length("input") >= 4, F.substring("input", 1, 4)))
    return rows.select(
        *(
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in SCHEMAS["traces"]
        )
    )

import os

import duckdb
import pytest

import __spark_entry__ as entry
from loomspark.functions import abi, values
from loomspark.functions.cast import map_column
from loomspark.jobs import ORACLES, QUERIES
from loomspark.operators.filters import Filter
from loomspark.plans.query import ChainQuery
from loomspark.sources import ingest
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(
        (
            tuple(
                None
                if v is None else round(float(v), 6)
                if isinstance(v, float) or v.__class__.__name__ == "Decimal" else v
                for v in r
            )
            for r in rows
        ),
        key=str,
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    got = plain(df.select(*(f"`{c}`" for c in columns)).collect())
    assert got == plain([tuple(r[names.index(c)] for c in columns) for r in want.fetchall()])


def one(spark, column, **cells):
    kinds = {bytes: "binary", str: "string", int: "bigint"}
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in cells.items()))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("n", [-69, 0, 69, -1, 1, 2**63 - 1, -(2**63)])
@pytest.mark.parametrize("target", ["int64", "intstr", "decimal128", "float64"])
def test_signed_words(spark, n, target):
    word = n.to_bytes(32, "big", signed=True)
    got = one(spark, map_column(F.col("c"), T.BinaryType(), target), c=word)
    assert (str(got) if target == "intstr" else int(got)) == (
        str(n) if target == "intstr" else int(float(n)) if target == "float64" else n
    )


def test_wide_words(spark):
    assert one(spark, map_column(F.col("c"), T.BinaryType(), "intstr"), c=b"\x7f" + b"\xff" * 31) == str(2**255 - 1)
    assert one(spark, map_column(F.col("c"), T.BinaryType(), "int32", "permissive"), c=b"\x01" * 9) is None
    with pytest.raises(Exception, match="out of range"):
        one(spark, map_column(F.col("c"), T.BinaryType(), "int32"), c=b"\x01" * 9)


def test_values(spark):
    assert one(spark, values.hex_to_quantity(F.col("c")), c="0x000102") == b"\x01\x02"
    assert one(spark, values.hex_to_quantity(F.col("c")), c="0x0") == b"\x00"
    assert one(spark, values.quantity_to_hex(F.col("c")), c=b"\x00") == "0x0"
    assert one(spark, values.hex_to_fixed(F.col("c"), 32), c="0x") == bytes(32)
    for bad in ("0x", "12zz", "-1"):
        with pytest.raises(Exception, match="not a quantity"):
            one(spark, values.number_to_quantity(F.col("c")), c=bad)
    with pytest.raises(ValueError, match=r"address\[1\]"):
        Filter("logs").where("address", ["0x" + "00" * 20, "0x00"])


def test_abi_fixtures(spark):
    mint = abi.parse_signature(
        "event Mint(address sender, address indexed owner, int24 indexed tickLower, int24 indexed tickUpper, "
        "uint128 amount, uint256 amount0, uint256 amount1)"
    )
    assert mint.hash.hex() == "7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde"
    assert int.from_bytes(one(spark, abi.decode_topic(F.col("c"), "int24"), c=b"\xff" * 32), "big", signed=True) == -1
    call = bytes.fromhex(
        "a9059cbb000000000000000000000000dc4bde73fa35b7478a574f78d5dfd57a0b2e22810000000000000000000000000000000000000000000000004710ca26d3eeae0a"
    )
    got = one(
        spark,
        abi.decode_input(F.col("c"), ["transfer(address dst, uint256 wad)", "approve(address usr, uint256 wad)"]),
        c=call,
    )
    assert got.function == "transfer" and got.params[0].value == "0xdc4bde73fa35b7478a574f78d5dfd57a0b2e2281"
    assert one(spark, abi.decode_input(F.col("c"), ["transfer(address dst, uint256 wad)"]), c=b"\x01") is None
    assert one(spark, abi.decode_output(F.col("c"), "balanceOf(address)(uint256)"), c=b"") is None
    for bad in ("incorrect signature", "f(uint256[x] a)", "f((uint256,bool x)", "f(uint256 a) what", "f(thing a)"):
        with pytest.raises(ValueError):
            abi.parse_signature(bad)
    hostile = b"\xff" * 32
    assert one(spark, abi.decode_body(F.col("c"), abi.parse_signature("f(string s)").params)[0], c=hostile) is False


def encoded(kind, value) -> tuple[bytes, bool]:
    """(plain ABI encoding of a value, whether it is held behind an offset)."""
    t = abi._tree(kind) if isinstance(kind, str) else kind
    if t[0] == "word":
        return int(value).to_bytes(32, "big"), False
    if t[0] == "dynamic":
        raw = value.encode() if isinstance(value, str) else value
        return len(raw).to_bytes(32, "big") + raw + bytes(-len(raw) % 32), True
    kinds = [t[1]] * len(value) if t[0] == "array" else t[1]
    parts = [encoded(k, v) for k, v in zip(kinds, value, strict=True)]
    head, tail, size = b"", b"", sum(32 if dynamic else len(x) for x, dynamic in parts)
    for x, dynamic in parts:
        head += (size + len(tail)).to_bytes(32, "big") if dynamic else x
        tail += x if dynamic else b""
    count = len(value).to_bytes(32, "big") if t[0] == "array" and t[2] is None else b""
    return count + head + tail, abi._size(t) is None


ARRAYS = [
    ("uint256[]", [5, 6, 7]), ("uint256[]", []), ("bool[2]", [True, False]), ("string[]", ["a", "", "long text " * 9]), ("bytes[][]", [[b"x"], [], [b"y" * 40, b""]]),
    ("(uint256,bool)", (3, True)), ("(string,uint8)[]", [("one", 1), ("two", 2)]), ("((uint256,string)[],bytes)[2]", [([(1, "q")], b"z"), ([], b"")]), ("uint8[2][]", [[1, 2], [3, 4]]),
]


@pytest.mark.parametrize("kinds", [*([a] for a in ARRAYS), ARRAYS[:4], ARRAYS[4:]])
def test_abi_arrays_and_tuples(spark, kinds):
    def plain(t, v):
        if t[0] == "array":
            return [plain(t[1], x) for x in v]
        if t[0] == "tuple":
            return tuple(plain(x, y) for x, y in zip(t[1], v, strict=True))
        return v if t[0] == "dynamic" or t[1] == "bool" else int(v).to_bytes(32, "big")

    def got(x):
        return [got(y) for y in x] if isinstance(x, list) else tuple(
            got(y) for y in x
        ) if isinstance(x, tuple) else bytes(x) if isinstance(x, bytearray) else x

    signature = abi.parse_signature(f"f({', '.join(f'{k} x{i}' for i, (k, _) in enumerate(kinds))})")
    data = encoded(("tuple", [abi._tree(k) for k, _ in kinds]), [v for _, v in kinds])[0]
    rows = [(data,), (data[:-33],), (b"\xff" * len(data),), (None,)]
    valid, values_ = abi.decode_body(F.col("c"), signature.params)
    found = (
        spark.createDataFrame(rows, "c binary")
        .select(valid.alias("ok"), *(F.when(valid, v).alias(f"v{i}") for i, v in enumerate(values_)))
        .collect()
    )
    assert [r.ok for r in found] == [True, False, False, False]
    assert [got(x) for x in found[0][1:]] == [plain(abi._tree(k), v) for k, v in kinds]


def test_abi_canonical_forms():
    s = abi.parse_signature(
        "function multicall(tuple(address target, bytes data)[] calls, uint[3] x) returns (bytes[] memory results);"
    )
    assert s.canonical == "multicall((address,bytes)[],uint256[3])" and [p.type for p in s.outputs] == ["bytes[]"]
    assert [p.name for p in s.params] == ["calls", "x"]
    assert abi.parse_signature("aggregate((address,bytes)[])").selector.hex() == "252dba42"


def test_deep_call_trees(spark):
    import json

    call = {"type": "CALL", "from": "0x" + "01" * 20, "calls": []}
    for _ in range(1023):
        call = {
            "type": "CALL",
            "from": "0x" + "02" * 20,
            "gas": 5,
            "calls": [call, {"type": "CREATE", "from": "0x" + "03" * 20}],
        }
    docs = spark.createDataFrame(
        [(1, b"a", b"b", 0, json.dumps(call)), (2, b"a", b"c", 1, None)],
        "block_number bigint, block_hash binary, transaction_hash binary, transaction_position bigint, json string",
    )
    rows = ingest.debug_traces(docs).select("trace_address", "subtraces", "type").collect()
    assert len(rows) == 2047 and max(len(r.trace_address) for r in rows) == 1023
    assert sorted(r.subtraces for r in rows)[-1] == 2 and sum(r.type == "create" for r in rows) == 1023


def test_follow_with_guard_over_restarts(spark, tmp_path):
    from loomspark.streaming import follow

    h = lambda *x: [bytes([i]) * 32 for i in x]
    schema = T.StructType([f for f in follow.SCHEMAS["blocks"] if f.name in ("number", "hash", "parent_hash")])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    seen, bad = [], []

    def page(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/blocks")
        stream = follow.stream_table(spark, f"{tmp_path}/blocks", "blocks")
        follow.follow_with_guard(
            stream, lambda b, e: seen.append(b.count()), lambda b, last: bad.append(last), f"{tmp_path}/checkpoint"
        ).awaitTermination()

    page([(1, *h(1, 0)), (2, *h(2, 1))])
    page([(3, *h(3, 2))])
    assert (seen, bad) == ([2, 1], [])
    page([(4, *h(4, 9))])
    page([(5, *h(5, 4)), (6, *h(6, 8))])
    assert (seen, bad) == ([2, 1, 1, 2], [3, 5])


def test_limits_stop_early(spark, monkeypatch):
    from loomspark.operators import order
    from loomspark.sources.fixtures import chain_tables

    monkeypatch.setattr(order, "RANGE", 50)
    t = chain_tables(spark, DATA)
    q = (
        ChainQuery(10, None, join_mode="nothing")
        .where("logs", Filter("logs"))
        .select("logs", ["block_number"])
        .where("blocks", Filter("blocks"))
        .select("blocks", ["number"])
    )
    counts = {
        r.block_number: r["count"]
        for r in t["logs"].where("block_number >= 10").groupBy("block_number").count().collect()
    }
    for limit in (1, 40, 700, 10**9):
        total, kept = 0, []
        for b in sorted(counts):
            if total >= limit:
                break
            total += counts[b]
            kept.append(b)
        r = q.limit(logs=limit).execute(t)
        assert r.tables["logs"].count() == total
        assert r.last_block == (kept[-1] if limit < 10**9 else None)


def test_receipt_defaults(spark):
    docs = spark.createDataFrame(
        [
            ('{"transactionHash":"0x01","blockNumber":"0x5","status":"0x1","effectiveGasPrice":null}',),
            ('{"transactionHash":"0x02","blockNumber":"0x5"}',),
        ],
        "json string",
    )
    assert [bytes(r.effective_gas_price) for r in ingest.rpc_receipts(docs).collect()] == [b"\x00", b"\x00"]


def test_partition_pruning_and_pushdown(spark, tmp_path):
    from loomspark.jobs import addr
    from loomspark.plans.query import full_shape
    from loomspark.sources.fixtures import chain_tables
    from loomspark.sources.tables import scan, store

    store({"logs": full_shape(chain_tables(spark, DATA)["logs"], "logs")}, str(tmp_path))
    q = (
        ChainQuery(0, 100, join_mode="nothing")
        .where("logs", Filter("logs").where("address", [addr("tok1")]))
        .select("logs", ["data"])
    )
    tables = {n: scan(spark, str(tmp_path), n) for n in ("blocks", "transactions", "logs", "traces")}
    plan = q.execute(tables).tables["logs"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block_range" in plan and "PushedFilters: [" in plan and "address" in plan.split(
        "PushedFilters"
    )[1]
    assert "topic0" not in plan.split("ReadSchema")[1]


def test_arrow_ipc_round_trip(spark, tmp_path, monkeypatch):
    from loomspark import sinks
    from loomspark.sources.tables import scan_arrow_ipc

    monkeypatch.setattr(sinks, "IPC_BYTES", 1000)
    df = spark.range(0, 30_000, 1, 3).selectExpr(
        "id AS number", "IF(id % 3 = 0, NULL, sha2(CAST(id AS STRING), 256)) AS text"
    )
    assert sinks.write_arrow_ipc(df, f"file://{tmp_path}/a") == 30_000
    assert len(list((tmp_path / "a").iterdir())) >= 3
    back = scan_arrow_ipc(spark, f"file://{tmp_path}/a", df.schema)
    assert back.exceptAll(df).isEmpty() and back.count() == 30_000
    sinks.write_arrow_ipc(df, f"{tmp_path}/a")
    assert scan_arrow_ipc(spark, f"{tmp_path}/a", df.schema).count() == 30_000
    assert sinks.write_arrow_ipc(df.where("number < 0"), f"{tmp_path}/b") == 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.exists("/root/testdata")

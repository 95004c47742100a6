"""ABI decoding as generated Column expressions.

A signature is read on the driver into names, types and a keccak-256 hash; what runs on the executors are slices of the
topics and of the data, with the checks that make a malformed body null.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TYPE = re.compile(r"(uint|int)(\d*)|bool|address|string|bytes(\d*)")


def keccak256(data: bytes) -> bytes:
    """Keccak with a rate of 136 bytes and the original padding; for signatures only."""
    mask = (1 << 64) - 1
    rotate = lambda x, n: ((x << n) | (x >> (64 - n))) & mask if n else x
    state = [[0] * 5 for _ in range(5)]
    size = 136 - len(data) % 136
    data += b"\x81" if size == 1 else b"\x01" + bytes(size - 2) + b"\x80"
    for at in range(0, len(data), 136):
        for i in range(17):
            state[i % 5][i // 5] ^= int.from_bytes(data[at + 8 * i : at + 8 * i + 8], "little")
        lfsr = 1
        for _ in range(24):
            parity = [state[x][0] ^ state[x][1] ^ state[x][2] ^ state[x][3] ^ state[x][4] for x in range(5)]
            for x in range(5):
                d = parity[(x - 1) % 5] ^ rotate(parity[(x + 1) % 5], 1)
                for y in range(5):
                    state[x][y] ^= d
            x, y, held = 1, 0, state[1][0]
            for t in range(24):
                x, y = y, (2 * x + 3 * y) % 5
                held, state[x][y] = state[x][y], rotate(held, (t + 1) * (t + 2) // 2 % 64)
            for y in range(5):
                row = [state[x][y] for x in range(5)]
                for x in range(5):
                    state[x][y] = row[x] ^ (~row[(x + 1) % 5] & mask & row[(x + 2) % 5])
            for j in range(7):
                if lfsr & 1:
                    state[0][0] ^= 1 << ((1 << j) - 1)
                lfsr = (lfsr << 1) ^ (0x171 if lfsr & 0x80 else 0)
    return b"".join(state[i % 5][i // 5].to_bytes(8, "little") for i in range(4))


@dataclass(frozen=True)
class Param:
    name: str
    type: str
    indexed: bool = False


@dataclass(frozen=True)
class Signature:
    name: str
    params: tuple[Param, ...]
    outputs: tuple[Param, ...] = ()

    @property
    def canonical(self) -> str:
        return f"{self.name}({','.join(p.type for p in self.params)})"

    @property
    def hash(self) -> bytes:
        return keccak256(self.canonical.encode())

    @property
    def selector(self) -> bytes:
        return self.hash[:4]


def _split(text: str) -> list[str]:
    """Parts between the commas outside of parentheses, stripped; empty ones are left out."""
    depth, parts = 0, [""]
    for c in text:
        depth += {"(": 1, ")": -1}.get(c, 0)
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return [p for x in parts if (p := x.strip())]


def _group(text: str) -> tuple[str, str]:
    """What stands in the parentheses that `text` begins with, and what follows them."""
    depth = 0
    for i, c in enumerate(text):
        depth += {"(": 1, ")": -1}.get(c, 0)
        if not depth:
            return text[1:i], text[i + 1 :]
    raise ValueError(f"parentheses don't match: {text!r}")


def _params(text: str) -> tuple[Param, ...]:
    """Parameters of a list; types in their canonical form, a tuple as the types of its components."""
    out = []
    for part in _split(text):
        part = re.sub(r"^tuple\s*(?=\()", "", part)
        if part.startswith("("):
            inner, rest = _group(part)
            base = f"({','.join(p.type for p in _params(inner))})"
        else:
            m = re.match(r"\w+", part)
            if not m:
                raise ValueError(f"unsupported type {part!r}")
            base, rest = re.sub(r"^(u?int)$", r"\g<1>256", m[0]), part[m.end() :]
            if not _TYPE.fullmatch(base):
                raise ValueError(f"unsupported type {m[0]!r}")
        m = re.match(r"((?:\s*\[\d*\])*)(?:\s+(.*))?$", rest, re.S)
        if not m:
            raise ValueError(f"unsupported type {part!r}")
        words = (m[2] or "").split()
        names = [w for w in words if w not in ("indexed", "memory", "calldata", "payable")]
        out.append(Param(names[0] if names else "", base + re.sub(r"\s", "", m[1]), "indexed" in words))
    return tuple(out)


def parse_signature(text: str) -> Signature:
    """`[event|function] name(type [indexed] name, …)[(outputs)]`; types may be arrays and tuples."""
    m = re.match(r"\s*(?:event\s+|function\s+)?([A-Za-z_$][\w$]*)\s*(?=\()", text)
    if not m:
        raise ValueError(f"not a signature: {text!r}")
    inner, rest = _group(text[m.end() :])
    rest, outputs = re.sub(r"^\s*(?:returns\s*)?(?=\()", "", rest), ""
    if rest.startswith("("):
        outputs, rest = _group(rest)
    if not re.fullmatch(r"\s*(?:anonymous)?\s*;?\s*", rest):
        raise ValueError(f"not a signature: {text!r}")
    return Signature(m[1], _params(inner), _params(outputs))


def named(params: tuple[Param, ...]) -> tuple[Param, ...]:
    names = [p.name for p in params]
    if "" in names or len(set(names)) < len(names):
        raise ValueError(f"empty or repeated parameter names: {names}")
    return params


def _small(word: Column) -> Column:
    """A word as bigint where it is below 2**31, else null."""
    return F.when(
        F.substring(word, 1, 28) == F.lit(bytes(28)), F.conv(F.hex(F.substring(word, 29, 4)), 16, 10).cast("bigint")
    )


def _word_ok(word: Column, kind: str) -> Column:
    """Whether the padding of a word is what its type asks for."""
    digits = F.hex(word)
    if kind == "bool":
        return F.substring(digits, 1, 63) == "0" * 63
    if kind == "address":
        return F.substring(digits, 1, 24) == "0" * 24
    return F.lit(True)


def _word_value(word: Column, kind: str) -> Column:
    if kind == "bool":
        return F.substring(F.hex(word), 64, 1) != "0"
    return F.substring(word, 13, 20) if kind == "address" else word


def _tree(kind: str) -> tuple:
    """A canonical type as ("array", of, length or None), ("tuple", parts), ("dynamic", kind) or ("word", kind)."""
    if m := re.fullmatch(r"(.*)\[(\d*)\]", kind, re.S):
        return "array", _tree(m[1]), int(m[2]) if m[2] else None
    if kind.startswith("("):
        return "tuple", [_tree(x) for x in _split(kind[1:-1])]
    return ("dynamic" if kind in ("string", "bytes") else "word"), kind


def _size(t: tuple) -> int | None:
    """Bytes of a type in place; None when it is held elsewhere, behind an offset."""
    if t[0] == "array":
        return None if t[2] is None or _size(t[1]) is None else t[2] * _size(t[1])
    if t[0] == "tuple":
        sizes = [_size(x) for x in t[1]]
        return None if None in sizes else sum(sizes)
    return 32 if t[0] == "word" else None


def _word(data: Column, at: Column | int) -> Column:
    return F.substring(data, 1 + at, 32) if isinstance(at, int) else F.substring(data, (at + 1).cast("int"), F.lit(32))


def _simple(data: Column, t: tuple, at: Column | int) -> tuple[Column, Column]:
    """(whether it is well-formed, value) of a word at `at`, or of the text or bytes that begin there."""
    size = F.length(data)
    if t[0] == "word":
        word = _word(data, at)
        return (
            F.lit(at) + 32 <= size if isinstance(at, int) else at + 32 <= size
        ) & _word_ok(word, t[1]), _word_value(word, t[1])
    length = _small(_word(data, at))
    value = F.substring(data, (at + 33).cast("int"), length.cast("int"))
    valid = at + 32 + length <= size
    if t[1] == "string":
        value = F.try_validate_utf8(value.cast("string"))
        valid &= value.isNotNull()
    return F.coalesce(valid, F.lit(False)), value


def _let(c: Column, body) -> Column:
    """`body` of a column that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(c), body), 0)


def _pair(ok: Column, value: Column) -> Column:
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), value.alias("v"))


def _nested(data: Column, t: tuple, at: Column | int, base: Column | int) -> Column:
    """struct<ok, v> of any type whose place, or offset from `base`, stands at `at`. Arrays are arrays, tuples structs of
    c0, c1, …; an array that can't fit the data is never laid out."""
    if _size(t) is None:
        return _let(
            _small(_word(data, at)) + base,
            lambda p: _pair(*_simple(data, t, p)) if t[0] == "dynamic" else _laid_out(data, t, p, p),
        )
    return _pair(*_simple(data, t, at)) if t[0] == "word" else _laid_out(data, t, at, base)


def _laid_out(data: Column, t: tuple, at: Column | int, base: Column | int) -> Column:
    if t[0] == "tuple":
        parts, place = [], at
        for i, x in enumerate(t[1]):
            parts.append(_nested(data, x, place, base).alias(f"c{i}"))
            place = place + (_size(x) or 32)
        names = [f"c{i}" for i in range(len(parts))]
        return _let(
            F.struct(*parts),
            lambda s: (
                _pair(
                    reduce(Column.__and__, (s[n]["ok"] for n in names), F.lit(True)),
                    F.struct(*(s[n]["v"].alias(n) for n in names)),
                )
            ),
        )
    if t[2] is None:
        return _let(_small(_word(data, at)), lambda n: _elements(data, t, n, at + 32))
    return _elements(data, t, F.lit(t[2]).cast("bigint"), at)


def _elements(data: Column, t: tuple, n: Column, first: Column | int) -> Column:
    """An array of `n` elements, the first of which, or its offset, stands at `first`."""
    each = _size(t[1]) or 32
    fits = F.coalesce(
        F.lit(first) + n * each <= F.length(data) if isinstance(first, int) else first + n * each <= F.length(data),
        F.lit(False),
    )
    places = F.when(
        fits & (n > 0), F.sequence(F.lit(0).cast("bigint"), n - 1)
    ).otherwise(F.array().cast("array<bigint>"))
    items = F.transform(places, lambda i: _nested(data, t[1], i * each + first, first))
    return _let(items, lambda x: _pair(fits & F.forall(x, lambda y: y["ok"]), F.transform(x, lambda y: y["v"])))


def decode_body(data: Column, params: tuple[Param, ...]) -> tuple[Column, list[Column]]:
    """(whether the whole tuple is well-formed, value of each parameter). Null data counts as empty."""
    data = F.coalesce(data, F.lit(b""))
    valid, values, at = F.lit(True), [], 0
    for p in params:
        t = _tree(p.type)
        if t[0] in ("array", "tuple"):
            found = _nested(data, t, at, 0)
            ok, value = found["ok"], found["v"]
        else:
            ok, value = _simple(data, t, at if t[0] == "word" else _small(_word(data, at)))
        valid &= ok
        values.append(value)
        at += _size(t) or 32
    return F.coalesce(valid & (F.length(data) >= at), F.lit(False)), values


def _decoded(data: Column, params: tuple[Param, ...], body) -> Column:
    """`body` of whether the whole tuple is well-formed and of the values. Arrays and tuples are laid out once for both."""
    if not any(_tree(p.type)[0] in ("array", "tuple") for p in params):
        return body(*decode_body(data, params))

    def found(data: Column) -> Column:
        parts, at = [], 0
        for p in params:
            t = _tree(p.type)
            place = at if t[0] == "word" else _small(_word(data, at))
            part = _nested(data, t, at, 0) if t[0] in ("array", "tuple") else _pair(*_simple(data, t, place))
            parts.append(part.alias(f"p{len(parts)}"))
            at += _size(t) or 32
        return F.struct(*parts, (F.length(data) >= at).alias("whole"))

    def done(s: Column) -> Column:
        valid = reduce(Column.__and__, (s[f"p{i}"]["ok"] for i in range(len(params))), s["whole"])
        return body(F.coalesce(valid, F.lit(False)), [s[f"p{i}"]["v"] for i in range(len(params))])

    return _let(F.coalesce(data, F.lit(b"")), lambda d: _let(found(d), done))


def decode_topic(topic: Column, kind: str, strict: bool = True) -> Column:
    """An indexed parameter; dynamic types are held as their hash. A bad word is an error, or null when not strict."""
    bad = F.raise_error(F.lit(f"topic is not a {kind}")) if strict else F.lit(None)
    return (
        F.when(topic.isNull(), F.lit(None))
        .when((F.length(topic) == 32) & _word_ok(topic, kind), _word_value(topic, kind))
        .otherwise(bad)
    )


def _event_columns(s: Signature, strict: bool) -> list[tuple[Param, Column]]:
    indexed = [p for p in s.params if p.indexed]
    body = tuple(p for p in s.params if not p.indexed)
    valid, values = decode_body(F.col("data"), body)
    return [
        (p, decode_topic(F.col(f"topic{i + 1}"), p.type, strict)) for i, p in enumerate(indexed)
    ] + [(p, F.when(valid, v)) for p, v in zip(body, values, strict=True)]


def decode_logs(logs: DataFrame, signature: str, keep: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """Columns of one event: indexed parameters first, then the body; one row per log, whatever its topic0. A body that
    can't be read is null in all its columns. `keep` names columns of the log that are kept before them."""
    s = parse_signature(signature)
    named(s.params)
    return logs.select(*keep, *(c.alias(p.name) for p, c in _event_columns(s, strict)))


def _text(c: Column, t: tuple) -> Column:
    """A value as text: 0x hex, or true and false, or the string; [a,b] for arrays and (a,b) for tuples."""
    if t[0] == "array":
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _text(x, t[1])), ","), F.lit("]"))
    if t[0] == "tuple":
        return F.concat(F.lit("("), F.concat_ws(",", *(_text(c[f"c{i}"], x) for i, x in enumerate(t[1]))), F.lit(")"))
    return c.cast("string") if t[1] in ("bool", "string") else F.concat(F.lit("0x"), F.lower(F.hex(c)))


def _listed(columns: list[tuple[Param, Column]], names: Column | None = None) -> Column:
    """The parameters as an array, under their own names or, where many signatures share the columns, under `names`."""
    # An indexed array, tuple or text is held as its hash.
    text = lambda p, c: _text(c, ("word", "bytes32") if p.indexed and _tree(p.type)[0] != "word" else _tree(p.type))
    return F.array(
        *(
            F.struct(
                (F.lit(p.name) if names is None else F.get(names, F.lit(i))).alias("name"), F.lit(p.type).alias("type"),
                F.lit(p.indexed).alias("indexed"), text(p, c).alias("value"),
            )
            for i, (p, c) in enumerate(columns)
        )
    )


def event_catalog(signatures: list[str]) -> tuple[list[tuple], list[Signature]]:
    """(rows of topic0, number of topics, event name, layout, parameter names; one signature for each layout). A layout is
    the types of the indexed parameters and of the body; of signatures with the same topic0 and number of topics the first counts."""
    rows: dict[tuple, tuple] = {}
    layouts: dict[tuple, int] = {}
    ones: list[Signature] = []
    for text in signatures:
        s = parse_signature(text)
        indexed, body = ([p for p in s.params if p.indexed == i] for i in (True, False))
        key = tuple(p.type for p in indexed), tuple(p.type for p in body)
        if key not in layouts:
            layouts[key] = len(ones)
            ones.append(s)
        names = [p.name for p in indexed + body]
        rows.setdefault((s.hash, 1 + len(indexed)), (bytearray(s.hash), 1 + len(indexed), s.name, layouts[key], names))
    return list(rows.values()), ones


def decode_events(logs: DataFrame, signatures: list[str], strict: bool = True) -> DataFrame:
    """`logs` with `event` (name of the matching signature) and `params` (name, type, indexed, value as text), null where
    none matches: the key is topic0 with the number of topics.

    Signatures of one layout share one generated decoder; names come from a broadcast table of the signatures, which the
    caller's list bounds. So the expression grows with the layouts, not with the signatures.
    """
    rows, layouts = event_catalog(signatures)
    kinds = "_topic0 binary, _n_topics int, event string, _layout int, _names array<string>"
    catalog = logs.sparkSession.createDataFrame(rows, kinds)
    n_topics = sum((F.col(f"topic{i}").isNotNull().cast("int") for i in range(4)), F.lit(0))
    own = logs.columns
    met = logs.join(F.broadcast(catalog), (F.col("topic0") == F.col("_topic0")) & (n_topics == F.col("_n_topics")), "left")
    params = None
    for i, s in enumerate(layouts):
        hit, listed = F.col("_layout") == i, _listed(_event_columns(s, strict), F.col("_names"))
        params = F.when(hit, listed) if params is None else params.when(hit, listed)
    none = F.lit(None).cast("array<struct<name: string, type: string, indexed: boolean, value: string>>")
    return met.select(*(f"`{c}`" for c in own), "event", (none if params is None else params).alias("params"))


def decode_input(data: Column, signatures: list[str]) -> Column:
    """struct<function, params> of a call by its selector; null for unknown ones, for less than four bytes, and for bodies
    that can't be read."""
    out = None
    for text in signatures:
        s = parse_signature(text)

        def call(valid: Column, values: list[Column], s: Signature = s) -> Column:
            value = F.struct(
                F.lit(s.name).alias("function"), _listed(list(zip(s.params, values, strict=True))).alias("params")
            )
            return F.when(valid, value)

        found = F.when(F.substring(data, 1, 4) == F.lit(s.selector), _decoded(F.substring(data, 5, 1 << 30), s.params, call))
        out = found if out is None else F.coalesce(out, found)
    return out


def decode_output(data: Column, signature: str) -> Column:
    """Return values of `name(inputs)(outputs)` as name, type, indexed, value; null where they can't be read."""
    s = parse_signature(signature)
    valid, values = decode_body(data, s.outputs)
    return F.when(valid & (F.length(data) > 0), _listed(list(zip(s.outputs, values, strict=True))))

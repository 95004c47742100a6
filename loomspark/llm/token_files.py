"""Token-ID output (operator 3): flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id as texts (smaller than their token arrays), encoded, and each partition
writes three files to the shared folder: the ids (16 bits when the vocabulary allows, else 32), the offsets and the
document ids. File names carry the task attempt, and only files that a finished task reported enter the index, so lost
or repeated tasks leave no trace. Bases of the partitions are prefix sums over the reported counts. Reading maps the
files into memory and needs nothing but the index.
"""

from __future__ import annotations

import json
import os
import string
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.scratch import new_path, parts
from loomspark.llm.textarrays import KEPT_BY_WORKER, give_back

#: Id appended to each document.
END = 2
#: Words whose ids a worker keeps; beyond that it starts anew.
KEPT = 1_000_000
#: Bytes of text that are encoded at once.
PIECE = 4 << 20
#: The pattern of byte-level pre-tokenizers that the cuts at words rely on: it is built into the tokenizers library.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
#: ASCII marks without the apostrophe, which may bind letters: the pattern cuts a word of letters before them.
MARKS = "".join(c for c in string.punctuation if c != "'")
_STEM = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"
#: A part between spaces that is empty or holds white space other than one line feed before it.
_WHITE = r"\t\x0B-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ODD = rf"(?s)^\n?$|^[{_WHITE}]|.[\n{_WHITE}]"


def _objects(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def _flags(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _filled(values: pa.Array, where: pa.Array, found: pa.Array) -> pa.Array:
    """`values` with `found`, in order, at the places `where`."""
    at = np.arange(len(values))
    at[_flags(where)] = len(values) + np.arange(len(found))
    return pa.concat_arrays([values, found]).take(pa.array(at))


class WordEncoder:
    """Ids of texts, word by word from a cache, exactly as the tokenizer gives them for whole texts.

    Byte-level BPE splits a text with a pattern before it merges anything; no match of it reaches over the start of a
    single space, or over a single line feed, between two other characters. There texts may be cut, and each word (with
    the space or the line feed before it) is encoded once per worker. Arrow cuts the texts, numbers their distinct words
    and puts the ids together, so Python looks up the distinct words of a piece only. Texts with other white space, which
    shows in the words not met before, or with an added token go whole, and so do all texts of a tokenizer that isn't of
    this kind (`by_words`).
    """

    kept: dict = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), END + 1) <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        cut = spec.get("pre_tokenizer") or {}
        self.by_words = spec.get("normalizer") is None and all(
            cut.get(k) == v for k, v in BYTE_LEVEL.items()
        ) and spec["model"]["type"] == "BPE" and not spec["model"].get("ignore_merges")
        #: Ids by word: with the line feed before it, where one is, else with the space.
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.feed = self._ids(["\n"])[0] if self.by_words else b""
        #: Ids that start with a space: no word holds one but at its own start.
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]] = True

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        return cls.kept[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, self.type).tobytes()
            for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _encoded(self, words: list[str], before: str) -> pa.Array:
        """Ids of new words, encoded many in one text and cut where each begins; `before` is put before each."""
        found, size = [pa.array([], pa.large_binary())], self.type.itemsize
        for at in range(0, len(words), 10_000):
            some = words[at : at + 10_000]
            runs = [some[a : a + 200] for a in range(0, len(some), 200)]
            raw = b"".join(self._ids([before + before.join(r) for r in runs]))
            ids = np.frombuffer(raw, self.type)
            cuts = np.flatnonzero(self.spaced[ids] if before else ids == np.frombuffer(self.feed, self.type))
            if len(cuts) != len(some):
                raise ValueError(f"{len(some)} words gave the ids of {len(cuts)}")
            ends = pa.py_buffer(np.append(cuts, len(ids)).astype(np.int64) * size)
            found.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(some), [None, ends, pa.py_buffer(raw)]))
        self.words.update(zip(words, _objects(pa.concat_arrays(found)), strict=True))
        return pa.concat_arrays(found)

    def _known(self, words: pa.Array) -> pa.Array:
        """Ids of words; null for those not met before."""
        return pa.array(list(map(self.words.get, _objects(words))), pa.large_binary())

    def _learn(self, new: pa.Array) -> pa.Array:
        """Ids of new words; letters with marks after them from the two parts."""
        stems = pc.ascii_rtrim(new, MARKS)
        marked = pc.and_(pc.not_equal(stems, new), pc.match_substring_regex(stems, _STEM))
        stems = pc.if_else(marked, stems, new).dictionary_encode()
        ids, names = self._known(stems.dictionary), stems.dictionary
        for before, kind in (("", pc.starts_with(names, "\n")), (" ", pc.invert(pc.starts_with(names, "\n")))):
            some = pc.and_(ids.is_null(), kind)
            ids = _filled(ids, some, self._encoded(_objects(names.filter(some)), before))
        ids, whole = ids.take(stems.indices), _objects(new)
        marks = [w[len(s) :] for w, s in zip(whole, _objects(names.take(stems.indices)), strict=True)]
        if more := list(set(marks).difference(self.marks)):
            self.marks.update(zip(more, self._ids(more), strict=True))
        after = pa.array(list(map(self.marks.__getitem__, marks)), pa.large_binary())
        ids = pc.binary_join_element_wise(ids, after, pa.scalar(b"", pa.large_binary()))
        self.words.update(zip(_objects(new.filter(marked)), _objects(ids.filter(marked)), strict=True))
        return ids

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if len(self.words) > KEPT:
            self.words, self.marks = {}, {}
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts = texts.fill_null("")
        if not (self.by_words and len(texts)):
            return self._ids(_objects(texts))
        nothing, feed = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
        cut = pc.split_pattern(
            pc.binary_join_element_wise(nothing, pc.replace_substring(texts, "\n", " \n"), feed), " "
        )
        parts = cut.flatten().dictionary_encode()
        codes, parts, sizes = parts.indices.to_numpy(), parts.dictionary, cut.value_lengths().to_numpy()
        ids, whole = self._known(parts), np.zeros(len(texts), bool)
        new = _flags(ids.is_null())
        for a in self.added:
            whole |= _flags(pc.match_substring(texts, a))
        if new.any():
            odd = np.zeros(len(parts), bool)
            odd[new] = _flags(pc.match_substring_regex(parts.filter(pa.array(new)), _ODD))
            whole |= np.logical_or.reduceat(odd[codes], np.cumsum(sizes) - sizes)
        if whole.any():
            codes, sizes = codes[np.repeat(~whole, sizes)], sizes[~whole]
            used = np.zeros(len(parts), bool)
            used[codes] = True
            new &= used
        if new.any():
            new = pa.array(new)
            ids = _filled(ids, new, self._learn(parts.filter(new)))
        # Arrow puts the ids of the words that it takes one after another into one buffer.
        taken = ids.take(pa.array(codes))
        ends = np.append(0, pc.binary_length(taken).to_numpy().cumsum())[np.append(0, np.cumsum(sizes))].tolist()
        raw, first = memoryview(taken.buffers()[2] or b""), len(self.feed)
        rest = iter(self._ids(_objects(texts.filter(pa.array(whole)))))
        # The first word has no line feed before it.
        docs = (bytes(raw[a + first : b]) for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [next(rest if w else docs) for w in whole.tolist()]


KEPT_BY_WORKER.append(WordEncoder.kept)


def _open(uri: str, mode: str):
    """A file of the shared folder: a plain path where it is mounted, else through Arrow's file systems."""
    where = urlparse(uri)
    if where.scheme in ("", "file"):
        return open(where.path, mode)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_output_stream(path) if "w" in mode else system.open_input_file(path)


class Stored:
    """Numbers of one file, read by ranges: mapped into memory where the folder is mounted, else through Arrow."""

    def __init__(self, uri: str, kind: str):
        self.kind = np.dtype(kind)
        where = urlparse(uri)
        if where.scheme in ("", "file"):
            self.size = os.path.getsize(where.path) // self.kind.itemsize
            self.map = np.memmap(where.path, self.kind, "r") if self.size else np.zeros(0, self.kind)
        else:
            self.map, self.file = None, _open(uri, "rb")
            self.size = self.file.size() // self.kind.itemsize

    def part(self, a: int, b: int) -> np.ndarray:
        if self.map is not None:
            return self.map[a:b]
        self.file.seek(a * self.kind.itemsize)
        return np.frombuffer(self.file.read((b - a) * self.kind.itemsize), self.kind)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about PIECE bytes of text; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    ends, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        yield batch.slice(at, to - at)
        at = to


def _write(path: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Spark deals out the cores: threads of the tokenizer would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, task = WordEncoder.of(path), TaskContext.get()
        end = np.array([END], encoder.type).tobytes()
        name = f"{folder}/part-{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        docs = tokens = nulls = 0
        with _open(f"{name}.tokens", "wb") as out, _open(
            f"{name}.offsets", "wb"
        ) as offsets, _open(f"{name}.ids", "wb") as ids:
            for batch in batches:
                for piece in _pieces(batch):
                    done = [x + end for x in encoder.encode(piece.column(1))]
                    sizes = np.array([len(x) for x in done], np.int64) // encoder.type.itemsize
                    out.write(b"".join(done))
                    offsets.write((tokens + np.cumsum(sizes) - sizes).astype("<u8").tobytes())
                    ids.write(np.array([0 if x is None else x for x in piece.column(0).to_pylist()], "<i8").tobytes())
                    nulls += piece.column(0).null_count
                    docs, tokens = docs + len(piece), tokens + int(sizes.sum())
        give_back()
        if docs:
            yield pa.RecordBatch.from_pydict(
                {"part": [task.partitionId()], "name": [name], "docs": [docs], "tokens": [tokens], "nulls": [nulls]},
                schema=pa
                .schema(
                    [
                        ("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()),
                        ("nulls", pa.int64()),
                    ]
                ),
            )

    return run


def write_tokens(documents: DataFrame, path: str, folder: str | None = None) -> str:
    """Encode `documents` (doc_id, text; other columns are ignored) in ascending order of doc_id; the index file's URI.

    A null or empty text is its end id alone. Null ids come first; rows that repeat an id follow each other in the order
    of a hash of their texts. Texts of any length are encoded whole; a hot id or many equal rows are dealt by that hash
    too. An empty table gives an index without files. `path` is the tokenizer's file, the same on every machine. The
    driver handles one row per partition.
    """
    import public_tokenizers  # noqa: F401  (the tokenizers' files must be there)

    spark = documents.sparkSession
    folder = folder or new_path(spark, "tokens")
    if urlparse(folder).scheme in ("", "file"):
        os.makedirs(urlparse(folder).path, exist_ok=True)
    docs = documents.select(F.col("doc_id").cast("bigint"), F.col("text"), F.xxhash64("text").alias("tie"))
    ordered = (
        docs.repartitionByRange(parts(spark), F.col("doc_id").asc_nulls_first(), F.col("tie"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .drop("tie")
    )
    rows = sorted(
        ordered.mapInArrow(_write(path, folder), "part int, name string, docs bigint, tokens bigint, nulls bigint")
        .collect()
    )
    tokens = np.cumsum([0] + [r.tokens for r in rows])
    encoder = WordEncoder.of(path)
    index = {
        "type": encoder.type.str,
        "tokens": int(tokens[-1]),
        "files": [
            {"name": r.name, "base": int(b), "docs": r.docs, "tokens": r.tokens, "nulls": r.nulls}
            for r, b in zip(rows, tokens, strict=False)
        ],
    }
    with _open(f"{folder}/index.json", "wb") as f:
        f.write(json.dumps(index).encode())
    return f"{folder}/index.json"


def _read(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, starts, tokens = Stored(row["name"] + ".ids", "<i8"), Stored(
                    row["name"] + ".offsets", "<u8"
                ), Stored(row["name"] + ".tokens", kind)
                for at in range(0, ids.size, 10_000):
                    to = min(at + 10_000, ids.size)
                    cuts = starts.part(at, to + 1).astype(np.int64)
                    cuts = cuts if to < ids.size else np.append(cuts, tokens.size)
                    crc = [
                        zlib.crc32(tokens.part(a, b).astype("<u4").tobytes())
                        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                    ]
                    null = np.arange(at, to) < row["nulls"]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(ids.part(at, to)), mask=null),
                            pa.array(row["base"] + cuts[:-1]),
                            pa.array(np.diff(cuts)),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_tokens(spark: SparkSession, index_uri: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    with _open(index_uri, "rb") as f:
        index = json.loads(f.read())
    files = [(i, x["name"], x["base"], x["nulls"]) for i, x in enumerate(index["files"])]
    rows = spark.createDataFrame(files, "i int, name string, base bigint, nulls bigint")
    return rows.repartitionById(max(1, len(files)), F.col("i")).mapInArrow(
        _read(index["type"]), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    """The byte-level vocabulary of 50k."""
    import public_tokenizers

    index = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, index)

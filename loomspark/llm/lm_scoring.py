"""LM scoring (operator 13): a log-frequency Bloom filter of quantised bigram counts.

A count c of a bigram is kept as its level 1 + floor(log2 c): the filter holds the bigram once for each level up to its
own, and a reader probes level after level until one is missing. Levels never come out too low; with K hash functions
one comes out too high about once in 2**K times, and counts are bounded by those of the two words besides.

Tasks count their own texts first and send packed counts to segments, by a hash of the bigram; each segment becomes a
piece of the filter, with the exact counts of its words. While all segments together are no larger than a bound they are
broadcast (through the shared folder, where each worker reads them once: nothing passes through the driver) and texts
are scored in place; beyond it a task puts the probes of a run of its texts in the order of segments and reads all
segments once for the run, one at a time, so that no probe is written anywhere. Both ways probe the same filter and give
the same scores.

The model: P(w | v) = (c(v w) + MU * P(w)) / (c(v) + MU), with P(w) = (c(w) + 1) / (N + V + 1) over N training tokens of
V kinds. Each text is followed by one end and preceded by one beginning, which is no token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.scratch import n_bytes, open_shared, parts, written
from loomspark.llm.textarrays import KEPT_BY_WORKER, Words, clear_kept, give_back, mix, text_slices

#: Hashes of the end and of the beginning of a text.
END, BEGIN = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
#: Weight of the unigram model in the bigram one.
MU = 32.0
#: Hash functions of the filter; bits of it for each entry.
K = 6
BITS = K / np.log(2)
#: Bytes of all segments that may be broadcast.
MODEL_BYTES = 128 << 20
#: Bytes of text for a segment, and tokens of a task before their counts are sent on.
SEGMENT_BYTES, HELD = 16 << 20, 3_000_000
#: Bytes of text that are scored at once, probes of a segment that are answered at once.
SLICE, PROBED = 1 << 20, 1 << 18
#: Tokens that go through all segments together, and bytes of text that have about so many.
RUN, RUN_BYTES = 8_000_000, 48 << 20

_GRAM, _LEVEL, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_KEY, _FORTY, _HALF = np.uint64((1 << 40) - 1), np.uint64(40), np.uint64(32)


def token_arrays(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each token, number of its text, where each text starts) of a run of texts, each with its end."""
    words, rows = Words(raw, offsets), len(offsets) - 1
    starts = words.first[:-1] + np.arange(rows)
    token = np.empty(len(words.hash) + rows, np.uint64)
    token[words.first[1:] + np.arange(rows)] = END
    token[np.arange(len(words.hash)) + words.row] = words.hash
    return token, np.repeat(np.arange(rows), np.diff(words.first) + 1), starts


def bigrams(token: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each token and the one before it."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[starts] = BEGIN
    return mix(before * _GRAM + token)


def segment_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _FORTY) % np.uint64(n)).astype(np.int64)


def _pack(h: np.ndarray) -> bytes:
    """The lower five bytes of each hash: within its segment they tell bigrams apart better than the filter does."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _by_segment(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of sorted distinct hashes by segment, bounds of the segments in that order)."""
    segment = segment_of(h, n)
    order = np.argsort(segment, kind="stable")
    return order, np.searchsorted(segment[order], np.arange(n + 1))


COUNTS = "segment int, words binary, word_n binary, grams binary, gram_n binary"


def _count(n: int):
    """Packed counts of the texts of a task, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: list[np.ndarray] = []
        grams: list[np.ndarray] = []
        names = [x.split()[0] for x in COUNTS.split(", ")]

        def rows() -> Iterator[pa.RecordBatch]:
            w, wn = np.unique(np.concatenate(tokens), return_counts=True)
            tokens.clear()
            g, gn = np.unique(np.concatenate(grams), return_counts=True)
            grams.clear()
            (wo, wb), (go, gb) = _by_segment(w, n), _by_segment(g, n)
            w, wn, g, gn = w[wo], wn[wo].astype("<u4"), g[go], gn[go].astype("<u4")
            for at in range(0, n, 16):
                own = [s for s in range(at, min(at + 16, n)) if wb[s] < wb[s + 1] or gb[s] < gb[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.int32()),
                        pa.array([w[wb[s] : wb[s + 1]].tobytes() for s in own], pa.binary()),
                        pa.array([wn[wb[s] : wb[s + 1]].tobytes() for s in own], pa.binary()),
                        pa.array([_pack(g[gb[s] : gb[s + 1]]) for s in own], pa.binary()),
                        pa.array([gn[gb[s] : gb[s + 1]].tobytes() for s in own], pa.binary()),
                    ],
                    names,
                )

        held = 0
        for batch in batches:
            for _, raw, offsets in text_slices(batch.column(0)):
                token, _, starts = token_arrays(raw, offsets)
                tokens.append(token)
                grams.append(bigrams(token, starts))
                held += len(token)
                if held > HELD:
                    yield from rows()
                    held = 0
        if held:
            yield from rows()
        give_back()

    return run


class Summed:
    """Sums of counts by key, of pieces that come one by one."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.held = self.least = 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n.astype(np.int64))
        self.held += len(keys)
        if self.held > max(HELD, 2 * self.least):
            self.least = len(self.total()[0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        keys, n = keys[head], np.add.reduceat(n, head) if len(head) else n
        self.keys, self.n, self.held = [keys], [n], len(keys)
        return keys, n


def level(n: np.ndarray) -> np.ndarray:
    """1 + floor(log2 n), exactly."""
    return np.frexp(n.astype(np.float64))[1].astype(np.int64)


def count_at(q: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.where(q > 0, (3 * np.exp2(q - 1.0) - 1) / 2, 0.0)


def _probe(key: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, step) of the K probes of each key at a level."""
    h = mix(key + np.uint64(q * int(_LEVEL) % (1 << 64)))
    return h, mix(h + _STEP) | np.uint64(1)


def _bits(keys: np.ndarray, q: np.ndarray) -> tuple[int, bytes]:
    """(number of bits, the filter) of the bigrams of one segment; less than 2**32 bits."""
    m = int(min(max(8, -(-int(np.ceil(BITS * q.sum())) // 8) * 8), (1 << 32) - 8))
    bits = np.zeros(m // 8, np.uint8)
    for at in range(1, int(q.max(initial=0)) + 1):
        own = keys[q >= at]
        h, step = _probe(own, at)
        for _ in range(K):
            h = h + step
            place = ((h >> _HALF) * np.uint64(m)) >> _HALF
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), (1 << (place & np.uint64(7))).astype(np.uint8))
    return m, bits.tobytes()


SEGMENTS = "segment int, n_bits bigint, bits binary, words binary, word_n binary, kinds bigint, tokens bigint"


def _segment_row(segment: int, words: Summed, grams: Summed) -> pa.RecordBatch:
    w, wn = words.total()
    g, gn = grams.total()
    m, bits = _bits(g, level(gn))
    return pa.RecordBatch.from_pydict(
        {
            "segment": pa.array([segment], pa.int32()), "n_bits": [m], "bits": pa.array([bits], pa.binary()),
            "words": pa.array([w.tobytes()], pa.binary()), "word_n": pa.array([wn.astype("<i8").tobytes()], pa.binary()),
            "kinds": [len(w)], "tokens": [int(wn.sum())],
        }
    )


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from packed counts that come sorted by segment."""
    now = None
    for batch in batches:
        for row in range(len(batch)):
            segment, w, wn, g, gn = (batch.column(i)[row].as_py() for i in range(5))
            if segment != now:
                if now is not None:
                    yield _segment_row(now, words, grams)
                now, words, grams = segment, Summed(), Summed()
            words.add(np.frombuffer(w, "<u8"), np.frombuffer(wn, "<u4"))
            grams.add(_unpack(g), np.frombuffer(gn, "<u4"))
    if now is not None:
        yield _segment_row(now, words, grams)
    give_back()


class Segments:
    """Some or all segments of the model: exact counts of words, and levels of bigrams by probes of the filter."""

    def __init__(self, rows: list[dict], n: int):
        self.n = n
        self.m, self.at = np.ones(n, np.uint64), np.zeros(n, np.uint64)
        at = 0
        for r in rows:
            self.m[r["segment"]], self.at[r["segment"]] = r["n_bits"], at
            at += r["n_bits"]
        self.bits = np.frombuffer(b"".join([r["bits"] for r in rows] + [b"\0"]), np.uint8)
        words = np.concatenate([np.frombuffer(r["words"], "<u8") for r in rows] or [np.zeros(0, np.uint64)])
        order = np.argsort(words)
        self.words = words[order]
        self.word_n = np.concatenate([np.frombuffer(r["word_n"], "<i8") for r in rows] or [np.zeros(0, np.int64)])[order]
        self.filled = np.zeros(n, bool)
        self.filled[[r["segment"] for r in rows]] = True

    def counts(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.word_n[at], 0)

    def levels(self, h: np.ndarray) -> np.ndarray:
        found = np.zeros(len(h), np.int64)
        segment = segment_of(h, self.n)
        live = np.flatnonzero(self.filled[segment])
        q = 0
        while len(live):
            q += 1
            own = segment[live]
            m, at, where = self.m[own], self.at[own], np.arange(len(live))
            # The keys stay in step with what is left of them: a key is dropped at its first missing bit.
            step_h, step = _probe(h[live] & _KEY, q)
            for _ in range(K):
                step_h = step_h + step
                place = (((step_h >> _HALF) * m) >> _HALF) + at
                hit = (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if not hit.all():
                    step_h, step, m, at, where = step_h[hit], step[hit], m[hit], at[hit], where[hit]
            live = live[where]
            found[live] = q
        return found


class Totals:
    """Tokens and kinds of the training texts, and the two probabilities."""

    def __init__(self, tokens: int, kinds: int):
        self.tokens, self.kinds = tokens, kinds

    def word(self, c: np.ndarray) -> np.ndarray:
        return (c + 1) / (self.tokens + self.kinds + 1)

    def bigram(self, q: np.ndarray, before: np.ndarray, c: np.ndarray) -> np.ndarray:
        together = np.minimum(count_at(q), np.minimum(before, c))
        return (together + MU * self.word(c)) / (before + MU)


RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)
_NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _result(ids, held, n_tokens, n_known, totals: Totals, base, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            ids.cast(pa.int64()), held, pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
            pa.array(np.full(len(n_tokens), totals.tokens), pa.int64()), pa.array(base, pa.float64()),
            pa.array(score, pa.float64()),
        ],
        _NAMES,
    )


def _before(c: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
    """Counts of the tokens before; a text's beginning counts as often as its end, which every text has."""
    before = np.empty_like(c)
    before[1:] = c[:-1]
    before[starts] = end
    return before


def _scored(ids, held, at: int, row, starts, c, end: int, q, totals: Totals) -> pa.RecordBatch:
    """Scores of a slice of texts, of which the first is row `at` of the columns, from the counts and levels of its tokens."""
    rows = len(starts)
    return _result(
        ids.slice(at, rows), held.slice(at, rows), np.bincount(row, minlength=rows), np.bincount(row, c > 0, rows).astype(np.int64),
        totals, np.bincount(row, np.log10(totals.word(c)), rows),
        np.bincount(row, np.log10(totals.bigram(q, _before(c, starts, end), c)), rows),
    )


#: The model that a worker holds, by its files.
_MODELS: dict[tuple, Segments] = {}
KEPT_BY_WORKER.append(_MODELS)


def _rows_of(name: str) -> list[dict]:
    """The segments of a file."""
    with open_shared(name) as f:
        return pq.read_table(f, columns=["segment", "n_bits", "bits", "words", "word_n"]).to_pylist()


def _model(files: tuple[str, ...], n: int) -> Segments:
    if files not in _MODELS:
        clear_kept()
        rows = [r for name in files for r in _rows_of(name)]
        _MODELS[files] = Segments(rows, n)
        del rows
        give_back()
    return _MODELS[files]


def _score(files: tuple[str, ...], n: int, totals: Totals):
    """Scores of texts by a model that every worker holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(files, n)
        for batch in batches:
            for at, raw, offsets in text_slices(batch.column(2), SLICE):
                token, row, starts = token_arrays(raw, offsets)
                kinds, where = np.unique(token, return_inverse=True)
                c, end = model.counts(kinds)[where], model.counts(np.array([END]))[0]
                before = _before(c, starts, end)
                q = np.zeros(len(token), np.int64)
                known = np.flatnonzero((c > 0) & (before > 0))
                q[known] = model.levels(bigrams(token, starts)[known])
                yield _scored(batch.column(0), batch.column(1), at, row, starts, c, end, q, totals)
        give_back()

    return run


def _score_by_segments(files: tuple[str, ...], n: int, totals: Totals, most: int):
    """Scores of texts by a model that no worker holds: the hashes of a run of texts are put in the order of segments, and
    the segments' files are gone through once for it. Nothing of it is written. A run ends with the text that makes it `most` tokens."""

    def scores(held: list[list]) -> Iterator[pa.RecordBatch]:
        cuts = np.cumsum([0, *(len(x[2]) for x in held)])
        token = np.concatenate([x.pop(2) for x in held])
        h = np.concatenate([x.pop() for x in held])
        kinds, where = np.unique(token, return_inverse=True)
        where, end = where.astype(np.int32), np.searchsorted(kinds, END)
        del token
        segment = segment_of(h, n).astype(np.uint32)
        order = np.argsort(segment, kind="stable").astype(np.int32)
        bounds = np.searchsorted(segment[order], np.arange(n + 1))
        del segment
        h = h[order]
        word_order, word_bounds = _by_segment(kinds, n)
        kinds = kinds[word_order]
        q, c = np.zeros(len(h), np.uint8), np.zeros(len(kinds), np.int64)
        for name in files:
            for r in _rows_of(name):
                s, one = r["segment"], Segments([r], n)
                at, to = bounds[s], bounds[s + 1]
                for i in range(at, to, PROBED):
                    q[i : min(i + PROBED, to)] = one.levels(h[i : min(i + PROBED, to)])
                c[word_bounds[s] : word_bounds[s + 1]] = one.counts(kinds[word_bounds[s] : word_bounds[s + 1]])
        del h
        levels, counts = np.empty_like(q), np.empty_like(c)
        levels[order], counts[word_order] = q, c
        del q, c, order
        for (ids, out, starts), at, to in zip(held, cuts[:-1], cuts[1:], strict=True):
            row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, to - at)))
            yield _scored(ids, out, 0, row, starts, counts[where[at:to]], counts[end], levels[at:to].astype(np.int64), totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_kept()
        held: list[list] = []
        tokens = 0
        for batch in batches:
            for at, raw, offsets in text_slices(batch.column(2), SLICE):
                token, _, starts = token_arrays(raw, offsets)
                own = pa.array(np.arange(at, at + len(starts)))  # copies, so that the batch with its texts can go
                held.append([batch.column(0).take(own), batch.column(1).take(own), token, starts, bigrams(token, starts)])
                tokens += len(token)
                if tokens >= most:
                    yield from scores(held)
                    held, tokens = [], 0
                    give_back()
        if held:
            yield from scores(held)
        give_back()

    return run


def lm_scores(documents: DataFrame, model_bytes: int = MODEL_BYTES, run: int = RUN) -> DataFrame:
    """RESULT for every row of `documents` (doc_id, text; other columns are ignored), learned from the rows whose
    crc32(doc_id as text) mod 7 is not 2, those without an id among them.

    A null or empty text is its end alone. Rows that repeat an id or a text are scored and counted each. Texts of any
    length go whole, each within a task. Without training rows all probabilities are 1. An empty table gives no rows.
    """
    spark = documents.sparkSession
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parts(spark), -(-size // SEGMENT_BYTES))
    counts = docs.where("not held_out").select("text").mapInArrow(_count(n), COUNTS)
    segments = written(
        counts.repartition(n, "segment").sortWithinPartitions("segment").mapInArrow(_build, SEGMENTS), "segments"
    )
    whole = segments.agg(F.sum("tokens"), F.sum("kinds")).first()
    totals = Totals(whole[0] or 0, whole[1] or 0)
    if n_bytes(segments) <= model_bytes:
        return docs.mapInArrow(_score(tuple(sorted(segments.inputFiles())), n, totals), RESULT)
    # Each run of texts reads all segments, so tasks are made as large as a run.
    runs = docs.coalesce(max(3 * spark.sparkContext.defaultParallelism, -(-size // RUN_BYTES)))
    return runs.mapInArrow(_score_by_segments(tuple(sorted(segments.inputFiles())), n, totals, run), RESULT)


def op13_lm_scores(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))

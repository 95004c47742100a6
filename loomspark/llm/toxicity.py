"""Toxicity by maximum-scoring segments (operator 2).

Words, and beginnings of longer words (for their endings), get log-odds of the toxic class against the clean one under an informative Dirichlet prior, whose masses follow
the counts of all documents; they are counted and filtered by Spark, all of them. Only words whose log-odds stand out by their standard error score; any other word costs a
small constant, so clean text drifts downward. A linear scan finds all maximal scoring segments of a document. Segment
scores are put on the scale of extreme-value (Karlin-Altschul) statistics: lambda solves the equation of the clean
word mix, K comes from the best segments of all clean learning documents, and a segment's evidence is lambda * score -
ln(K * words). A document's evidence adds those of its significant segments and a logistic curve turns it into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.learning import held_out, learning_labels, logistic_fit
from loomspark.llm.scratch import maybe_broadcast, n_bytes, row_key, written
from loomspark.llm.textarrays import ASCII_PUNCT, Words, clear_kept, text_slices

#: A unit of the model stands in at least so many toxic learning documents. Files of scoring units larger than MODEL_BYTES
#: are an error, as every task holds them all; none is left out.
SUPPORT, MODEL_BYTES = 3, 64 << 20
#: Standard errors that a word's log-odds must stand out by, the prior's mass as a share of the learning words, and what
#: a word without score costs.
STANDS_OUT, PRIOR, DRIFT = 4.0, 0.1, 0.25
#: Least log-odds of a scoring unit. Beginnings of words that are units too, in bytes.
LEAST, BEGINNINGS = 2.0, (4, 5, 6, 7)
EULER = 0.5772156649


@dataclass
class Lexicon:
    """Scoring words (sorted hashes and their log-odds) and the constants of the calibration."""

    words: np.ndarray
    odds: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = 0.0


def _units(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of words, hashes) of every unit: the words, and the beginnings of the longer ones."""
    yield np.arange(len(words.hash)), words.hash
    for k in BEGINNINGS:
        yield words.beginnings(k)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> per batch (unit, docs, n): documents that hold it, and occurrences."""
    clear_kept()
    for batch in batches:
        for _, raw, offsets in text_slices(batch.column("text")):
            words = Words(raw, offsets, ASCII_PUNCT)
            at, unit = (np.concatenate(x) for x in zip(*_units(words), strict=True))
            u, inv = np.unique(unit, return_inverse=True)
            pairs = np.unique(inv.astype(np.int64) * len(offsets) + words.row[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(u.view(np.int64)),
                    pa.array(np.bincount(pairs // len(offsets), minlength=len(u))),
                    pa.array(np.bincount(inv, minlength=len(u))),
                ],
                ["unit", "docs", "n"],
            )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, label) -> per run of texts (unit, n, y1, y0): occurrences of each unit in all, toxic and clean rows;
    the null unit stands for the words altogether."""
    clear_kept()
    for batch in batches:
        labels = np.array([-1 if x is None else x for x in batch.column("label").to_pylist()])
        for first, raw, offsets in text_slices(batch.column("text")):
            words = Words(raw, offsets, ASCII_PUNCT)
            label = labels[first : first + len(offsets) - 1][words.row]
            at, unit = (np.concatenate(x) for x in zip(*_units(words), strict=True))
            u, inv = np.unique(unit, return_inverse=True)
            own = label[at]
            columns = [
                np.append(np.bincount(inv[m], minlength=len(u)), k.sum())
                for m, k in ((own > -2, label > -2), (own == 1, label == 1), (own == 0, label == 0))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(u.view(np.int64), 0), mask=np.arange(len(u) + 1) == len(u)),
                    *map(pa.array, columns),
                ],
                ["unit", "n", "y1", "y0"],
            )


def _member(sorted_words: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in h, their places in sorted_words) of the members; a bitmap over low bits sorts out most others."""
    if not len(sorted_words) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << 20) - 1)
    bitmap = np.zeros(1 << 20, bool)
    bitmap[(sorted_words & low).astype(np.int64)] = True
    at = np.flatnonzero(bitmap[(h & low).astype(np.int64)])
    place = np.minimum(np.searchsorted(sorted_words, h[at]), len(sorted_words) - 1)
    same = sorted_words[place] == h[at]
    return at[same], place[same]


def maximal_segments(starts: np.ndarray, odds: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text whose scoring words stand at `starts` with
    the scores `odds`, any other word costing DRIFT; in one pass over the scoring words (Ruzzo and Tompa)."""
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    gained = 0.0
    for k, (p, s) in enumerate(zip(starts.tolist(), odds.tolist(), strict=True)):
        before = gained - DRIFT * (p - k)
        gained += s
        lo, hi, at = before, before + s, (p, p)
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j -= 1
            if j < 0 or right[j] >= hi:
                left.append(lo)
                right.append(hi)
                span.append(at)
                break
            lo, at = left[j], (span[j][0], at[1])
            del left[j:], right[j:], span[j:]
    return [(a, b, r - lo) for (a, b), lo, r in zip(span, left, right, strict=True)]


def _scan(model: Lexicon):
    """Rows (doc_id, text, …) -> per row the evidence and the significant segments; other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_kept()
        for batch in batches:
            n = len(batch)
            size, best, total = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            segments: list[list] = [[] for _ in range(n)]
            for first, raw, offsets in text_slices(batch.column("text")):
                words = Words(raw, offsets, ASCII_PUNCT)
                rows = len(offsets) - 1
                size[first : first + rows] = np.diff(words.first)
                gain = np.zeros(len(words.hash))
                for who, unit in _units(words):
                    keep, place = _member(model.words, unit)
                    np.maximum.at(gain, who[keep], model.odds[place])
                at = np.flatnonzero(gain)
                cuts = np.searchsorted(words.row[at], np.arange(rows + 1))
                for i in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[i], cuts[i + 1]
                    found = maximal_segments(at[a:b] - words.first[i], gain[at[a:b]])
                    best[first + i] = max(s for _, _, s in found)
                    level = model.log_k + np.log(size[first + i])
                    kept = [(x, y, s, model.rate * s - level) for x, y, s in found if model.rate * s > level]
                    total[first + i] = sum(e for *_, e in kept)
                    segments[first + i] = [{"first": x, "last": y, "score": s, "evidence": e} for x, y, s, e in kept]
            raised = model.rate * best - np.log(np.maximum(size, 1))
            evidence = np.where(total > 0, total, raised - model.log_k)
            score = 1 / (1 + np.exp(-np.clip(model.slope * evidence + model.offset, -700, 700)))
            kind = pa.list_(
                pa.struct(
                    [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("evidence", pa.float64())]
                )
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label") if "label" in batch.schema.names else pa.nulls(n, pa.int32()), batch.column("key") if "key" in batch.schema.names else pa.nulls(n, pa.binary()), pa.array(raised), pa.array(evidence), pa.array(score), pa.array(segments, kind)],
                ["doc_id", "label", "key", "raised", "evidence", "score", "segments"],
            )

    return run


_SCANNED = (
    "doc_id bigint, label int, key binary, raised double, evidence double, score double, segments "
    "array<struct<first: int, last: int, score: double, evidence: double>>"
)


def learn(documents: DataFrame, labels: DataFrame) -> Lexicon:
    """The model from all documents and the labels that may be learned from (see `learning_labels`)."""
    known = learning_labels(labels, "toxic")
    docs = documents.select(F.col("doc_id").cast("bigint"), "text")
    toxic = (
        docs.join(known.where("label = 1"), "doc_id")
        .select("text")
        .mapInArrow(_candidates, "unit bigint, docs bigint, n bigint")
    )
    often = written(
        toxic.groupBy("unit").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= SUPPORT).select("unit"), "units"
    )
    rows = (
        docs.join(known, "doc_id", "left")
        .select("text", "label")
        .mapInArrow(_counts, "unit bigint, n bigint, y1 bigint, y0 bigint")
    )
    sums = rows.groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("n", "y1", "y0")))
    # The supported units are kept by an outer join, which lets the row of the null unit through as well.
    counted = written(
        sums.join(maybe_broadcast(often.withColumn("known", F.lit(True))), "unit", "left")
        .where("known OR unit IS NULL")
        .drop("known"),
        "counts",
    )
    total = counted.where("unit IS NULL").select("n", "y1", "y0").first()
    model = Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    if total and total.y1 and total.y0:
        mass = PRIOR * (total.y1 + total.y0)
        prior = F.lit(mass) * F.col("n") / F.lit(float(total.n))
        y1, y0 = F.col("y1") + F.col("prior"), F.col("y0") + F.col("prior")
        odds = F.log(y1) - F.log(F.lit(total.y1 + mass) - y1) - F.log(y0) + F.log(F.lit(total.y0 + mass) - y0)
        scored = counted.where("unit IS NOT NULL").withColumn("prior", prior).withColumn("odds", odds)
        scored = written(
            scored.where((F.col("odds") / F.sqrt(1 / y1 + 1 / y0) > STANDS_OUT) & (F.col("odds") > LEAST))
            .select("unit", "odds", "y0"),
            "scoring",
        )
        if n_bytes(scored) > MODEL_BYTES:
            raise ValueError(
                f"the scoring units take {n_bytes(scored)} bytes, more than the {MODEL_BYTES} that every task may hold"
            )
        found = scored.toArrow()
        unit, odds, y0 = (found.column(c).to_numpy() for c in ("unit", "odds", "y0"))
        order = np.argsort(unit.view(np.uint64))
        model = Lexicon(unit.view(np.uint64)[order], odds[order])
        model.rate = _lambda(model.odds, y0[order] / total.y0)
    learning = docs.join(known, "doc_id").select("doc_id", "text", "label")
    mean = learning.where("label = 0").mapInArrow(_scan(model), _SCANNED).agg(F.avg("raised")).first()[0]
    model.log_k = (mean or 0.0) - EULER
    bins = (
        learning.mapInArrow(_scan(model), _SCANNED)
        .groupBy("label", F.round(F.greatest(F.lit(-50.0), F.least(F.lit(200.0), "evidence")), 1).alias("x"))
        .count()
        .collect()
    )
    if bins:
        model.slope, model.offset = logistic_fit(
            *(np.array(c, float) for c in zip(*((r.x, r.label, r["count"]) for r in bins), strict=True))
        )
    return model


def _lambda(odds: np.ndarray, share: np.ndarray) -> float:
    """The positive root of the sum of share * exp(lambda * score) = 1 over scoring words and the rest."""
    share = np.maximum(share, 1e-12)
    rest = max(1e-9, 1 - share.sum())
    if not len(odds) or (share * odds).sum() >= rest * DRIFT:
        return 1.0
    lo, hi = 0.0, 1.0
    f = lambda t: (share * np.exp(np.minimum(t * odds, 600))).sum() + rest * np.exp(-t * DRIFT) - 1
    while f(hi) < 0 and hi < 1e3:
        lo, hi = hi, 2 * hi
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `documents` (doc_id, text; others, whatever their names, are left out): doc_id, score (0 to 1), segments
    (first and last word, score, evidence of each significant passage), key (see `row_key`).

    A null or empty text has no segments and the score of no evidence; a text of any length is scanned whole. Equal texts
    have equal scores; repeated rows are each scored, and so is a row without doc_id, which no label can be tied to. Of
    rows that repeat an id all are learned from. Without labels of both classes all rows have the base rate. An empty
    table gives an empty result.
    """
    model = learn(documents, labels)
    rows = documents.select(
        F.col("doc_id").cast("bigint"), "text", row_key(F.col("doc_id"), F.col("text")).alias("key")
    )
    return rows.mapInArrow(_scan(model), _SCANNED).select("doc_id", "score", "segments", "key")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document, by the labels of the rows that are not held out."""
    found = score_toxicity(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("segments").alias("n_segments"),
    )

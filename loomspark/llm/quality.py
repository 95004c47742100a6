"""Quality by naive Bayes support vectors (operator 5).

Features are indicators of n-grams, hashed to a fixed space: single words and pairs, and one to three word shapes in a
row (letters, capitals and digits collapsed to their kind, other characters kept). Each indicator is scaled by the log
ratio of its shares in the two classes, counted over all learning rows; a linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent on a bounded sample of learning rows; a logistic curve over the part of
the sample left out of the fit turns its margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.learning import held_out, learning_labels, logistic_fit
from loomspark.llm.textarrays import Words, clear_kept, grams, text_slices

#: Size of the feature space, and learning rows that the linear model is fitted on.
SPACE = 1 << 18
SAMPLE = 12_000
#: Of five rows of the sample one is left for the logistic curve. Cost of a margin error, and rounds of the descent.
COST, ROUNDS = 1.0, 8


def _shape_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[97:123] = t[128:] = 97
    t[65:91] = 65
    t[48:58] = 48
    t[[9, 10, 11, 12, 13]] = 32
    return t


_SHAPE = _shape_table()
_COLLAPSE = np.isin(np.arange(256), [32, 48, 65, 97])


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted distinct features."""
    for _, raw, offsets in text_slices(column, 1 << 19):
        shaped = _SHAPE[raw]
        keep = np.ones(len(raw), bool)
        keep[1:] = (shaped[1:] != shaped[:-1]) | ~_COLLAPSE[shaped[1:]]
        keep[offsets[:-1][offsets[:-1] < len(raw)]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])
        shapes = Words(shaped[keep], kept[offsets], lower=False)
        plain = Words(raw, offsets)
        found, rows = [], []
        for seed, words, k in ((1, plain, 1), (2, plain, 2), (3, shapes, 1), (4, shapes, 2), (5, shapes, 3)):
            g, row = grams(words, k)
            found.append(((g ^ np.uint64(seed * 0x9E3779B9)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 18))
            rows.append(row)
        key = np.unique(np.concatenate(rows) * SPACE + np.concatenate(found).astype(np.int64))
        cuts = np.searchsorted(key, np.arange(len(offsets)) * SPACE)
        for i in range(len(offsets) - 1):
            yield key[cuts[i] : cuts[i + 1]] % SPACE


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, label) -> per task the features it has seen: counts in rows of label 0 and 1."""
    clear_kept()
    counts = np.zeros((2, SPACE), np.int64)
    for batch in batches:
        for label, f in zip(batch.column("label").to_pylist(), features(batch.column("text")), strict=True):
            counts[label, f] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    for at in range(0, len(seen), 1 << 16):
        x = seen[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x.astype(np.int32)), pa.array(counts[0, x]), pa.array(counts[1, x])], ["feature", "y0", "y1"]
        )


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """log of the ratio of a feature's shares in class 1 and class 0; counts (class, feature) are smoothed by one."""
    share = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights of the linear hinge-loss model over unit-length rows of scaled indicators, by dual coordinate descent:
    each step moves one row's multiplier to where the dual is best for it, within 0 and COST."""
    w, alpha = np.zeros(SPACE), np.zeros(len(rows))
    xs = [scale[f] for f in rows]
    xs = [x / max(1e-9, np.sqrt(x @ x)) for x in xs]
    rng = np.random.default_rng(7)
    for _ in range(ROUNDS):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], xs[i]
            gradient = y[i] * (w[f] @ x) - 1
            new = min(max(alpha[i] - gradient, 0.0), COST)
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    return w


def _fit(scale: np.ndarray):
    """The sample's rows (text, label), in one task -> one row: weights of the features, slope and offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            rows += features(batch.column("text"))
            labels += batch.column("label").to_pylist()
        if not rows:
            return
        y = np.array(labels)
        aside = np.arange(len(y)) % 5 == 4
        if len(set(y[~aside])) < 2 or not aside.any():
            aside[:] = False
        w = dual_descent([f for f, a in zip(rows, aside, strict=True) if not a], 2 * y[~aside] - 1.0, scale)
        test = [i for i in range(len(y)) if aside[i] or not aside.any()]
        slope, offset = logistic_fit(np.array([margin(rows[i], w, scale) for i in test]), y[test], np.ones(len(test)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.astype(np.float64).tobytes()], pa.binary()), pa.array([slope]), pa.array([offset])],
            ["w", "slope", "offset"],
        )

    return run


def margin(f: np.ndarray, w: np.ndarray, scale: np.ndarray) -> float:
    x = scale[f]
    return float(w[f] @ x / max(1e-9, np.sqrt(x @ x)))


def learn(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float, float]:
    """(weights, log-count ratios, slope, offset)."""
    known = learning_labels(labels, "quality")
    rows = documents.select(F.col("doc_id").cast("bigint"), "text").join(known, "doc_id")
    sums = (
        rows.select("text", "label")
        .mapInArrow(_count, "feature int, y0 bigint, y1 bigint")
        .groupBy("feature")
        .agg(F.sum("y0").alias("y0"), F.sum("y1").alias("y1"))
        .toArrow()
    )
    counts = np.zeros((2, SPACE))
    for i, c in enumerate(("y0", "y1")):
        counts[i, sums.column("feature").to_numpy()] = sums.column(c).to_numpy()
    scale = log_count_ratios(counts)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # Of rows that repeat an id the text with the smallest hash is taken, so that reruns agree.
    first = F.min_by(F.struct("text", "label"), F.struct(F.xxhash64("text"), "text")).alias("x")
    sample = (
        documents.select(F.col("doc_id").cast("bigint"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(first)
        .select("doc_id", "x.*")
    )
    fitted = (
        sample.repartition(1)
        .sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
        .select("text", "label")
        .mapInArrow(_fit(scale), "w binary, slope double, offset double")
        .collect()
    )
    if not fitted:
        return np.zeros(SPACE), scale, 0.0, 0.0
    return np.frombuffer(fitted[0].w, np.float64), scale, fitted[0].slope, fitted[0].offset


def _score(w: np.ndarray, scale: np.ndarray, slope: float, offset: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([margin(f, w, scale) for f in features(batch.column("text"))])
            score = 1 / (1 + np.exp(-np.clip(slope * m + offset, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"]
            )

    return run


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `documents` (doc_id, text; others are left out): doc_id, score (0 to 1).

    A null or empty text has no features and the score of a zero margin; a text of any length is whole. Equal texts have
    equal scores; repeated rows are each scored, a null doc_id too, which is not learned from. Of rows that repeat an id
    all count for the ratios, and the text with the smallest hash is fitted. Without labels of both classes all rows have the base rate. An empty table gives an empty result.
    """
    model = learn(documents, labels)
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        _score(*model), "doc_id bigint, score double"
    )


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Every document, by the labels of the rows that are not held out."""
    found = score_quality(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )

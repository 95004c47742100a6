import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomspark.llm import lm_scoring as lm


def tokens(text) -> list:
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held_out(doc) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def plain(rows) -> dict:
    """(doc, text) -> held out, tokens, known ones, N, base score, score with exact bigram counts in their levels."""
    c, g = Counter(), Counter()
    for doc, text in rows:
        if not held_out(doc):
            t = tokens(text)
            c.update(t)
            g.update(zip(["begin", *t[:-1]], t, strict=True))
    n, v, out = sum(c.values()), len(c), {}
    for doc, text in rows:
        t = tokens(text)
        base = [(c[w] + 1) / (n + v + 1) for w in t]
        score = 0.0
        for a, w, p in zip([None, *t[:-1]], t, base, strict=True):
            both = g["begin" if a is None else a, w]
            level = both.bit_length()
            middle = (3 * 2 ** (level - 1) - 1) / 2 if level else 0
            score += math.log10((min(middle, c[a], c[w]) + lm.MU * p) / (c[a] + lm.MU))
        out[doc, text] = (held_out(doc), len(t), sum(c[w] > 0 for w in t), n, sum(map(math.log10, base)), score)
    return out


@pytest.fixture(scope="module")
def rows():
    some = "the quick brown fox jumps over the lazy dog while Rain falls on an old tin roof and nobody hears it".split()
    rows = [(i, " ".join(some[(i * k + k * k) % len(some)] for k in range(1, 5 + i % 40))) for i in range(150)]
    rows += [(None, "the quick brown fox"), (None, None), (3, ""), (3, ""), (4, " \t\n"), (5, "begin\x0band\x1fthe End"), (6, "ÀB àb"), (9, "never-seen word")]
    return [*rows, (501, "over the lazy " * 40_000), (502, "y" * 300_000)]


@pytest.mark.parametrize("limit", [lm.MODEL_BYTES, 0])
def test_scores_against_plain_counts(spark, rows, limit):
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id bigint, text string, segment int, score double")
    got, want = lm.lm_scores(docs, limit).collect(), plain(rows)
    assert len(got) == len(rows)
    by_id = {}
    for (doc, _), w in want.items():
        by_id.setdefault(doc, []).append(w)
    same = more = 0
    for r in got:
        close = [w for w in by_id[r.doc_id] if w[:4] == (r.held_out, r.n_tokens, r.n_known, r.train_tokens) and abs(w[4] - r.base_score) < 1e-8 * max(1, abs(w[4]))]
        assert close, r
        # Levels never come out too low; about once in 2**K they come out too high, which makes a text a little likelier.
        over = min((r.score - w[5] for w in close), key=abs)
        assert -1e-8 * max(1, abs(r.score)) < over < 0.35 * r.n_tokens, r
        same += over < 1e-8 * max(1, abs(r.score))
        more += over
    assert same > len(rows) / 2 and more < 0.01 * -sum(w[5] for w in want.values())


def test_both_ways_agree_and_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.base_score)
    a, b = (sorted(lm.lm_scores(docs, x).collect(), key=key) for x in (lm.MODEL_BYTES, 0))
    for x, y in zip(a, b, strict=True):
        assert x[:5] == y[:5] and x.score == pytest.approx(y.score, rel=1e-9) and x.base_score == pytest.approx(y.base_score, rel=1e-9)
    empty = docs.limit(0)
    assert lm.lm_scores(empty).count() == lm.lm_scores(empty, 0).count() == 0
    held = [d for d in range(100) if held_out(d)][:3]
    none = lm.lm_scores(spark.createDataFrame([(d, "a b") for d in held], "doc_id bigint, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in none] == [(0, 0, 0.0, 0.0)] * 3


def test_filter_has_no_false_negatives():
    draw = np.random.default_rng(5)
    keys = np.unique(draw.integers(0, 1 << 40, 20_000, np.uint64))
    n = draw.integers(1, 1000, len(keys))
    m, bits = lm._bits(keys, lm.level(n))
    one = lm.Segments([{"segment": 0, "n_bits": m, "bits": bits, "words": b"", "word_n": b""}], 1)
    got = one.levels(keys)
    assert (got >= lm.level(n)).all() and (got > lm.level(n)).mean() < 2 * 2.0**-lm.K
    other = np.setdiff1d(draw.integers(0, 1 << 40, 20_000, np.uint64), keys)
    assert (one.levels(other) > 0).mean() < 2 * 2.0**-lm.K
    assert [int(x) for x in lm.level(np.array([1, 2, 3, 4, 7, 8, 2**52]))] == [1, 2, 2, 3, 3, 4, 53]

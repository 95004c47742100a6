"""Scoring by a model that no worker holds: nothing but the model is written."""

import glob
import os

import numpy as np
import pytest

from loomspark.llm import lm_scoring as lm
from loomspark.llm.scratch import shared_folder


def _bytes(path: str) -> int:
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f))


@pytest.mark.parametrize("run", [1, 4000, lm.RUN])
def test_probes_are_not_written(spark, run):
    """Other numbers of tokens go through the segments together; scores are those of the model in each worker."""
    draw = np.random.default_rng(3)
    words = ["".join(draw.choice(list("abcdefgh"), 7)) for _ in range(3000)]
    rows = [(i, " ".join(words[j] for j in draw.integers(0, 3000, 200))) for i in range(300)] + [(None, None), (7, ""), (8, "one")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    folder = shared_folder(spark).removeprefix("file://")
    before = _bytes(folder)
    found = lm.lm_scores(docs, 0, run)
    got = found.collect()
    grown = _bytes(folder) - before
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan, plan
    text = sum(len(t or "") for _, t in rows)
    # A probe is 8 bytes for a word and 8 for a bigram, of 8 bytes of text; the model itself is about a fourth of the text here.
    assert grown < text / 2, (grown, text)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    for a, b in zip(sorted(got, key=key), sorted(lm.lm_scores(docs).collect(), key=key), strict=True):
        assert a[:5] == b[:5] and a.score == pytest.approx(b.score, rel=1e-12) and a.base_score == pytest.approx(b.base_score, rel=1e-12)

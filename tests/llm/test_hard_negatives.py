import math
import random

import numpy as np
import pytest

from loomspark.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int, batch string"


def plain(rows) -> list[tuple]:
    used = []
    for vec_id, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        used.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    last = lambda i: (i is None, i or 0)
    out = []
    for at, (anchor, a, label) in enumerate(used):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a, b, strict=False)), i, lab) for k, (i, b, lab) in enumerate(used) if k != at]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, pid, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(anchor, pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(window, 1)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    centres = [[draw.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = [(i, [c + draw.gauss(0, 0.2) for c in centres[i % 6]], draw.randrange(4), 0, "b") for i in range(700)]
    rows += [(800 + i, list(centres[0]), i % 3, 0, "b") for i in range(300)]  # copies that tie
    rows += [(100, centres[1], 1, 0, "b"), (100, centres[1], 1, 0, "b"), (None, centres[1], 1, 0, "b"), (None, centres[0], 0, 0, "b")]
    rows += [(900, None, 1, 0, "b"), (1200, [1.0, None], 1, 0, "b"), (1300, [float("nan")], 1, 0, "b"), (1400, [float("inf")], 1, 0, "b")]
    rows += [(1500, [], 2, 0, "b"), (1600, [0.5, 0.25], 1, 0, "b"), (1700, centres[2], None, 0, "b"), (-300, centres[3], -5, 0, "b")]
    return rows


def test_against_all_pairs(spark, rows):
    got = [tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key) and len(got) > 100


def test_many_small_blocks(spark, rows, monkeypatch):
    """Trees of several levels, many blocks, runs and batches."""
    for name, value in {"BLOCK": 60, "RUN": 100, "BATCH": 3}.items():
        monkeypatch.setattr(hn, name, value)
    blocks = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in hn.hard_negatives(blocks).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_tree_leaves_out_subtrees_and_loses_nothing():
    draw = np.random.default_rng(2)
    x = np.floor(256 * (np.repeat(draw.normal(0, 3, (40, 6)), 100, 0) + draw.normal(0, 0.05, (4000, 6))))
    space = hn.Space(float((x * x).sum(1).max()))
    order, tree = hn.grow(space, x)
    assert sorted(order.tolist()) == list(range(4000)) and len(tree) == 4
    x, labels, ids = x[order], np.arange(4000) % 3, np.arange(4000)
    read = []

    class Counting(hn.Batch):
        def _leaf(self, node, windows, *rest):
            read.append((node[1] - node[0]) * len(windows))
            super()._leaf(node, windows, *rest)

    anchors = {"n": 20, "vectors": x[:20].tobytes(), "labels": np.arange(20).astype("<i8") % 3}
    zero = np.full(20, -1, "<i8")
    batch = Counting(space, anchors | {"labels": anchors["labels"].tobytes(), "blocks": zero.tobytes(), "places": zero.tobytes()}, 5)
    batch.search(tree, 0, x, labels, ids, np.zeros(4000, bool))
    window, score, found, _ = batch.best()
    for w in range(20):
        want = sorted((-(x[w] @ x[j]), j) for j in range(4000) if labels[j] == w % 3)[:5]
        assert [(-s, i) for s, i in zip(score[window == w], found[window == w], strict=True)] == want
    assert sum(read) < 0.7 * 20 * 4000


def test_wide_numbers_are_exact(spark):
    big = [(100, [3.0e6, 1.0], 1, 0, "b"), (1, [3.0e6, 2.0], 1, 0, "b"), (2, [2.0e6, 1.0], 0, 0, "b"), (3, [2.0e6, 3.0], 0, 0, "b")]
    assert sorted(tuple(r) for r in hn.hard_negatives(spark.createDataFrame(big, SCHEMA)).collect()) == plain(big)


def test_empty(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.hard_negatives(spark.createDataFrame([(100, [1.0], 1, 0, "b")], SCHEMA)).count() == 0

import pytest
from pyspark.sql import functions as F

from loomspark.llm.mixing import WEIGHTS, mix, mix_plan, source_targets

SCHEMA = "doc_id bigint, text string, source string, copies int"


def filled(sizes: dict) -> dict:
    """Water-filling by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    full, left = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {s: float(x) for s, x in full.items()} | share
        for s in over:
            full[s] = 3 * sizes[s]
            left -= full[s]


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 500, "c": 3000, None: 7},
        {"a": 5},
        {f"s{i:02}": 1 + i * i * i for i in range(20)},
        {"a": 0, "b": 9},
        {"a": 9000, "b": 1, "c": 1},
    ],
)
def test_targets_are_the_water_level(spark, sizes):
    got = {
        r.source: r.target
        for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint"))
        .collect()
    }
    for s, t in filled(sizes).items():
        assert got[s] == pytest.approx(t)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_edges(spark):
    rows = [(i, "w " * (i % 50), "hot" if i % 3 else "cold", 1) for i in range(600)] + [
        (None, None, None, 1), (1, "a b", None, 1), (1, "a b", None, 1), (700, "x" * 300_000, "cold", 1)
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "doc_id", "text", "source", "77 AS size", "78 AS target", "79 AS source_size", "80 AS copies", "81 AS copy",
        "82 AS c0", "83 AS w",
    )
    plan = mix_plan(docs)
    assert sorted(plan.columns) == sorted(docs.columns) and plan.where("size = 77 or c0 <> 82").count() == 0
    assert plan.count() == len(rows)
    by = (
        plan.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
        .collect()
    )
    for r in by:
        assert r.taken == pytest.approx(r.target, rel=0.2, abs=6)
    assert plan.where("copies > 3 or copies < 0").count() == 0
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.select(
        "size", "target", "source_size", "copies", "copy", "c0", "w"
    ).distinct().collect() == [(77, 78, 79, 80, 81, 82, 83)]
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert mix_plan(docs).exceptAll(plan).count() == 0
    assert mix(docs.limit(0)).count() == 0

"""Mixing sources to target weights (operator 8), with DataFrame functions only.

Sizes are summed per source (pre-aggregated before the shuffle, so a hot source is one row per task). The targets are
the water-filling level over that small table, in closed form by prefix sums. Each document is then emitted floor(rate)
times, plus once more when a hash of its id, its text and its number among equal rows falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.scratch import maybe_broadcast, row_key, written

#: Weights of the sources in code-point order, repeating, and the most often that a source may repeat.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix-2"
#: Equal rows that are numbered in one window.
NUMBERED = 100_000


def word_count(text: str = "text"):
    """Number of runs of anything but ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    All targets sum to the total of all sizes. Source i gets min(level * weight, most * size): with the sources in
    order of most * size / weight, those up to some place are full, and the level is what is left over, by weight, for
    the others; the first place where the next source stays below its bound fixes it. The order and the prefix sums go
    over one row per source in one task: sources are few beside documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    ranked = sizes.withColumn("w", w.cast("bigint"))
    fill = Window.orderBy((F.col("source_size") * most / F.col("w")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    full = ranked.withColumns({
        "before": F.coalesce(F.sum(F.col("source_size") * most).over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "place": F.row_number().over(fill),
        "left": F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(every),
    })
    level = (F.col("total") - F.col("before")) / F.col("left")
    level = full.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("w") <= F.col("source_size") * most
    )
    level = level.withColumn("level", F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(every)["level"])
    share = F.least(F.coalesce(F.col("level"), F.lit(0.0)) * F.col("w"), (F.col("source_size") * most).cast("double"))
    return level.select("source", "source_size", share.alias("target"))


def _numbered(rows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`rows` with n: the number of a row among those equal in id, text and source, from 1.

    Equal keys are counted first (pre-aggregated); only the rows of those that repeat are numbered, within salted
    windows whose bases are prefix sums, so that a hot key never meets in one task.
    """
    key = F.struct(row_key(F.col(doc_id), F.col(text)).alias("k"), F.xxhash64(F.col("source").isNull(), "source").alias("s"))
    keyed = rows.withColumn("key", key)
    many = written(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "repeated")
    if many.isEmpty():
        return rows.withColumn("n", F.lit(1).cast("bigint"))
    joined = keyed.join(maybe_broadcast(many), "key", "left")
    salts = F.floor(F.col("m") / NUMBERED) + 1
    salted = joined.where("m is not null").withColumn("salt", F.pmod(F.monotonically_increasing_id(), salts))
    size = salted.groupBy("key", "salt").agg(F.count("*").alias("size"))
    before = Window.partitionBy("key").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = written(size.select("key", "salt", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "bases")
    place = F.row_number().over(Window.partitionBy("key", "salt").orderBy(doc_id))
    numbered = salted.withColumn("place", place).join(maybe_broadcast(base), ["key", "salt"])
    single = joined.where("m is null").select(*rows.columns, F.lit(1).cast("bigint").alias("n"))
    return single.union(numbered.select(*rows.columns, (F.col("base") + F.col("place")).alias("n")))


def _plan(documents: DataFrame, weights: tuple, most: int, seed: str) -> DataFrame:
    """The columns of `documents` as c0, c1, …, so that no name can clash, with size, source_size, target and copies."""
    own = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    sized = documents.select(*(F.col(f"`{c}`").alias(x) for c, x in own.items()))
    sized = sized.withColumns({"source": F.col(own["source"]), "size": word_count(own["text"])})
    targets = maybe_broadcast(
        written(
            source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets"
        )
    )
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))
    ).otherwise(0.0)
    row = F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col(own["doc_id"]).cast("string"), F.lit("")),
        F.md5(F.coalesce(F.col(own["text"]), F.lit("")).cast("binary")), F.col("n"),
    )
    draw = F.conv(F.substring(F.sha2(row, 256), 1, 8), 16, 10).cast("bigint") / float(1 << 32)
    joined = _numbered(sized, own["doc_id"], own["text"]).alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    return joined.select(
        *own.values(),
        "size",
        "source_size",
        "target",
        (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("bigint").alias("copies"),
    )


def mix_plan(documents: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """`documents` with size, source_size, target and copies (how often the mix takes each row); columns of these names
    are replaced.

    The draw is a hash of seed, doc_id (null: empty), text and the row's number among those equal in these and in source,
    so reruns agree, and rows that repeat an id or have none are drawn each by itself (which of equal rows has which
    number is left open). A null source is a source of its own, last in order. Empty texts have size 0 and are repeated as their
    source is, or not at all when the whole source is empty; texts of any length count whole. An empty table gives an
    empty result.
    """
    added = ("size", "source_size", "target", "copies")
    plan = _plan(documents, weights, most, seed)
    return plan.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns) if c not in added), *added)


def mix(documents: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row as often as the plan says, all columns as they are in `documents`."""
    plan = (
        _plan(documents, weights, most, seed)
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    return plan.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)))


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 over the sources, at most three copies."""
    plan = mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, source, text, row_number() OVER (PARTITION BY doc_id, text, source) AS n, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w FROM s),
f AS (SELECT *, row_number() OVER o AS place, coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
  (sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest, (sum(source_size) OVER ())::BIGINT AS total
  FROM w WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / w, source NULLS LAST)),
l AS (SELECT *, (total - before)::DOUBLE / rest AS level FROM f),
t AS (SELECT source, source_size, w, least(coalesce((SELECT arg_min(level, place) FROM l WHERE level * w <= 3 * source_size), 0.0) * w, (3 * source_size)::DOUBLE) AS target FROM l),
r AS (SELECT d.doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
  ('0x' || substr(sha256('mix-2:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' || n), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""

"""From raw documents to token files, in five stages, each over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`, whatever
else they are named. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.decontaminate import drop_contaminated
from loomspark.llm.jaccard_join import jaccard_components
from loomspark.llm.mixing import mix
from loomspark.llm.scratch import maybe_broadcast, row_key, unique_ids, written
from loomspark.llm.token_files import read_tokens, write_tokens
from loomspark.llm.toxicity import score_toxicity
from loomspark.ship import shipped


def _without(docs: DataFrame, key: Column, bad: DataFrame) -> DataFrame:
    """The rows of `docs` whose key isn't in `bad` (one column, key)."""
    return docs.select(F.struct("*").alias("row"), key.alias("key")).join(bad, "key", "left_anti").select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored 0.5 or more go, by their own text: rows that share an id, or have none, are each judged. A null or
    empty text has the score of a text without words and is kept; texts of any length go whole; of equal rows all are
    kept or none."""
    scores = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(
        docs, row_key(F.col("doc_id"), F.col("text")), scores.where("score >= 0.5").select("key").distinct()
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of rows that shingles of five words link at 0.8 the one with the smallest id stays (a null id comes
    last; rows that share an id are rows of their own). Of rows equal in id and text one stays. Null, empty and
    wordless texts are linked with nothing and stay; long texts are compared whole."""
    key = row_key(F.col("doc_id"), F.col("text"))
    keys = written(docs.groupBy(key.alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "keys")
    # The join goes by 64 bits of the key; keys that share them with another have ids of their own.
    fresh = maybe_broadcast(written(unique_ids(keys.select("key")), "fresh-ids"))
    numbered = lambda rows: rows.join(fresh, "key", "left").withColumn("id", F.coalesce("id", F.xxhash64("key")))
    texts = numbered(docs.select(key.alias("key"), "text")).select(F.col("id").alias("doc_id"), "text")
    linked = jaccard_components(texts, k=5, percent=80).where("n_links > 0")
    groups = written(linked.select(F.col("doc_id").alias("id"), "component_id").distinct(), "groups")
    # The row that stays is found by partial minima and told from its copies by key: a large group never meets in one task.
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    members = written(groups.join(numbered(keys), "id").select("key", "doc_id", "component_id"), "members")
    best = members.groupBy("component_id").agg(first.alias("key")).select("key")
    copies = members.join(best, "key", "left_anti").select("key")
    kept = _without(docs, key, copies)
    repeated = written(keys.where("n > 1").select("key"), "repeated")
    if repeated.isEmpty():
        return kept
    once = (
        kept.select(F.struct("*").alias("row"), key.alias("key"))
        .join(repeated, "key")
        .groupBy("key")
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )
    return _without(kept, key, repeated).union(once)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated rows go, each by its own text, with or without an id; a null, empty or wordless text is clean, and
    rows equal in id and text go or stay together."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out by the targets of their sources; rows without an id, or that repeat one, are each drawn.
    A null source is a source; null and empty texts have no size."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: one row per document and copy, null ids first. A null or empty text is its end id."""
    import public_tokenizers

    return read_tokens(spark, write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    (name, shipped(f))
    for name, f in (
        ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
        ("mixing", mixing), ("tokens", tokens),
    )
]
#: SQL can't express the first and the last stage; tests hold run() against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs

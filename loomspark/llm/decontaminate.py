"""Benchmark decontamination (operator 6), with DataFrame functions only.

The windows of the benchmark are normalised and form a hash set: the 64-bit hash of a window's words is the key, the
words are kept for the check. The scan of the training texts splits each into words, hashes the window at every place
(13 words, and the sizes of items that are shorter) and probes the broadcast set within one generated loop; a hit is
verified word by word, and hits are merged into spans. Rows are told apart by id and text, never by id alone. The set is
broadcast while its files are small, which is measured; beyond that hashes of windows meet in a shuffled join, salted
against hot windows, and only documents with a hash in common are read again for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.scratch import BROADCAST_BYTES, maybe_broadcast, n_bytes, row_key, written

#: Words in a benchmark window.
WINDOW = 13
#: Parts that the windows of a hash are dealt to in the shuffled join.
SALTS = 16
#: All ASCII characters but letters and digits separate words.
SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words as they are written; [''] when there is none."""
    return F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS)), SPLIT)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def folded(text: Column) -> Column:
    """Lower case for hashing: the two small sigmas, which a lower-cased capital one becomes by what stands around it,
    are one. Texts that are equal but for A-Z have equal ones, whole or cut into words."""
    return F.replace(F.lower(text), F.lit("\u03c2"), F.lit("\u03c3"))


def _window_hash(words: str, at: Column, size: int) -> Column:
    """The hash of `size` words from the place `at` on; null where they go beyond the end."""
    inside = at + size <= F.size(words)
    return F.when(inside, F.xxhash64(F.lit(size), *(F.get(words, at + i) for i in range(size))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per distinct window: hash, size, words, items (the ids of the items that hold it).

    An item of fewer words is one window; one without words, or null, is none. Words are A-Z lower-cased; the hash goes
    over words in `folded` case, which equal ones share.
    """
    items = benchmark.select(
        "item_id", F.split(ascii_lower(F.array_join(words_of(F.col("text")), " ")), " ").alias("w")
    ).where("w[0] <> ''")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    cut = items.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s") + 1, window).alias("w")
    )
    distinct = cut.groupBy(F.array_join("w", " ").alias("words")).agg(
        F.first(F.size("w")).alias("size"), F.collect_set("item_id").alias("items")
    )
    low = distinct.withColumn("l", F.split(folded(F.col("words")), " "))
    by_size = F.coalesce(*(F.when(F.col("size") == n, _window_hash("l", F.lit(0), n)) for n in range(window, 0, -1)))
    return low.select(by_size.alias("hash"), "size", "words", "items")


def _hit_windows(docs: DataFrame, windows: DataFrame, window: int, limit: int) -> DataFrame:
    """(key, start, size, items): every occurrence of a window in the rows of `docs` (key, text)."""
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    split = docs.select("key", words_of(F.col("text")).alias("words"), words_of(folded(F.col("text"))).alias("low"))
    place = F.explode(F.sequence(F.lit(0), F.size("low") - 1)).alias("start")
    hashes = [_window_hash("low", F.col("start"), n) for n in sizes] or [F.lit(None).cast("bigint")]
    hashes = hashes[0].alias("hash") if len(hashes) == 1 else F.explode(F.array(*hashes)).alias("hash")

    def verified(found: DataFrame) -> DataFrame:
        same = ascii_lower(F.array_join(F.slice("words", F.col("start") + 1, F.col("size")), " ")) == F.col("text_of")
        return found.where(same).select("key", "start", "size", "items")

    known = windows.withColumnRenamed("words", "text_of")
    if n_bytes(windows) <= limit:
        placed = split.select("key", "words", "low", place).select("key", "words", "start", hashes)
        return verified(placed.join(F.broadcast(known), "hash"))
    salt = F.pmod(F.xxhash64("key", "start"), F.lit(SALTS)).cast("int")
    placed = (
        split.select("key", "low", place)
        .select("key", "start", hashes)
        .where("hash is not null")
        .withColumn("salt", salt)
    )
    salted = known.select("hash", "size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).distinct()
    near = written(placed.join(salted, ["hash", "salt"]).select("key", "start", "hash", "size"), "near")
    again = (
        split.join(maybe_broadcast(written(near.select("key").distinct(), "near-keys")), "key")
        .select("key", "words")
        .dropDuplicates(["key"])
    )
    return verified(near.join(again, "key").join(known.drop("size"), "hash"))


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, part: int = 20, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (array of start and len), key.

    A row is contaminated when at least 1 in `part` of its words lies in a window of the benchmark. A null, empty or
    wordless text has no words and is clean. Every row is judged by its own text, with or without a doc_id, whether ids
    repeat or not (`key` tells the rows apart, see `row_key`); rows equal in id and text have equal results. Texts of any
    length are whole; other columns of either table, whatever their names, are ignored. An item without item_id hits
    words but has no name to list. An empty benchmark leaves every row clean, an empty table gives an empty result. Windows beyond `limit` bytes of files are joined by a shuffle.
    """
    docs = documents.select("doc_id", "text").withColumn("key", row_key(F.col("doc_id"), F.col("text")))
    windows = written(benchmark_windows(benchmark, window), "windows")
    hits = _hit_windows(docs.select("key", "text"), windows, window, limit)
    spans = hits.groupBy("key", "start").agg(
        F.max("size").alias("len"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))))
    items = F.array_distinct(F.flatten(F.collect_set("items")))
    per_row = (
        spans.withColumn("fresh", fresh)
        .groupBy("key")
        .agg(
            F.sum("fresh").alias("hit"),
            F.array_sort(F.transform(items, lambda x: x.cast("string"))).alias("items"),
            F.array_sort(F.collect_list(F.struct("start", "len"))).alias("spans"),
        )
    )
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(SEPARATORS))
    sizes = docs.select(
        "doc_id",
        "key",
        F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPLIT))).cast("bigint").alias("n_words"),
    )
    n_hit = F.coalesce("hit", F.lit(0)).cast("bigint")
    return sizes.join(per_row, "key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), ((n_hit > 0) & (part * n_hit >= F.col("n_words"))).alias("contaminated"), "spans", "key",
    )


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, part: int = 20, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows that are not contaminated by themselves, as they are, all columns kept."""
    bad = contamination(documents, benchmark, window, part, limit).where("contaminated").select("key").distinct()
    rows = documents.select(F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")


def remove_spans(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """doc_id and `text` with every hit word taken out; the words left are joined by one space in texts with hits,
    and other texts stay as they are."""
    found = (
        contamination(documents, benchmark, window, limit=limit)
        .where("n_hit > 0")
        .select("key", "spans")
        .dropDuplicates(["key"])
    )
    rows = documents.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    kept = F.filter(
        F.transform(words_of(F.col("text")), lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: ~F.exists("spans", lambda s: (x["i"] >= s["start"]) & (x["i"] < s["start"] + s["len"])),
    )
    return rows.join(found, "key", "left").select(
        "doc_id",
        F.when(F.col("spans").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform(kept, lambda x: x["w"]), " "))
        .alias("text"),
    )


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Windows of 13 words; a document with one word in twenty hit is contaminated."""
    found = contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
hits AS MATERIALIZED (
  SELECT doc_id, s, wins.n, item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)) x
  JOIN wins ON x.win = wins.win AND x.n = wins.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

"""Line dedup over windows of three lines (operator 9), with DataFrame functions.

Lines are compared without the white space around them, and blank lines are passed over. Each run of three lines is
hashed (128 bits); so is each line, and each run of two lines, of more than fifty words, which is a passage by itself.
Of windows that stand in more than one place the first place, by doc_id and line, stays, and the lines that later places
cover are removed. A document of one or two lines is one window of all its lines, which is matched by other documents
of just these lines; within longer documents only passages match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.scratch import row_key

LINES = 3
#: A run of fewer lines is a window when it has more words than this.
PASSAGE = 50
SPACE = " \t\r\x0b\x0c"


def _split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _full(lines: Column) -> Column:
    """(place among all lines, trimmed line, words) of the lines that aren't blank."""
    trimmed = F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(SPACE)).alias("t")))
    return F.filter(trimmed, lambda x: x["t"] != "")


def repeated_lines(documents: DataFrame, n: int = LINES, passage: int = PASSAGE) -> DataFrame:
    """(key, places): the places, among the lines of a row that aren't blank, that later occurrences of a window cover.

    An occurrence that overlaps the first place of its own window covers only what lies beyond it. Rows are told apart
    by id and text (`row_key`); places are in order of doc_id (null last), key and line. A window that very many
    documents hold is one row per task when the first places are sought; its later occurrences are spread by the
    adaptive join, and only they travel on.
    """
    keyed = documents.select(
        row_key(F.col("doc_id"), F.col("text")).alias("key"),
        F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id").alias("id"),
        _full(_split_lines(F.col("text"))).alias("full"),
    )
    size = F.size("full")

    def window(s: Column, m: int) -> Column:
        """Window of m lines (or of all lines of a shorter text) from s on, null where it is none."""
        texts = [F.get("full", s + j)["t"] for j in range(m)]
        if m == n:
            kind, holds = size < n, (s == 0) | (s + n <= size)
        else:
            words = sum((F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")) for t in texts), F.lit(0))
            kind, holds = F.lit(False), (s + m <= size) & (words > passage)
        found = F.struct(
            s.cast("int").alias("s"),
            F.least(size, F.lit(m)).alias("n"),
            F.xxhash64(F.lit(m), kind, *texts).alias("h1"),
            F.xxhash64(F.lit(-m), kind, *texts).alias("h2"),
        )
        return F.when(holds, found)

    starts = F.sequence(F.lit(0), size - 1)
    windows = (
        keyed.where(size > 0)
        .select(
            "key",
            "id",
            F.explode(
                F.flatten(
                    F.transform(starts, lambda s: F.array_compact(F.array(*(window(s, m) for m in range(1, n + 1)))))
                )
            )
            .alias("w"),
        )
        .select("key", "id", "w.*")
    )
    place = F.struct("id", "key", "s")
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select("h1", "h2", F.col("first.key").alias("first_key"), F.col("first.s").alias("first_s"))
    )
    same = F.col("key") == F.col("first_key")
    later = windows.join(first, ["h1", "h2"]).where(~(same & (F.col("s") == F.col("first_s"))))
    start = F.when(same, F.greatest("s", F.col("first_s") + F.col("n"))).otherwise(F.col("s"))
    return (
        later.select("key", F.explode(F.sequence(start, F.col("s") + F.col("n") - 1)).alias("p"))
        .groupBy("key")
        .agg(F.collect_set("p").alias("places"))
    )


def dedup_lines(documents: DataFrame, n: int = LINES, passage: int = PASSAGE) -> DataFrame:
    """`documents` with n_lines (not blank), n_removed and `text` without the removed lines.

    A null text has no lines and stays null; a text without removed lines stays as it is; one that loses all lines keeps
    its blank ones. Rows are judged by themselves, with or without a doc_id, whether ids repeat or not; rows equal in id
    and text are one document and stay alike. Texts of any length are whole. Columns named n_lines and n_removed are
    replaced, all others are kept. An empty table gives an empty result.
    """
    found = repeated_lines(documents, n, passage)
    rows = documents.select(
        F.struct("*").alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key")
    ).join(found, "key", "left")
    lines = rows.select(
        "row", "places", _split_lines(F.col("row.text")).alias("lines")
    ).withColumn("full", _full(F.col("lines")))
    gone = F.transform("places", lambda p: F.get("full", p)["i"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    text = F.when(
        F.col("places").isNull() | F.col("row.text").isNull(), F.col("row.text")
    ).otherwise(F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    done = lines.select(
        "row",
        F.struct(
            text.alias("text"),
            F.size("full").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_removed"),
        )
        .alias("done"),
    )
    return done.select(
        *(F.col("row")[c].alias(c) for c in documents.columns if c not in ("text", "n_lines", "n_removed")), "done.*"
    )


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document, with the size and digest of the text that is kept."""
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH l AS MATERIALIZED (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
f AS MATERIALIZED (
  SELECT *, list_filter(list_transform(range(1, len(lines) + 1), lambda i: {'i': i, 't': trim(lines[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12))}), lambda x: x.t <> '') AS f FROM l),
w AS MATERIALIZED (
  SELECT doc_id, s, least(len(f), m) AS n, m, list_transform(f[s:s + m - 1], lambda x: x.t) AS win
  FROM (SELECT doc_id, f, m, unnest(range(1, greatest(len(f) - m + 1, CASE WHEN m = 3 THEN 1 ELSE 0 END) + 1)) AS s FROM f, (VALUES (1), (2), (3)) v(m) WHERE len(f) > 0)
  WHERE m = 3 OR len(regexp_extract_all(array_to_string(list_transform(f[s:s + m - 1], lambda x: x.t), ' '), '[^\x20\x09-\x0D]+')) > 50),
later AS (
  SELECT doc_id, CASE WHEN doc_id = first_doc THEN greatest(s, first_s + n) ELSE s END AS s, s + n AS e
  FROM (SELECT *, row_number() OVER o AS k, first_value(doc_id) OVER o AS first_doc, first_value(s) OVER o AS first_s FROM w WINDOW o AS (PARTITION BY m, win ORDER BY doc_id, s)) WHERE k > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(s, e)) AS p FROM later) GROUP BY doc_id),
k AS (
  SELECT f.doc_id, len(f) AS n_lines, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN coalesce(text, '') ELSE
      array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(list_transform(places, lambda p: f[p].i), i)), lambda i: lines[i]), chr(10)) END AS kept
  FROM f LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_lines::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, length(kept)::BIGINT AS kept_chars, sha256(kept) AS kept_sha256 FROM k
"""

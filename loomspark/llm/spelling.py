"""Spelling variant grouping (operator 11): asymmetric q-chunks.

Two words are near when one edit (one code point inserted, deleted or replaced) makes them equal. The shorter word of a
pair (of equally long ones, the smaller) contributes two disjoint chunks, its two halves; the other contributes its
positional grams of the length of such a chunk. One edit leaves one of the two halves as it is, moved by one place at
most: so the two meet in a join on (which half, length of the shorter word, gram) within a shift of one, and the edit
distance is verified inside the join, which returns near pairs only. Words are counted in tasks before they are
shuffled; a frequent word is one row from then on.

All joins here are asked for as sorted ones: their sides grow with the words, and Spark takes the size of the words' small
files, which the halves and grams exceed a hundred times, for that of the side and would build it in the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.scratch import written

#: Runs of A-Z, a-z and U+00C0 to U+00FF in lower-cased UTF-8 bytes, where the latter are C3 80 to C3 BF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: A run loses one code point where this divides its checksum.
TYPO = 97
#: Words have at least so many code points, and occurrences.
LENGTH, OCCURRENCES = 5, 3
#: A form is at least so many times as frequent as its word.
TIMES = 2
#: Distinct words of a task before their counts are sent on.
HELD = 300_000


def _shortened(run: bytes, h: int) -> bytes:
    """The run without its code point h % length."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def rows() -> Iterator[pa.RecordBatch]:
        words = [w for w in held if len(w) >= LENGTH]  # bytes here; code points are counted by Spark
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()).cast(pa.string()), pa.array([held[w] for w in part], pa.int64())],
                ["word", "n"],
            )
        held.clear()

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if not text:
                continue
            before = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            for run, n in Counter(_RUN.findall(text.lower())).items():
                h = zlib.crc32(run, before)
                held[run if h % TYPO else _shortened(run, h)] += n
            if len(held) > HELD:
                yield from rows()
    yield from rows()


def count_words(documents: DataFrame) -> DataFrame:
    """(word, n) of `documents` (doc_id, text; other columns are ignored): the words of at least LENGTH code points and
    OCCURRENCES occurrences. A null text has no words; a null doc_id counts as empty text in the checksum."""
    docs = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return (
        docs.mapInArrow(_count, "word string, n bigint")
        .where(F.length("word") >= LENGTH)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= OCCURRENCES)
    )


def _chunks(words: DataFrame) -> DataFrame:
    """The two halves of each word: (half, size, gram, at, word, n); size is the word's length."""
    size, half = F.length("word"), F.col("half")
    cut = F.floor(size / 2).cast("int")
    gram = F.substring("word", half * cut + 1, F.when(half == 0, cut).otherwise(size - cut))
    halves = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    return halves.select("word", "n", size.alias("size"), "half", (half * cut).alias("at"), F.xxhash64(gram).alias("gram"))


def _grams(words: DataFrame) -> DataFrame:
    """The positional grams of each word that a half of a word of `size` can meet within a shift of one:
    (half, size, gram, at, word, n), for words of the same length and one shorter."""
    length, size, half, shift = F.length("word"), F.col("size"), F.col("half"), F.col("shift")
    cut = F.floor(size / 2).cast("int")
    at, width = half * cut + shift, F.when(half == 0, cut).otherwise(size - cut)
    sizes = F.array(*(F.struct((length - d).alias("size")) for d in (0, 1)))
    halves = F.array(*(F.struct(F.lit(h).alias("half"), F.lit(s).alias("shift")) for h in (0, 1) for s in (-1, 0, 1)))
    return (
        words.select("word", "n", F.inline(sizes))
        .select("word", "n", "size", F.inline(halves))
        .where((at >= 0) & (at + width <= length))
        .select("word", "n", "size", "half", at.alias("at"), F.xxhash64(F.substring("word", at + 1, width)).alias("gram"))
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for every ordered pair of the distinct `words` (word, n) at edit distance one."""
    a, b = _chunks(words).alias("a"), _grams(words).alias("b")
    meet = (
        (F.col("a.half") == F.col("b.half")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.gram") == F.col("b.gram"))
        & (F.abs(F.col("a.at") - F.col("b.at")) <= 1)
        & ((F.length("b.word") > F.col("a.size")) | (F.col("a.word") < F.col("b.word")))
        & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    )
    pairs = a.join(b.hint("merge"), meet).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    )
    pairs = pairs.distinct()
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of `forms` (word, form): the last word of the chain of forms. Each round doubles the
    steps that are taken; forms never turn back, as each is at least twice as frequent as the one before."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(
            now.join(on.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if not now.where("moved").head(1):
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct `words` (word, n); an empty table gives no rows.

    The form is the near word of largest n (of equal ones, the smallest in code-point order) where that is at least
    TIMES the word's own n, else null; the root is where the forms lead, the word itself where there is none.
    """
    words = written(words.select("word", "n"), "words")
    near = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best")
    )
    form_n = -F.col("best.m")
    is_form = form_n >= TIMES * F.col("n")
    found = written(
        words.join(near.hint("merge"), "word", "left").select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, form_n).alias("form_n"),
        ),
        "forms",
    )
    return (
        found.join(roots(found.where("form is not null")).hint("merge"), "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """All words of all texts."""
    return spelling_variants(count_words(spark.read.parquet(f"{sf_dir}/documents.parquet")))

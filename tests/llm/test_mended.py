"""Cases that once came out wrong: sigma, repeated ids, licence names, pages by other names, hashes that collide."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from loomspark.llm import decontaminate, html_text, licenses, media, mixing, scratch, token_files
from test_operators import BSD3


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_windows_with_sigma(spark, limit):
    items = spark.createDataFrame([("i1", "ΟΔΟΣ ΑΒΓ δεν"), ("i2", "Σ σ ς"), ("i3", "İK")], "item_id string, text string")
    rows = [(1, "x ΟΔΟΣ.ΑΒΓ δεν y"), (2, "οδος αβγ δεν"), (3, "a Σ,σ'ς b"), (4, "σ σ σ"), (5, "ΟΔΟΣ'ΑΒΓ-δεν"), (6, "İK ik")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.contamination(docs, items, limit=limit).collect()}
    assert got == {1: (5, 3), 2: (3, 0), 3: (5, 3), 4: (3, 0), 5: (3, 3), 6: (2, 1)}


def test_mix_of_rows_that_share_an_id_or_have_none(spark):
    one = [(7, f"word{i} " * 11, "a") for i in range(1000)]
    none = [(None, f"word{i} " * 8, "b") for i in range(1000)]
    same = [(9, "the same words here", "b")] * 500 + [(None, None, None)] * 5
    docs = spark.createDataFrame(one + none + same, "doc_id bigint, text string, source string").repartition(5)
    plan = mixing.mix_plan(docs)
    taken = plan.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert plan.count() == 2505
    for r in taken:
        assert r.taken == pytest.approx(r.target, rel=0.06, abs=1)
    many = mixing.mix_plan(docs.repartition(3)).groupBy("doc_id", "text", "copies").count()
    assert many.exceptAll(plan.groupBy("doc_id", "text", "copies").count()).count() == 0


def test_rows_are_numbered_over_salts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "NUMBERED", 7)
    rows = spark.createDataFrame([(1, "a", "s")] * 50 + [(2, "b", None)] * 3 + [(3, "c", "s"), (None, "a", "s")], "doc_id bigint, text string, source string").repartition(6)
    got = mixing._numbered(rows, "doc_id", "text").groupBy("text", "doc_id").agg(F.sort_array(F.collect_list("n")).alias("n")).collect()
    assert {(r.doc_id, r.text): r.n for r in got} == {(1, "a"): list(range(1, 51)), (2, "b"): [1, 2, 3], (3, "c"): [1], (None, "a"): [1]}


def named(text: str) -> list[str]:
    rest, out = "," + ",,".join(x for _, x in licenses.known_sentences(text)) + ",", []
    for name, run in licenses.RULES:
        pattern = "," + ",,".join(run) + ","
        if pattern in rest:
            out.append(name)
            rest = rest.replace(pattern, "")
    return list(dict.fromkeys(out))


OWNED = BSD3.replace("the copyright holder nor", "Google Inc. nor").replace("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT OWNER OR").replace("BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "BY THE AUTHOR")
FORMS = [
    (["BSD-3-Clause"], OWNED), (["BSD-3-Clause"], OWNED.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")), (["BSD-3-Clause"], OWNED.replace("1. ", "a) ").replace("2. ", "(b) ").replace("3. ", "(iii) ")),
    (["BSD-2-Clause"], OWNED.replace(OWNED.split("\n\n")[3] + "\n\n", "")), (["BSD"], OWNED.replace("Neither the name", "In no way the name")), (["BSD"], OWNED.replace("Neither the name", "In no way the name").replace("BY THE AUTHOR", "ONLY")),
    (["MIT"], "MIT License"), (["MIT"], "The MIT License (MIT)"), (["MIT"], "License: MIT"), (["MIT"], "Licensed under MIT."), (["Apache-2.0"], "License: Apache-2.0"),
    (["GPL-2.0-only"], "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation."),
    ([], "The name of a thing may not be used."), ([], "mit"), ([], "In no event shall " + "very " * 40 + "many be liable for any direct"),
]


@pytest.mark.parametrize("names, text", FORMS, ids=range(len(FORMS)))
def test_license_names(names, text):
    assert named("Some words.\n\n" + text + "\n\nMore words.") == names


def test_license_sql_knows_slots(spark):
    import duckdb

    line = "this software is provided by the author as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, ?), (2, 'MIT License')) x(doc_id, text)", [line])
    assert con.execute(licenses.SQL + " ORDER BY doc_id").fetchall() == [(1, 1, "", "bsd_as_is"), (2, 1, "MIT", "")]


LONG = "The long article text goes on, with commas, and more words so that it is a paragraph of its own, as they are."
KEPT = [f"{LONG} {i}" for i in range(3)]
#: (page around the article, what it holds besides): names of classes and ids that stand in no list of the module.
JUNKED = [
    '<ol class="commentlist"><li><p>I like it a lot, thank you, and more.</p></li></ol>', '<div id="comments-area"><p>I like it, too, thank you.</p></div>', '<div class="userComments"><p>Well said, well said.</p></div>',
    '<div class="siteNav"><a href="/a">A</a> <a href="/b">B</a></div>', "<nav data-u=/a/>Menu</nav>", '<div class="sidebarwrap"><p>Read also this, and that.</p></div>', '<div class="shareLinks"><a href="/x">Share</a></div>',
    '<div class="adslot"><p>Buy now, buy here, buy more.</p></div>', '<div class="newsletter-box"><p>Get our letter, every week.</p></div>', '<ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul>', "<div>© 2024 Example, all of it.</div>",
]
PARTS = [
    ('<div class="social-science"><p>{}</p></div>', "Kept words of a part."), ('<div class="follow-up"><p>{}</p></div>', "What came after it."), ('<div id="notice-of-intent"><p>{}</p></div>', "A notice of an intent."),
    ('<div class="article-header"><h2>{}</h2></div>', "A heading of it"), ("{}", "Bare text between blocks."), ("<div>{}</div>", "A short one."), ("<p>In it a <label>label</label> and {}</p>", "<math><mi>x</mi></math> end."), ('<div class="commentary"><p>{}</p></div>', "What it means."),
]


def test_pages_by_other_names():
    kept = lost = extra = 0
    for article in ("article", "div", "main"):
        for junk in JUNKED:
            page = f"<html><body>{junk}<{article}>" + "".join(f"<p>{t}</p>" for t in KEPT) + f"</{article}>{junk}</body></html>"
            lines = html_text.main_text(page).split("\n")
            kept += sum(t in lines for t in KEPT)
            lost += sum(t not in lines for t in KEPT)
            extra += sum(x not in KEPT for x in lines)
    assert (kept, lost, extra) == (3 * len(KEPT) * len(JUNKED), 0, 0)
    for shape, text in PARTS:
        page = f"<html><body><div><p>{KEPT[0]}</p>{shape.format(text)}<p>{KEPT[1]}</p></div></body></html>"
        lines = html_text.main_text(page).split("\n")
        assert lines[0] == KEPT[0] and lines[-1] == KEPT[1] and len(lines) == 3, (shape, lines)
    beside = f"<body><div>{KEPT[0]}</div>Bare text here.<div>A short one.</div></body>"
    assert html_text.main_text(beside) == f"{KEPT[0]}\nBare text here.\nA short one."


@pytest.mark.parametrize(
    "page",
    ["<div>" * 90_000 + "</p>" * 90_000, "<b>" * 100_000 + "<h1></h1>" * 60_000, '<x ">' * 200_000, '<x "' * 250_000, "<li><div>" + "<b>" * 100_000 + "<li></li>" * 60_000, "<p><b>" * 150_000, "<span>" * 100_000 + "t" + "</div></span>" * 60_000],
    ids=["ends", "headings", "quotes", "open quotes", "items", "paragraphs", "spans"],
)
def test_hostile_pages_take_time_in_proportion(page):
    began = time.monotonic()
    html_text.main_text(page[: len(page) // 8])
    part = time.monotonic() - began
    began = time.monotonic()
    html_text.main_text(page)
    assert time.monotonic() - began < 24 * part + 1


def test_media_are_stored_and_read_back(spark, tmp_path):
    rows = [(1, "some text"), (None, None), (2, ""), (2, "some text"), (3, "long " * 200_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    before = set(spark_files(spark, "media-")) | set(spark_files(spark, "features-"))
    got = media.op4_media(spark, str(tmp_path)).collect()
    now = (set(spark_files(spark, "media-")) | set(spark_files(spark, "features-"))) - before
    assert len(now) == 2 and len(got) == 5
    by_text = {}
    for r in got:
        by_text.setdefault(r.payload_sha256, set()).add((r.media_sha256, r.feature))
    assert all(len(x) == 1 for x in by_text.values()) and len(by_text) == 3
    want = {hashlib.sha256(media.payload_of((t or "").encode())).hexdigest() for _, t in rows}
    assert set(by_text) == want


def spark_files(spark, prefix: str) -> list[str]:
    import os

    folder = scratch.shared_folder(spark).removeprefix("file://")
    return [x for x in os.listdir(folder) if x.startswith(prefix)]


def test_ids_of_colliding_hashes(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    few = lambda key: F.pmod(F.xxhash64(key), F.lit(500))
    fresh = {r.key: r.id for r in scratch.unique_ids(keys, few).collect()}
    ids = [fresh.get(r.key, r.id) for r in keys.select("key", few("key").alias("id")).collect()]
    assert len(set(ids)) == 3000 and 2400 < len(fresh) < 3000
    assert scratch.unique_ids(keys).count() == 0


def test_token_files_of_rows_without_and_with_the_same_id(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(3, "b b"), (None, "x"), (3, "a"), (None, None), (3, "b b"), (1, ""), (2, "w" * 300_000), (None, "x")]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "doc_id bigint, text string, tokens string").repartition(3)
    got = sorted(token_files.read_tokens(spark, token_files.write_tokens(docs, path)).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(path)
    sizes = [(d, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in rows]
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens) for r in got) == sorted(((d is None, d or 0), n) for d, n in sizes)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]

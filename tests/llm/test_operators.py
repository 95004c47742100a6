import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.llm import decontaminate, html_text, licenses, line_dedup, media, quality, scratch, token_files, toxicity
from loomspark.llm.textarrays import ASCII_PUNCT, ASCII_SPACE, Words, shingle_sets, text_slices

DATA = Path("/root/testdata/sf0.01")
ODD = [
    "", None, " ", "a", "Ünï cödé 日本 x", "a\tb\r\nc", "x" * 200_000, "it's he'll  x\n\n y ", "a <|endoftext|> b",
    "½ x² n° “q” --a..b-- x,,", "same text", "same text",
]


def docs(spark, texts=ODD):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr(
        "*", "0 AS label", "1 AS score", "'s' AS source", "2 AS size", "'h' AS hits"
    )


def test_words_match_plain_splitting():
    import pyarrow as pa

    texts = [t or "" for t in ODD if not t or len(t) < 1000] * 3
    for separators, pattern in (
        (ASCII_SPACE, rb"[^\x20\x09-\x0D]+"), (ASCII_PUNCT, rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    ):
        seen: dict = {}
        for first, raw, offsets in text_slices(pa.array(texts), 64):
            w = Words(raw, offsets, separators)
            for i in range(len(offsets) - 1):
                found = re.findall(pattern, texts[first + i].encode().lower())
                assert w.first[i + 1] - w.first[i] == len(found)
                for word, h in zip(found, w.hash[w.first[i] : w.first[i + 1]].tolist(), strict=True):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)
    assert [len(s) for s in shingle_sets(pa.array(["", None, "a", "a b c d", "a b c d a b c d"]), 4)] == [0, 0, 1, 1, 4]


def test_token_files_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    real = [r.text for r in spark.read.parquet(str(DATA / "documents.parquet")).limit(60).collect()]
    texts, start = ODD + real, 0
    got = (
        token_files.read_tokens(spark, token_files.write_tokens(docs(spark, texts).repartition(3), path))
        .orderBy("doc_id")
        .collect()
    )
    for r, t in zip(got, texts, strict=True):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.read_tokens(spark, token_files.write_tokens(docs(spark, []), path)).count() == 0


def test_media_round_trip(spark):
    got = media.media_features(media.store_media(docs(spark))).orderBy("doc_id").collect()
    stored = {r.doc_id: bytes(r.media) for r in media.store_media(docs(spark)).collect()}
    for r, t in zip(got, ODD, strict=True):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert media.from_wav(stored[r.doc_id]) == payload
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (
            len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])
        )
        assert (r.media_bytes, r.media_sha256) == (len(stored[r.doc_id]), hashlib.sha256(stored[r.doc_id]).hexdigest())
        assert len(r.codes) == len(r.times) and r.times == sorted(r.times)
    assert got[-1].codes == got[-2].codes
    assert media.media_features(media.store_media(docs(spark, []))).count() == 0


def ascii_words(text):
    return re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    )


def plain_contamination(rows, items):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row, window by window."""
    windows: dict = {}
    for item, text in items:
        w = ascii_words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = ascii_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= x
        names = sorted(str(x) for x in found)
        out.append(
            (
                doc,
                len(w),
                len(hit),
                len(names),
                hashlib.sha256(",".join(names).encode()).hexdigest(),
                bool(hit) and 20 * len(hit) >= len(w),
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [scratch.BROADCAST_BYTES, 0])
def test_decontamination(spark, limit):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    bench = [
        (10, item), (9, item), (2, "short Item"), (3, None), (4, "..."), (5, "Éa éb"), (None, "no id here"),
        (2, "short Item"),
    ]
    texts = [
        f"x, {item.upper()}! y", item[:-10], "a SHORT, item b short  item", None, "", "Éa éb éa Éb", "w " * 500 + item,
        "K short item", "short", "w " * 60_000 + "short item",
    ]
    rows = [
        *enumerate(texts), (None, item), (None, "clean words"), (2, "clean words of a repeated id"),
        (2, "a SHORT, item b short  item"), (7, f"{item} {item}"),
    ]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS words", "2 AS spans", "3 AS key", "4 AS hash", "5 AS size"
    )
    b = spark.createDataFrame(bench, "item_id bigint, text string").selectExpr("*", "1 AS doc_id", "2 AS hash")
    plain = plain_contamination(rows, [(i, t) for i, t in bench if i is not None])
    named = b.where("item_id is not null")
    got = decontaminate.contamination(d, named, limit=limit).drop("spans", "key")
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain
    kept = decontaminate.drop_contaminated(d, named, limit=limit)
    assert kept.columns == d.columns
    clean = [r for r in rows if not plain_contamination([r], [(i, t) for i, t in bench if i is not None])[0][5]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(clean, key=str)
    cleaned = {(r.doc_id, r.text) for r in decontaminate.remove_spans(d, named, limit=limit).collect()}
    assert (0, "x y") in cleaned and (None, "") in cleaned and (
        2, "clean words of a repeated id"
    ) in cleaned and (2, "a b") in cleaned
    assert decontaminate.contamination(d, named.limit(0), limit=limit).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(d.limit(0), named, limit=limit).count() == 0


PAGE = """<html><head><title>t</title><script>x("</p>")</script></head><body><header>Head</header><nav><ul><li><a href=a>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies, and more, and more, and more of them all.</div>
<div id=main-content><h1>A title</h1><p>First &amp; best, with   some <b>bold
words</b>, and more text, to be long enough.<p>Second one<br>after the break, which is a fine paragraph, too.</p><ul><li>One, two<li>three</ul>
<div class="ad">Buy, now, please, this, thing, and, that, thing</div><form>f<input value=x></form></div>
<aside>Side</aside><section id="comments"><p>A reader, writes, a long comment, that has many commas, and words.</p></section><footer>&copy; F</footer></body></html>"""


def test_html(spark):
    assert html_text.main_text(
        PAGE
    ) == "A title\nFirst & best, with some bold words, and more text, to be long enough.\nSecond one after the break, which is a fine paragraph, too.\nOne, two\nthree"
    pages = spark.createDataFrame(
        [
            (1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain < text & more"), (4, "u", "<p" * 50_000),
            (5, "u", "<div>" * 5000 + "deep"),
        ],
        "page_id bigint, url string, html string",
    ).selectExpr("*", "1 AS text")
    got = {(r.page_id, r.n_chars): r.text for r in html_text.extract_pages(pages).collect()}
    assert len(got) == 6 and got[(2, 0)] == got[(3, 0)] == "" and got[(5, 4)] == "deep"
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_html_keeps_what_only_looks_like_junk():
    a = "This is the first paragraph, with commas, and enough text to be scored as one."
    b = (
        "A second paragraph, as long as the first, and with commas, which is no part of the article, but of "
        "another thing, at the side."
    )
    for around in (
        '<div><p data-hidden="false">{}</p></div>',
        '<div><p title="the hidden costs">{}</p></div>',
        '<div class="layout has-sidebar"><article><p>{}</p></article></div>',
        '<form><div><p>{}</p></div></form>',
        '<div class="no-sidebar"><p>{}</p></div>',
        '<div role=form><main><p>{}</p></main></div>',
        '<div class="post comments-open"><div class="has-ads"><p>{}</p></div></div>',
    ):
        assert html_text.main_text("<body>" + around.format(a)) == a
    assert html_text.main_text(f'<div><p>{a} <a href="/x?id=menu">A link</a></p></div>') == f"{a} A link"
    for other in (
        '<div class="related"><article><p>{}</p></article></div>',
        '<section id=comments><article class=comment><p>{}</p></article></section>',
        '<div class=sidebar><p>{}</p></div>',
        "<p hidden>{}</p>",
        "<nav><p>{}</p></nav>",
    ):
        assert html_text.main_text(
            f'<div class="layout has-sidebar"><main><p>{a}</p><p>{a}</p></main>{other.format(b)}</div>'
        ) == f"{a}\n{a}"
    for other in (
        "<div class=ad><p>{}</p></div>", "<div class=cookie-notice><p>{}</p></div>", "<p hidden>{}</p>",
        '<p style="display: none">{}</p>',
    ):
        assert html_text.main_text(f"<div><p>{a}</p></div>{other.format(b)}") == a


def test_maximal_segments_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        starts = np.flatnonzero(rng.random(n) < 0.3)
        if not len(starts):
            continue
        odds = rng.random(len(starts)) * 2 + 0.1
        score = np.full(n, -toxicity.DRIFT)
        score[starts] = odds
        got = toxicity.maximal_segments(starts, odds)
        best = max(score[i : j + 1].sum() for i in range(n) for j in range(i, n))
        assert max(s for *_, s in got) == pytest.approx(best)
        for a, b, s in got:
            assert s == pytest.approx(score[a : b + 1].sum())
            assert all(score[a : k + 1].sum() > -1e-9 and score[k : b + 1].sum() > -1e-9 for k in range(a, b + 1))


@pytest.mark.parametrize(
    ("module", "name", "label", "least"),
    [(toxicity, "score_toxicity", "toxic", 0.93), (quality, "score_quality", "quality", 0.96)],
)
def test_classifiers_on_held_out_rows(spark, module, name, label, least):
    d, labels = (spark.read.parquet(str(DATA.parent / "sf0.1" / f"{t}.parquet")) for t in ("documents", "labels"))
    scored = getattr(module, name)(d.drop("lang", "source"), labels).select("doc_id", "score")
    from loomspark.llm.learning import held_out

    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("score", label).toPandas()
    assert ((rows.score >= 0.5) == (rows[label] == 1)).mean() >= least


@pytest.mark.parametrize("name", ["toxicity.score_toxicity", "quality.score_quality"])
def test_classifier_edges(spark, name):
    f = eval(name)
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None)],
        "doc_id bigint, quality int, toxic int",
    )
    texts = ODD + [("bad idiot words " if i % 2 else "fine good words ") * 5 for i in range(28)]
    got = f(docs(spark, texts), labels).orderBy("doc_id").collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    assert got[10].score == got[11].score and got[0].score == got[1].score
    assert f(docs(spark), labels.limit(0)).count() == len(ODD)
    assert f(docs(spark, []), labels).count() == 0


def test_toxicity_learns_rare_words_beside_many_common_ones(spark):
    from loomspark.llm.learning import held_out

    common = spark.createDataFrame([(" ".join(f"{i:04x}aaaa" for i in range(21_000)),)], "common string")
    learned = [r.id for r in spark.range(200).where(~held_out(F.col("id"))).collect()][:120]
    labels = spark.createDataFrame([(d, int(i < 60)) for i, d in enumerate(learned)], "doc_id bigint, toxic int")
    rare = F.when(F.col("doc_id") < learned[45], F.lit(" vile")).otherwise(F.lit(""))
    model = toxicity.learn(labels.crossJoin(common).select("doc_id", F.concat("common", rare).alias("text")), labels)
    assert model.words.tolist() == Words(np.frombuffer(b"vile", np.uint8), np.array([0, 4]), ASCII_PUNCT).hash.tolist()


def plain_line_dedup(rows):
    """Texts without later occurrences of windows; rows in order of their ids, each id and text once."""
    space = " \t\r\x0b\x0c"
    full = [[(i, x.strip(space)) for i, x in enumerate((t or "").split("\n")) if x.strip(space)] for _, t in rows]
    first, gone = {}, [set() for _ in rows]
    for r, lines in enumerate(full):
        texts = [t for _, t in lines]
        for s in range(len(texts)):
            for m in (1, 2, 3):
                run = texts[s : s + m]
                short = m == 3 and len(texts) < 3
                if not (
                    s == 0 or s + 3 <= len(texts)
                    if m == 3
                    else s + m <= len(texts) and len(re.findall(r"[^\x20\x09-\x0D]+", " ".join(run))) > 50
                ):
                    continue
                place = first.setdefault((m, short, *run), (r, s))
                if place != (r, s):
                    gone[r] |= {p for p in range(s, s + len(run)) if place[0] != r or p >= place[1] + len(run)}
    out = []
    for (doc, text), lines, g in zip(rows, full, gone, strict=True):
        cut = {lines[p][0] for p in g}
        out.append(
            (
                doc,
                None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in cut),
                len(lines),
                len(g),
            )
        )
    return out


def test_line_dedup(spark):
    block = "l one\nl two\nl three\nl four"
    texts = [
        f"a\n{block}\nz", f"b\n\n {block}\ny", "q\nl two\nl three\nx", block, "tiny", "tiny", None, "", "\n\n",
        "r\nr\nr\nr\nr",
    ]
    got = line_dedup.dedup_lines(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.text for r in got] == [texts[0], "b\n\ny", texts[2], "", "tiny", "", None, "", "\n\n", "r\nr\nr"]
    assert [r.n_removed for r in got] == [0, 4, 0, 4, 0, 1, 0, 0, 0, 2]
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_edges_and_passages(spark):
    long, half = " ".join(f"w{i}" for i in range(51)), " ".join(f"v{i}" for i in range(30))
    rows = [
        (1, f"k1\nk2\nk3\n{long}\nend"), (2, "x1\nx2\nx3"), (2, "k1\nk2\nk3"), (3, f"other\n {long} \nmore"), (4, long), (5, f"{half}\n{half}\na"), (6, f"b\n{half}\n{half}"), (7, f"{half}\nc"),
        (8, "h\nh\nh\nh\nend"), (9, "line\n" * 30_000), (None, "k1\nk2\nk3"), (None, "own\nlines\nhere"), (None, None),
    ]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "7 AS places", "8 AS lines", "9 AS full", "10 AS key", "11 AS n_lines"
    )
    got = line_dedup.dedup_lines(d.repartition(3))
    assert {(r.places, r.lines, r.full, r.key) for r in got.collect()} == {(7, 8, 9, 10)}
    assert sorted(
        ((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=str
    ) == sorted(plain_line_dedup(rows), key=str)
    assert (2, "x1\nx2\nx3", 3, 0) in plain_line_dedup(rows) and (
        3, "other\nmore", 3, 1
    ) in plain_line_dedup(rows) and (
        8, "h\nh\nh\nend", 5, 1
    ) in plain_line_dedup(rows)
    same = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc")], "doc_id bigint, text string")
    assert [r.text for r in line_dedup.dedup_lines(same).collect()] == ["a\nb\nc"] * 2


def test_licenses(spark):
    apache = (
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0\nUnless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    )
    texts = [
        apache,
        "x\nReleased under the MIT License.\ny",
        "licensed under cc by-nc 4.0",
        None,
        "",
        "All rights reserved. This work is licensed under the GNU General Public License, version 3.",
    ]
    got = licenses.scan_licenses(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == [["Apache-2.0"], ["MIT"], ["CC-BY-NC-4.0"], [], [], ["GPL-3.0"]]
    assert got[5].unmatched == ["all_rights"] and got[0].n_sentences == 5
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


MIT_WRAPPED = """MIT License

Copyright (c) 2020 A. Name
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
"""


BSD3 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
FREE = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU "
    "{name} as published by the Free Software Foundation; either version {v} of the License, or (at your option) "
    "any later version.\n\nThis {what} is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
    "GNU {name} for more details."
)
WHOLE = [
    ("MIT", "\n\n".join(" ".join(p.split()) for p in MIT_WRAPPED[MIT_WRAPPED.index("Permission") :].split("\n\n"))), ("BSD-3-Clause", BSD3), ("BSD-2-Clause", BSD3.replace(BSD3.split("\n\n")[3] + "\n\n", "")), ("ISC", ISC),
    ("GPL-2.0-or-later", FREE.format(what="program", mark=";", name="General Public License", v=2)), ("GPL-3.0-or-later", FREE.format(what="program", mark=":", name="General Public License", v=3)),
    ("LGPL-2.1-or-later", FREE.format(what="library", mark=";", name="Lesser General Public License", v="2.1")), ("LGPL-3.0-or-later", FREE.format(what="program", mark=":", name="Lesser General Public License", v=3)),
    ("AGPL-3.0-or-later", FREE.format(what="program", mark=":", name="Affero General Public License", v=3)),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"), ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"), ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("MIT", "// SPDX-License-Identifier: MIT"), ("LGPL-2.1-or-later", "# SPDX-License-Identifier: LGPL-2.1-or-later"), ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


@pytest.mark.parametrize("wrap", [0, 72, 40])
def test_whole_license_texts(spark, wrap):
    import textwrap

    cut = lambda t: "\n\n".join("\n".join(textwrap.wrap(p, wrap)) if wrap and "\n" not in p else p for p in t.split("\n\n"))
    rows = [
        (i % 7 or None, "Some words before it.\n\n" + cut(t) + "\n\nSome words after it.")
        for i, (_, t) in enumerate(WHOLE)
    ]
    for (name, _), row in zip(WHOLE, rows, strict=True):
        ids = [x for _, x in licenses.known_sentences(row[1])]
        found = licenses.scan_licenses(
            spark.createDataFrame([row], "doc_id bigint, text string")
        ).first() if wrap == 40 and name in ("ISC", "MPL-2.0") else None
        assert found is None or found.licenses == [name] and found.unmatched == []
        rest, got = "," + "".join(f"{x},," for x in ids)[:-1] if ids else ",", []
        for licence, run in licenses.RULES:
            pattern = "," + ",,".join(run) + ","
            if pattern in rest:
                got.append(licence)
                rest = rest.replace(pattern, "")
        assert got == [name] and not rest.strip(","), (name, ids)


def test_wrapped_licenses(spark):
    notices = "words before\nReleased under the MIT License\nAll rights reserved\nwords after"
    parted = "This program is distributed in the hope\n\nthat it will be useful"
    got = (
        licenses.scan_licenses(
            docs(spark, [MIT_WRAPPED, GPL_HEADER, GPL_HEADER.replace("\n# ", "\r\n// "), notices, parted])
        )
        .orderBy("doc_id")
        .collect()
    )
    assert [r.licenses for r in got] == [["MIT"], ["GPL-3.0-or-later"], ["GPL-3.0-or-later"], ["MIT"], []]
    assert [r.n_sentences for r in got][0] == 5 and got[0].unmatched == [] and got[3].unmatched == ["all_rights"]


def plain_pipeline(rows, scores, items, encode):
    """(doc_id, start, n_tokens, crc) of every row and copy, in plain Python but for the scores of toxicity."""
    from test_jaccard_join import shingles
    from test_mixing import filled

    rows = [r for r in rows if scores[r[1]] < 0.5]
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2] or ""))
    sets = [shingles(t, 5) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    rows = [r for r in rows if not plain_contamination([r[:2]], items)[0][5]]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, t, source in rows:
        sizes[source] = sizes.get(source, 0) + words(t)
    targets, taken = filled(sizes), []
    for doc, t, source in rows:
        rate = min(targets[source] / sizes[source], 3.0) if sizes[source] else 0.0
        seed = f"mix-2:{'' if doc is None else doc}:{hashlib.md5((t or '').encode()).hexdigest()}:1"
        draw = int(hashlib.sha256(seed.encode()).hexdigest()[:8], 16) / 2**32
        taken += [(doc, t)] * (int(rate) + (draw < rate - int(rate)))
    out, start = [], 0
    for doc, t in sorted(taken, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(t or ""), 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def small_corpus(spark, tmp_path_factory):
    """Tables of 120 real documents with copies, odd rows, clashing columns, and their labels and benchmark."""
    where = str(tmp_path_factory.mktemp("small"))
    real = [
        (r.doc_id, r.text, r.source)
        for r in spark.read.parquet(str(DATA / "documents.parquet")).orderBy("doc_id").limit(120).collect()
    ]
    items = [(r.item_id, r.text) for r in spark.read.parquet(str(DATA / "benchmark.parquet")).limit(20).collect()]
    near = [(1000 + d, t + " one more word", s) for d, t, s in real[:30]]
    odd = [
        (None, None, None),
        (3001, "", "src1"),
        (3002, items[0][1], "src2"),
        (3003, "quiet words of a row " + items[1][1], None),
        (3004, "some words that stand alone here", "src0"),
        (3004, "some words that stand alone here", "src0"),
        (None, real[5][1], "src0"),
    ]
    schema = "doc_id bigint, text string, source string"
    documents = spark.createDataFrame(real + near + odd, schema)
    documents.selectExpr(
        "*", "1 AS key", "2 AS size", "3 AS row", "4 AS copies", "5 AS score", "6 AS component_id", "7 AS n_chars"
    ).write.parquet(f"{where}/documents.parquet")
    spark.read.parquet(str(DATA / "labels.parquet")).write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, real + near + odd, items


def test_pipeline_against_plain_python(spark, small_corpus):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    where, rows, items = small_corpus
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    read = lambda t: spark.read.parquet(f"{where}/{t}.parquet")
    scores = {
        r.text: r.score
        for r in toxicity
        .score_toxicity(read("documents"), read("labels"))
        .alias("s")
        .join(read("documents").select("text", scratch.row_key(F.col("doc_id"), F.col("text")).alias("key")), "key")
        .collect()
    }
    want = plain_pipeline(rows, scores, items, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    got = corpus_pipeline.run(spark, where).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(
        tuple(r) for r in got.collect() if r.doc_id is not None
    ) == sorted(r for r in want if r[0] is not None)
    assert len(want) == got.count() and 0 < len(want) < len(rows) * 3


def test_pipeline_stages_on_edges(spark, small_corpus):
    import corpus_pipeline

    where, _, _ = small_corpus
    d = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, where).columns == d.columns
        assert stage(spark, d.limit(0), where).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, d.limit(0), where).count() == 0

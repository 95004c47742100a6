"""Operators that SQL can't express, held against plain versions on small inputs."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from loomspark.llm import html_text, media, quality, toxicity
from loomspark.llm.learning import held_out
from loomspark.llm.textarrays import ASCII_PUNCT, Words
from pyspark.sql import functions as F

DATA = Path("/root/testdata/sf0.01")


def units_of(text: str) -> list[tuple[str, int]]:
    """Words, lower-cased, and the beginnings of the longer ones, as (unit, length of the beginning or 0)."""
    words = re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.encode().lower())
    return [(w, 0) for w in words] + [(w[:k], k) for w in words for k in toxicity.BEGINNINGS if len(w) > k]


def unit_hash(unit: bytes, k: int) -> int:
    text = unit + b"x" if k else unit
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ASCII_PUNCT)
    return int(words.beginnings(k)[1][0] if k else words.hash[0])


def plain_segments(gain: list[float]) -> float:
    """Sum of the scores of the maximal segments, found by the definition: best segment, then left and right of it."""
    best, at = 0.0, None
    for i in range(len(gain)):
        total = 0.0
        for j in range(i, len(gain)):
            total += gain[j]
            if total > best + 1e-12:
                best, at = total, (i, j)
    return [] if at is None else [*plain_segments(gain[: at[0]]), best, *plain_segments(gain[at[1] + 1 :])]


def test_toxicity_against_plain_counts(spark):
    rng = random.Random(2)
    learned = [r.id for r in spark.range(400).where(~held_out(F.col("id"))).collect()][:200]
    bad, good = ["vileness", "nasty", "grimly"], [f"word{i}" for i in range(60)]
    rows = []
    for d in learned:
        toxic = int(d in learned[::4])
        text = [rng.choice(good) for _ in range(rng.randint(5, 40))]
        for _ in range(4 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((d, " ".join(text), toxic))
    rows += [(1000 + i, " ".join(rng.choice(good + bad) for _ in range(20)), None) for i in range(20)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(d, t) for d, _, t in rows if t is not None], "doc_id bigint, toxic int")
    model = toxicity.learn(documents, labels)

    n, y, docs, words = Counter(), (Counter(), Counter()), Counter(), [0, 0, 0]
    for _, text, t in rows:
        found = units_of(text)
        size = sum(k == 0 for _, k in found)
        n.update(found)
        words[2] += size
        if t is not None:
            y[t].update(found)
            words[t] += size
            docs.update(set(found) if t else ())
    mass, want = toxicity.PRIOR * (words[0] + words[1]), {}
    for u in (u for u, c in docs.items() if c >= toxicity.SUPPORT):
        prior = mass * n[u] / words[2]
        a, b = y[1][u] + prior, y[0][u] + prior
        odds = math.log(a / (words[1] + mass - a)) - math.log(b / (words[0] + mass - b))
        if odds / math.sqrt(1 / a + 1 / b) > toxicity.STANDS_OUT and odds > toxicity.LEAST:
            want[unit_hash(*u)] = (odds, y[0][u] / words[0])
    assert want and dict(
        zip(model.words.tolist(), model.odds.tolist(), strict=True)
    ) == pytest.approx({h: o for h, (o, _) in want.items()})
    share = [max(s, 1e-12) for _, s in want.values()]
    assert sum(
        s * math.exp(model.rate * o) for (o, _), s in zip(want.values(), share, strict=True)
    ) + (1 - sum(share)) * math.exp(-model.rate * toxicity.DRIFT) == pytest.approx(1, abs=1e-6)

    def gains(text):
        found = re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.encode().lower())
        own = lambda w: max([want[h][0] for h in [unit_hash(w, 0), *(unit_hash(w[:k], k) for k in toxicity.BEGINNINGS if len(w) > k)] if h in want], default=0.0)
        return [own(w) or -toxicity.DRIFT for w in found]

    scores = {d: plain_segments(gains(t)) for d, t, _ in rows}
    size = {d: len(gains(t)) for d, t, _ in rows}
    raised = {d: model.rate * max(s, default=0.0) - math.log(max(size[d], 1)) for d, s in scores.items()}
    clean = [raised[d] for d, _, t in rows if t == 0]
    assert model.log_k == pytest.approx(sum(clean) / len(clean) - toxicity.EULER)
    got = {r.doc_id: r for r in toxicity.score_toxicity(documents, labels).collect()}
    for d, s in scores.items():
        kept = [e for x in s if (e := model.rate * x - model.log_k - math.log(size[d])) > 0]
        evidence = sum(kept) if kept else raised[d] - model.log_k
        assert got[d].score == pytest.approx(
            1 / (1 + math.exp(-min(max(model.slope * evidence + model.offset, -700), 700)))
        )
        assert [x.evidence for x in got[d].segments] == pytest.approx(kept)


def test_quality_ratios_and_dual_optimum(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "Dd", "9"], 6)) for _ in range(60)]
    label = [int("aa aa" in t or rng.random() < 0.3) for t in texts]
    ids = [r.id for r in spark.range(200).where(~held_out(F.col("id"))).collect()][: len(texts)]
    documents = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string")
    labels = spark.createDataFrame(list(zip(ids, label, strict=True)), "doc_id bigint, quality int")
    import pyarrow as pa

    rows = list(quality.features(pa.array(texts)))
    counts = np.ones((2, quality.SPACE))
    for f, y in zip(rows, label, strict=True):
        for x in f:
            counts[y, x] += 1
    want = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    assert quality.learn(documents, labels)[1] == pytest.approx(want)
    w, t = texts[0].split(), {"A": "A", "a": "a"}
    shape = [
        "".join({"l": "a", "u": "A", "d": "0"}["d" if c.isdigit() else "u" if c.isupper() else "l"] for c in x)
        for x in w
    ]
    shape = [re.sub(r"(.)\1+", r"\1", x) for x in shape]
    grams = {("w", x) for x in zip(*[[y.lower() for y in w]])} | {
        ("w", *x) for x in zip([y.lower() for y in w], [y.lower() for y in w][1:])
    }
    grams |= {("s", *x) for k in (1, 2, 3) for x in zip(*[shape[i:] for i in range(k)])}
    assert len(rows[0]) == len(grams) and t

    y = 2.0 * np.array(label) - 1
    x = np.zeros((len(rows), quality.SPACE))
    for i, f in enumerate(rows):
        x[i, f] = want[f] / np.sqrt((want[f] ** 2).sum())
    objective = lambda v: v @ v / 2 + quality.COST * np.maximum(0, 1 - y * (x @ v)).sum()
    gram, alpha = (y[:, None] * (x @ x.T) * y), np.zeros(len(y))
    for _ in range(20_000):
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, quality.COST)
    best = objective(x.T @ (alpha * y))
    assert objective(quality.dual_descent(rows, y, want)) == pytest.approx(best, rel=0.05)


def test_quality_query_on_held_out_rows(spark):
    found = quality.op5_quality(spark, str(DATA.parent / "sf0.1"))
    rows = (
        found.join(spark.read.parquet(str(DATA.parent / "sf0.1" / "labels.parquet")), "doc_id")
        .where("held_out")
        .select("score", "predicted", "quality")
        .toPandas()
    )
    assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    assert (rows.predicted == rows.quality).mean() >= 0.95


def test_fingerprint_against_plain_transform():
    rng = np.random.default_rng(6)
    samples = rng.integers(0, 256, 576 * 3).astype(np.uint8)
    window = [0.5 - 0.5 * math.cos(2 * math.pi * i / 575) for i in range(576)]
    waves = np.exp(-2j * np.pi * np.outer(np.arange(289), np.arange(576)) / 576)
    bins, mags = [], []
    for at in range(0, len(samples) - 575, 288):
        frame = np.array([(float(samples[at + i]) - 128) * window[i] for i in range(576)])
        spectrum = np.abs(waves @ frame)
        best = [max(range(1 + 72 * b, 73 + 72 * b), key=lambda k: spectrum[k]) for b in range(4)]
        bins.append(best)
        mags.append([spectrum[k] for k in best])
    peak = lambda t, b: all(mags[t][b] >= mags[u][b] for u in (t - 1, t + 1) if 0 <= u < len(mags))
    want = []
    for t in range(len(bins)):
        for step in range(4):
            for i in range(4):
                for j in range(4):
                    if t + step < len(bins) and peak(t, i) and peak(t + step, j) and (step or i < j):
                        want.append((t, bins[t][i] | bins[t + step][j] << 9 | step << 18))
    codes, times = media.fingerprint(samples)
    assert list(zip(times.tolist(), codes.tolist(), strict=True)) == sorted(want)


def test_html_on_made_pages(spark):
    """Articles in many kinds of wrapping, each with all kinds of things around it; the text is known."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    sentence = lambda n: ", ".join(" ".join(word() for _ in range(6)) for _ in range(n)).capitalize() + "."
    junk = [
        "<nav><a href=/>Home</a> <a href=/b>Other</a></nav>",
        '<div class="sidebar"><p>Popular now, and more, and more of it.</p></div>',
        '<div id="cookie-notice"><p>We use cookies, many of them, for all things.</p></div>',
        "<footer><p>Copyright, all of it, of some company.</p></footer>",
        '<div class="ad">Buy this, now, at once, for less.</div>',
        "<form><label>Mail</label><input name=q><button>Send</button></form>",
        "<script>var x = '<p>no, no, no</p>';</script><style>p{}</style>",
        '<section id="comments"><p>I think, as a reader, that this is fine, very fine.</p></section>',
        '<aside><p>By the way, this, that, and something else.</p></aside>',
        "<!-- <p>gone, gone, gone</p> -->",
    ]
    pages, want = [], []
    for i in range(60):
        blocks = [("h1", sentence(1))] + [
            (rng.choice(["p", "p", "p", "blockquote"]), sentence(rng.randint(3, 8))) for _ in range(rng.randint(2, 6))
        ]
        body = ""
        for tag, text in blocks:
            shown = text.replace(" ", rng.choice([" ", "\n  ", "\t"]), 1).replace(
                "a", rng.choice(["a", "&#97;", "<b>a</b>"]), 1
            )
            body += f"<{tag}>{shown}</{tag}>" + (rng.choice(junk) if rng.random() < 0.2 else "\n")
        body += "<ul><li>first, of the list</li><li>second</li></ul>"
        start, end = [
            ("<article>", "</article>"),
            ("<main><div>", "</div></main>"),
            ('<div class="content">', "</div>"),
            ('<div class="layout has-sidebar"><article>', "</article></div>"),
            ('<div id="page"><div class="post-body">', "</div></div>"),
        ][i % 5]
        before, after = ("".join(rng.sample(junk, 4)) for _ in range(2))
        pages.append(
            (i, f"u{i}", f"<html><head><title>T</title></head><body>{before}{start}{body}{end}{after}</body></html>")
        )
        want.append("\n".join([t for _, t in blocks] + ["first, of the list", "second"]))
    got = (
        html_text.extract_pages(
            spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "1 AS n_chars")
        )
        .orderBy("page_id")
        .collect()
    )
    assert [r.text for r in got] == want
    assert all(r.n_chars == len(r.text) for r in got)

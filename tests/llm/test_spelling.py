import re
import zlib
from collections import Counter

from loomspark.llm import spelling


def plain_words(rows) -> dict[str, int]:
    found: Counter[str] = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(n: dict[str, int]) -> set[tuple]:
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min(x, key=lambda y: (-n[y], y)) for w, x in near.items() if x}
    form = {w: f for w, f in form.items() if n[f] >= 2 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_variants_of_documents(spark):
    base = ["garden", "gardens", "gardn", "gärden", "Überall", "uberall", "aaaaaa", "aaaaaaa", "aaaaaaaa", "house", "mouse", "mousse"]
    rows = [(i, " ".join(w for k, w in enumerate(base) for _ in range((i * (k + 3)) % 5)) + ".X-" + base[i % 12] * 2) for i in range(60)]
    rows += [(None, "garden Garden GARDEN Àbcde àbcde " * 3), (7, None), (8, ""), (9, "word " * 50_000), (9, "word " * 50_000)]
    rows += [(10, "x" * 900 + " " + "x" * 899 + "y"), (11, "x" * 900 + " " + "x" * 899 + "y")] * 3
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id bigint, text string, n int, word string")
    got = {tuple(r) for r in spelling.spelling_variants(spelling.count_words(docs)).collect()}
    want = plain_variants(plain_words(rows))
    assert got == want and any(r[1] for r in want)
    assert spelling.spelling_variants(spelling.count_words(docs.limit(0))).count() == 0


def test_near_pairs_are_all_pairs(spark):
    import itertools
    import random

    draw = random.Random(3)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(400)}
    got = [(r.word, r.near) for r in spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")).collect()]
    want = {(a, b) for a, b in itertools.permutations(words, 2) if one_edit(a, b) and min(len(a), len(b)) > 1}
    assert {p for p in got if min(map(len, p)) > 1} == want and len(got) == len(set(got))


def test_long_chains_of_forms(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)] + [("a", "w039")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert len(got) == 41 and set(got.values()) == {"w040"}

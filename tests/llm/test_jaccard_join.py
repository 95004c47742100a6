import random

from loomspark.llm import jaccard_join as J


def shingles(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = [(d, shingles(t, k)) for d, t in rows]
    links = {
        i: {j for j, (_, b) in enumerate(sets) if j != i and a and 100 * len(a & b) >= percent * len(a | b)}
        for i, (_, a) in enumerate(sets)
    }
    out = []
    for i, (d, s) in enumerate(sets):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((d, len(s), min(sets[j][0] for j in seen), len(links[i])))
    return sorted(out)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(1, 12)):
            t = list(base)
            for _ in range(rng.randint(0, 6)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t + passage * rng.randint(0, 1)))
    texts += [texts[0]] * 90 + [texts[0].upper()] + ["", " \t\n", None, "one", "One", "a b c", "a b c d", "é É", "é É"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def check(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS n", "'x' AS shingle", "2 AS component"
    )
    got = sorted(tuple(r) for r in J.jaccard_components(df.repartition(3), **more).collect())
    assert got == brute(rows, more["k"], more["percent"])


def test_against_brute_force(spark):
    check(spark, corpus(), k=4, percent=85)


def test_frequent_shingles_and_small_blocks(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(1)
    monkeypatch.setattr(J, "BLOCK_DOCS", 7)
    got = sorted(tuple(r) for r in J.jaccard_components(df, k=5, percent=80).collect())
    assert got == brute(rows, 5, 80)


def test_long_lists_in_parts(spark, monkeypatch):
    monkeypatch.setattr(J, "LONGEST", 8)
    monkeypatch.setattr(J, "CHUNK", 64)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert sorted(tuple(r) for r in J.jaccard_components(df, k=4, percent=85).collect()) == brute(rows, 4, 85)
    import numpy as np
    import pyarrow as pa

    s = np.sort(np.repeat(np.arange(40), np.arange(40)))
    node = np.concatenate([np.arange(i) for i in range(40)])
    batches = [
        pa.RecordBatch.from_arrays([pa.array(s[a : a + 13]), pa.array(node[a : a + 13])], ["shingle", "node"])
        for a in range(0, len(s), 13)
    ]
    got = sorted(tuple(r.values()) for b in J._index(iter(batches)) for r in b.to_pylist())
    assert got == sorted((x, min(i, 8), i) for i in range(2, 40) for x in range(i))


def test_templated_texts_and_blocks_of_bands(spark, monkeypatch):
    """Texts made of shared passages: many short lists in common, few links; homes of several blocks and bands."""
    rng = random.Random(11)
    passages = [" ".join(f"p{i}w{j}" for j in range(12)) for i in range(12)]
    rows = [(i, " ".join(rng.sample(passages, rng.randint(2, 6))) + f" own{i % 150}") for i in range(200)]
    monkeypatch.setattr(J, "BLOCK_DOCS", 9)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(tuple(r) for r in J.jaccard_components(df, k=4, percent=60).collect()) == brute(rows, 4, 60)


def test_rows_that_share_an_id(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve"
    rows = [(5, a), (5, b), (2, a), (9, b), (7, "something else that is on its own")]
    got = {
        (r.doc_id, r.component_id)
        for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    }
    assert got == {(5, 2), (2, 2), (9, 2), (7, 7)}


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert J.jaccard_components(none).count() == 0
    odd = spark.createDataFrame(
        [(None, "a b c d e f"), (None, None), (1, "a b c d e f"), (1, "a b c d e f"), (2, "word " * 60_000)],
        "doc_id bigint, text string",
    )
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(odd).collect()), key=str)
    assert got == sorted([(None, 2, None), (None, 0, None), (1, 2, 1), (1, 2, 1), (2, 1, 2)], key=str)


def test_entries_of_the_index_that_collide(spark, monkeypatch):
    """With entries of eight bits nearly every shingle shares its entry with others, also within a set; no link is lost."""
    monkeypatch.setattr(J, "CUT", 56)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert sorted(tuple(r) for r in J.jaccard_components(df, k=4, percent=85).collect()) == brute(rows, 4, 85)


def test_merge_by_a_heap_that_skips():
    from collections import Counter

    rng = random.Random(5)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(0, 30))) for _ in range(rng.randint(1, 9))]
        posts, spans = [], []
        for x in lists:
            spans.append((len(posts), len(posts) + len(x)))
            posts += x
        least = rng.randint(1, len(lists))
        found, counts = J.merge_skip(posts, spans, least)
        assert dict(zip(found, counts)) == {v: c for v, c in Counter(posts).items() if c >= least}
        assert found == sorted(found)


def test_divide_skip_however_lists_are_divided(monkeypatch):
    import numpy as np

    rng = random.Random(8)
    bases = [[rng.randrange(10**6) for _ in range(rng.randint(5, 80))] for _ in range(6)]
    sets = [
        np.unique(np.array([x if rng.random() > 0.06 else rng.randrange(10**6) for x in rng.choice(bases)], np.uint64))
        for _ in range(120)
    ]
    sides = [None, np.array([i % 3 == 0 for i in range(120)], np.int8)]
    for side in sides:
        linked = lambda i, j: 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 70 * (len(sets[i]) + len(sets[j]) - c)
        expected = {
            (j, i) for i in range(120) for j in range(i) if (side is None or side[i] != side[j]) and linked(i, j)
        }
        for mu in (0.0, 0.002, 0.1, 10.0):
            monkeypatch.setattr(J, "MU", mu)
            assert {tuple(sorted((i, int(j)))) for i, js in J.divide_skip(sets, 70, side) for j in js} == expected
    assert expected


def test_a_large_group_does_not_meet_small_homes_as_a_whole(spark, monkeypatch):
    """120 near copies; 40 of them share one rare passage each with a small group of other texts."""
    rng = random.Random(21)
    words = lambda tag, n: [f"{tag}w{j}" for j in range(n)]
    base, texts = words("base", 64), []
    for i in range(120):
        t = list(base)
        t[rng.randrange(64)] = f"edit{i % 90}"
        texts.append(t + (words(f"rare{i}", 8) if i < 40 else []))
    for i in range(40):
        body = words(f"body{i}", 24)
        texts += [body + words(f"rare{i}", 8), *(body + [f"own{i}x{j}"] for j in range(3))]
    rows = list(enumerate(map(" ".join, texts)))
    kept, write = {}, J.written
    monkeypatch.setattr(J, "written", lambda df, name, *more: kept.setdefault(name, write(df, name, *more)))
    monkeypatch.setattr(J, "BLOCK_DOCS", 16)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(tuple(r) for r in J.jaccard_components(df, k=5, percent=80).collect()) == brute(rows, 5, 80)
    home = {r.block: r.home for r in kept["blocks"].collect()}
    dealt = kept["dealt"].collect()
    assert len({home[r.low] for r in dealt}) > 20
    # Two classes or a few for each passage, not the 120 of the group.
    between = [r for r in dealt if home[r.low] != home[r.high]]
    assert 0 < len(between) <= 400

"""N-gram Jaccard self-join by T-occurrence search (operator 1).

Two documents link when their sets of word shingles overlap by the threshold. The join runs in five steps:

1. A pass over the documents turns each text into its set of hashed shingles; equal sets are one class.
2. A second pass spreads (shingle, class) pairs over the cluster, sorted by shingle: an inverted index that is streamed,
   so that a list of any length takes bounded memory. A shingle of one class only is dropped there; the others go back
   to their classes with the length of their list.
3. T-occurrence: a set of n shingles and a partner at least as similar as the threshold share all but a few, so of the
   shingles in order of rising frequency the first n - T + 1 hold a common one. Sets whose first n - T + 1 are all
   unique are out. The lists of the rest are the short lists.
4. A class goes home to the smallest class in the longest of its short lists. Homes are cut into blocks of bounded size,
   large ones by bands of set sizes first, and a pair of blocks is a task when it may hold a link: within a home, or
   between two homes with a short list in common, and then only for the classes in such lists. Nothing is closed
   transitively, so chains of lists don't grow into one large group.
5. In each task the T-occurrence problem is solved by DivideSkip on whole sets: the short inverted lists are merged by
   a heap that skips, documents reaching T - L are probed in the L long lists by binary search, and those reaching the
   overlap are links. A task returns a spanning forest of its links and the number of links per document, never the pairs.

Shingles are 64-bit hashes, and so are classes until sets are compared: two different ones are taken as equal with
chance 2**-64 a pair. The index holds the upper 48 bits of a shingle, which makes its shuffle smaller: two shingles that
share them make a list longer and may bring sets together for comparison, but lose no link.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.components import connected_components
from loomspark.llm.scratch import maybe_broadcast, written
from loomspark.llm.textarrays import clear_kept, shingle_sets

#: Bits of a shingle that the index leaves out.
CUT = 16
#: Postings in one output batch, and digests kept to fold copies, of the second pass.
CHUNK = 1 << 17
#: Lists this long count as equally long, and are passed on in parts.
LONGEST = 1 << 16
#: Weighs probes against pops when lists are divided: a probe is one of many in a numpy call, a pop a step of Python.
MU = 0.002
#: Bounds of a block: documents and shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 384, 1 << 19


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n with any partner of at most its size."""
    return -(-percent * n // 100)


def _digest(s: np.ndarray) -> list[int]:
    """128 bits of a set; zeros for the empty one."""
    return np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist() if len(s) else [0, 0]


def _cut(s: np.ndarray) -> np.ndarray:
    """The entries of a sorted set in the index, sorted and distinct."""
    c = s >> np.uint64(CUT)
    keep = np.ones(len(c), bool)
    np.not_equal(c[1:], c[:-1], out=keep[1:])
    return c[keep]


def _rows(k: int):
    """Texts -> size of the set, entries it has in the index, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_kept()
        for batch in batches:
            found = [(len(s), len(_cut(s)), *_digest(s)) for s in shingle_sets(batch.column(1), k)]
            columns = [
                batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*found, strict=True))
            ] if found else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "entries", "d1", "d2"])

    return run


def _postings(k: int):
    """Texts -> (shingle, node), node being the class's d1. Copies that come close after one another are folded."""

    def posted(sets: list[np.ndarray], nodes: list[int]) -> pa.RecordBatch:
        node = np.repeat(np.array(nodes, np.int64), [len(s) for s in sets])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sets).view(np.int64)), pa.array(node)], ["shingle", "node"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clear_kept()
        seen: set[int] = set()
        for batch in batches:
            sets, nodes, held = [], [], 0
            for s in shingle_sets(batch.column(0), k):
                node = _digest(s)[0]
                if not len(s) or node in seen:
                    continue
                if len(seen) >= CHUNK:
                    seen.clear()
                seen.add(node)
                sets.append(_cut(s))
                nodes.append(node)
                held += len(s)
                if held >= CHUNK:
                    yield posted(sets, nodes)
                    sets, nodes, held = [], [], 0
            if sets:
                yield posted(sets, nodes)

    return run


def _ranked(node: np.ndarray, rank: np.ndarray, shingle: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(node), CHUNK):
        to = at + CHUNK
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[at:to]), pa.array(rank[at:to].astype(np.int32)), pa.array(shingle[at:to])],
            ["node", "rank", "shingle"],
        )


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, node) in order of the shingle -> (node, rank, shingle) of shingles of two or more classes; rank is
    the length of the list, LONGEST at most. Of a list in parts, repeats of a class are left to the next step."""

    def lists(s: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((node, s))
        s, node = s[order], node[order]
        fresh = np.ones(len(s), bool)
        fresh[1:] = (s[1:] != s[:-1]) | (node[1:] != node[:-1])
        s, node = s[fresh], node[fresh]
        head = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        length = np.diff(np.append(head, len(s)))
        rank = np.repeat(np.minimum(length, LONGEST), length)
        keep = rank > 1
        yield from _ranked(node[keep], rank[keep], s[keep])

    s, node, long = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for batch in batches:
        if not len(batch):
            continue
        s, node = np.concatenate([s, batch.column(0).to_numpy()]), np.concatenate([node, batch.column(1).to_numpy()])
        if long is not None:
            to = int(np.searchsorted(s, long, "right"))
            yield from _ranked(node[:to], np.full(to, LONGEST), s[:to])
            s, node = s[to:], node[to:]
            if not len(s):
                continue
            long = None
        cut = int(np.searchsorted(s, s[-1]))
        if cut:
            yield from lists(s[:cut], node[:cut])
            s, node = s[cut:], node[cut:]
        if len(s) >= LONGEST and len(np.unique(node)) >= LONGEST:
            long = int(s[0])
            yield from _ranked(node, np.full(len(node), LONGEST), s)
            s, node = s[:0], node[:0]
        elif len(s) >= 2 * LONGEST:
            node = np.unique(node)
            s = np.full(len(node), s[0])
    if len(s):
        yield from lists(s, node)


def _short_lists():
    """Rows of classes, each class's together: first, of rank -1, how many entries its short lists have beyond those in
    the index at large (n - T + 1 less its entries), then its postings by rising frequency -> the postings of the first
    n - T + 1 shingles, of classes that can have a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [np.zeros(0, np.int64) for _ in range(3)]
        for batch in batches:
            if not len(batch):
                continue
            columns = [np.concatenate([c, batch.column(i).to_numpy()]) for i, c in enumerate(columns)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                yield chosen(*(c[:cut] for c in columns))
                columns = [c[cut:] for c in columns]
        if len(columns[0]):
            yield chosen(*columns)

    def chosen(node: np.ndarray, rank: np.ndarray, shingle: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(node), bool)
        fresh[1:] = (node[1:] != node[:-1]) | (shingle[1:] != shingle[:-1]) | (rank[1:] != rank[:-1])
        node, rank, shingle = node[fresh], rank[fresh], shingle[fresh]
        start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff(np.append(start, len(node)))
        room = shingle[start] + size - 1
        place = np.arange(len(node)) - np.repeat(start + 1, size)
        keep = (rank > 0) & (place < np.repeat(room, size))
        return pa.RecordBatch.from_arrays([pa.array(shingle[keep]), pa.array(node[keep])], ["shingle", "node"])

    return run


def merge_skip(posts: list[int], spans: list[tuple[int, int]], least: int) -> tuple[list[int], list[int]]:
    """The entries that stand in `least` or more of the sorted lists posts[a:b], and in how many, from a heap of the
    lists' heads. Where too few lists begin with the smallest entry, more are popped until least - 1 are out: an entry
    below the head that is left can't reach `least` any more, so all of them skip to it by binary search."""
    k = len(spans)
    at = [a for a, _ in spans]
    heap = [posts[a] * k + j for j, (a, b) in enumerate(spans) if a < b]
    heapq.heapify(heap)
    found, counts = [], []
    while len(heap) >= least:
        entry = heap[0] // k
        popped = []
        while heap and heap[0] // k == entry:
            popped.append(heapq.heappop(heap) % k)
        if len(popped) >= least:
            found.append(entry)
            counts.append(len(popped))
            beyond = entry + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap) % k)
            if not heap:
                break
            beyond = heap[0] // k
        for j in popped:
            at[j] = bisect_left(posts, beyond, at[j], spans[j][1])
            if at[j] < spans[j][1]:
                heapq.heappush(heap, posts[at[j]] * k + j)
    return found, counts


class _Lists:
    """The inverted lists of some of the sets: of token i, posts[head[i] : head[i + 1]], in rising order."""

    def __init__(self, ident: np.ndarray, owner: np.ndarray, n_tokens: int):
        by = np.lexsort((owner, ident))
        self.posts = owner[by]
        self.entries = self.posts.tolist()
        self.head = np.searchsorted(ident[by], np.arange(n_tokens + 1))
        self.length = np.diff(self.head)


def divide_skip(
    sets: list[np.ndarray], percent: int, side: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray]]:
    """All links among the sets: (i, the linked j), each pair once. With `side`, only pairs of different sides.

    For each set in order of size, T is the least overlap with any set of at most its size. Its inverted lists are
    divided: the L longest are left aside, the short ones are merged by a heap; sets that occur in T - L of them are
    probed in the long lists by binary search, and those reaching the overlap that their two sizes ask for are links.
    L = T / (MU log2(longest list) + 1), T - 1 at most.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order], np.int64)
    token, ident = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    owner = np.repeat(np.arange(len(order)), size)
    begin = np.concatenate([[0], np.cumsum(size)])
    who = side[order] if side is not None else np.zeros(len(order), np.int8)
    index = {w: _Lists(ident[who[owner] == w], owner[who[owner] == w], len(token)) for w in np.unique(who).tolist()}
    for x in range(1, len(order)):
        n = int(size[x])
        low = int(np.searchsorted(size, needed(n, percent)))
        inverted = index.get(int(who[x]) if side is None else 1 - int(who[x]))
        if low >= x or inverted is None:
            continue
        lists = ident[begin[x] : begin[x + 1]]
        length = inverted.length[lists]
        # Without sides a set stands in its own lists.
        keep = length > (side is None)
        lists, length = lists[keep], length[keep]
        t = needed(n, percent)
        if len(lists) < t:
            continue
        rising = np.argsort(length, kind="stable")
        lists = lists[rising]
        skip = min(t - 1, int(t / (MU * np.log2(length[rising[-1]] + 1) + 1)))
        short, long = lists[: len(lists) - skip], lists[len(lists) - skip :]
        ends = zip(inverted.head[short].tolist(), inverted.head[short + 1].tolist(), strict=True)
        spans = [(bisect_left(inverted.entries, low, a, b), bisect_left(inverted.entries, x, a, b)) for a, b in ends]
        found, counts = (np.array(c, np.int64) for c in merge_skip(inverted.entries, spans, t - skip))
        if not len(found):
            continue
        for a, b in zip(inverted.head[long].tolist(), inverted.head[long + 1].tolist(), strict=True):
            members = inverted.posts[a:b]
            counts += members[np.minimum(np.searchsorted(members, found), b - a - 1)] == found
        linked = found[100 * counts >= percent * (n + size[found] - counts)]
        if len(linked):
            yield int(order[x]), order[linked]


def _links(percent: int):
    """A pair of blocks -> per document with links: its root in the spanning forest, link count."""

    def run(t: pa.Table) -> pa.Table:
        ids, d1, weight = (t.column(c).to_numpy() for c in ("doc_id", "d1", "weight"))
        sets = [np.frombuffer(b, np.uint64) for b in t.column("shingles").to_pylist()]
        low, high, own = (t.column(c).to_numpy() for c in ("low", "high", "block"))
        side = None if low[0] == high[0] else (own == low).astype(np.int8)
        parent, links = list(range(len(ids))), np.zeros(len(ids), np.int64)

        def root(v: int) -> int:
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v

        for x, linked in divide_skip(sets, percent, side):
            links[x] += weight[linked].sum()
            links[linked] += weight[x]
            for y in linked.tolist():
                a, b = root(x), root(y)
                if a != b:
                    a, b = (a, b) if ids[a] < ids[b] else (b, a)
                    parent[b] = a
        keep = np.flatnonzero(links)
        return pa.table(
            {
                "doc_id": ids[keep],
                "d1": d1[keep],
                "links": links[keep],
                "root": ids[[root(v) for v in keep]] if len(keep) else ids[:0],
            }
        )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), k))
            d1 = [_digest(s)[0] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(d1, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["doc_id", "d1", "shingles"],
            )

    return run


def _dealt(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The tasks: pairs (low, high) of blocks, each with the classes of both: block, doc_id, d1, weight (copies)."""
    centres = (
        lists.groupBy("shingle")
        .agg(F.min("node").alias("centre"), F.max("node").alias("last"), (-F.count("*")).alias("shortness"))
        .where("centre <> last")
        .select("shingle", "shortness", "centre")
    )
    ties = written(lists.join(centres, "shingle"), "ties")
    # By the longest list: the classes of a hot list are then in few homes, which all have to meet one another.
    homes = written(ties.groupBy("node").agg(F.min(F.struct("shortness", "centre"))["centre"].alias("home")), "homes")
    at_home = classes.join(homes, F.col("d1") == F.col("node"))
    needs = F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)
    large = at_home.groupBy("home").agg((needs > 1).alias("large"))
    band = (
        F.when(F.col("large"), F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)))
        .otherwise(-1)
        .cast("int")
    )
    banded = at_home.join(large, "home").withColumn("band", band)
    blocks = banded.groupBy("home", "band").agg(F.ceil(needs).alias("blocks"))
    block = F.xxhash64("home", "band", F.pmod(F.xxhash64("rep", F.lit(7)), "blocks"))
    members = written(
        banded.join(blocks, ["home", "band"])
        .select(
            "home", "band", block.alias("block"), F.col("rep").alias("doc_id"), "d1", F.col("copies").alias("weight")
        ),
        "members",
    )

    blocks = written(members.groupBy("home", "band", "block").agg(F.count("*").alias("m")), "blocks")
    # The sizes of partners are in the same band or in one beside it; band -1 is a small home as a whole.
    near = (F.col("l_band") < 0) | (F.col("r_band") < 0) | (F.abs(F.col("l_band") - F.col("r_band")) <= 1)
    named = lambda df, side: df.select(*(F.col(c).alias(c if c == "shingle" else f"{side}_{c}") for c in df.columns))
    left, right = named(blocks, "l"), named(blocks, "r")
    inside = left.join(right, F.col("l_home") == F.col("r_home")).where(
        near & ((F.col("l_block") < F.col("r_block")) | (F.col("l_block") == F.col("r_block")) & (F.col("l_m") > 1))
    )
    # Blocks of two homes meet where they have a list in common, with those of their classes that stand in one; only
    # blocks with a list longer than a block in common meet as a whole, so that no such list meets itself class by class.
    held = ties.join(members.withColumn("node", F.col("d1")), "node").select(
        "shingle", (F.col("shortness") < -BLOCK_DOCS).alias("long"), "home", "band", "block", "d1"
    )
    several = (
        held.groupBy("shingle")
        .agg(F.min("home").alias("a"), F.max("home").alias("b"))
        .where("a <> b")
        .select("shingle")
    )
    held = written(held.join(several, "shingle"), "held")
    spread = written(held.select("shingle", "long", "home", "band", "block").distinct(), "spread")
    short, long = held.where(~F.col("long")), spread.where("long")
    meets = lambda some, others: named(some, "l").join(named(others, "r"), "shingle").where((F.col("l_home") != F.col("r_home")) & near)
    low, high = F.least("l_block", "r_block").alias("low"), F.greatest("l_block", "r_block").alias("high")
    some = meets(short, spread).select(low, high, F.col("l_block").alias("block"), F.col("l_d1").alias("d1"))
    whole = meets(long, long).select(low, high, F.col("l_block").alias("block"))
    ends = F.array_distinct(F.array(*(F.struct(low, high, F.col(b).alias("block")) for b in ("l_block", "r_block"))))
    whole = whole.distinct().union(inside.select(F.explode(ends).alias("e")).select("e.*"))
    member = members.select("block", "doc_id", "d1", "weight")
    all_of = whole.join(member, "block")
    some_of = some.distinct().join(whole, ["low", "high", "block"], "left_anti").join(member, ["block", "d1"])
    return all_of.unionByName(some_of)


def jaccard_components(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable by links), n_links (rows it links with,
    copies included).

    `documents` needs doc_id and text; other columns, whatever their names, are ignored. Words are runs of anything but
    ASCII white space, A-Z lower-cased. A null or blank text has an empty set and links with nothing; neither does a row
    without doc_id, whose component is null. Rows that share a doc_id are in one component. Exact copies of a set are
    folded before anything is compared; a text of any length is one set. An empty table gives an empty result.
    """
    docs = documents.select(F.col("doc_id").cast("bigint"), F.col("text"))
    named = docs.where("doc_id is not null")
    rows = written(docs.mapInArrow(_rows(k), "doc_id bigint, n bigint, entries bigint, d1 bigint, d2 bigint"), "rows")
    known = rows.where("n > 0 and doc_id is not null")
    classes = written(
        known.groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("entries").alias("entries"),
        ),
        "classes",
    )

    postings = (
        named.select("text")
        .mapInArrow(_postings(k), "shingle bigint, node bigint")
        .repartition("shingle")
        .sortWithinPartitions("shingle")
    )
    room = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1 - F.col("entries")
    ranked = postings.mapInArrow(
        _index, "node bigint, rank int, shingle bigint"
    ).union(classes.select("d1", F.lit(-1), room))
    by_class = ranked.repartition("node").sortWithinPartitions("node", "rank", "shingle")
    lists = written(by_class.mapInArrow(_short_lists(), "shingle bigint, node bigint"), "short-lists")
    dealt = written(_dealt(lists, classes, percent), "dealt")

    ids = maybe_broadcast(written(dealt.select("doc_id").distinct(), "member-ids"))
    sets = (
        named.join(ids, "doc_id", "left_semi")
        .mapInArrow(_sets(k), "doc_id bigint, d1 bigint, shingles binary")
        .dropDuplicates(["doc_id", "d1"])
    )
    linked = written(
        dealt.join(sets, ["doc_id", "d1"])
        .groupBy("low", "high")
        .applyInArrow(_links(percent), "doc_id bigint, d1 bigint, links bigint, root bigint"),
        "links",
    )
    # An id with several sets ties their classes together.
    several = (
        known.groupBy("doc_id").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a <> b").select("doc_id")
    )
    same_id = (
        known.join(several, "doc_id").join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep")
    )
    found = connected_components(linked.select(F.col("doc_id").alias("src"), F.col("root").alias("dst")).union(same_id))
    counts = linked.groupBy(F.col("doc_id").alias("rep"), "d1").agg(F.sum("links").alias("links"))
    final = (
        classes.join(counts, ["rep", "d1"], "left")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select(
            "d1",
            "d2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("class"),
        )
    )
    is_named = F.col("doc_id").isNotNull()
    return rows.join(final, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(is_named, F.coalesce("class", "doc_id")).alias("component_id"),
        F.when(is_named, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
    )


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Four-word shingles, links at a Jaccard similarity of 0.85."""
    return jaccard_components(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=85
    ).select("doc_id", "n_shingles", "component_id", "n_links")


SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
pairs AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c FROM pairs a JOIN pairs b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT x, y FROM shared UNION SELECT r.x, s.y FROM reach r JOIN shared s ON r.y = s.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, (SELECT min(y) FROM reach WHERE x = doc_id)) AS component_id,
  coalesce((SELECT count(*) FROM shared WHERE x = doc_id), 0)::BIGINT AS n_links FROM sets
"""

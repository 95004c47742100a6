"""Hard-negative mining (operator 12): a multiway hyperplane tree (GNAT) with exact leaves.

Vectors are lifted onto a sphere (one more component, so that all have the largest norm; none for the anchors), where
the distance from an anchor falls as its inner product rises: a window of scores is an annulus around the anchor. The
root's split points come from a bounded sample; every row goes to its nearest one, and the rows of a cell are packed
into blocks, each with a tree of its own below. A node stores, for each of its split points, the range of distances to
each sibling's subtree; a subtree whose range doesn't meet the window's annulus, seen from any split point, is left out
(at the root for a whole batch of anchors, below for each window), and what is left is compared exactly in the leaves.

Anchors go in batches. A batch meets the blocks of one run after another in one task, keeps the best rows so far, and
narrows its annuli by them; the best of all runs are merged by a ranked window. Positives are searched first (same
label, no upper bound), and their scores give the windows of the negatives.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.scratch import maybe_broadcast, parts, written
from loomspark.llm.textarrays import give_back

#: Positives of an anchor, negatives of a positive, and the window in hundredths of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Rows of the sample that the root is fitted on, and its split points.
SAMPLE, ROOT = 4096, 32
#: Rows and components of a block, anchors of a batch, rows of a run of blocks.
BLOCK, CELLS, BATCH, RUN = 16_384, 1 << 21, 2048, 65_536
#: Rows of a leaf, split points of a node below the root, rows among which these are chosen.
LEAF, FAN, CHOICE = 256, 8, 512


class Space:
    """Lifted distances. `m2` is the largest squared norm; `exact` the number type that holds every score."""

    def __init__(self, m2: float):
        self.m2 = m2
        self.slack = 1e-6 * np.sqrt(2 * m2 + 1)
        self.exact = np.float64 if m2 < 1 << 52 else np.longdouble

    def between(self, x: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Distances of rows x to rows p."""
        nx, np_ = (x * x).sum(1), (p * p).sum(1)
        hx, hp = (np.sqrt(np.maximum(self.m2 - n, 0)) for n in (nx, np_))
        return np.sqrt(np.maximum(nx[:, None] + np_[None] - 2 * _dot(x, p) + (hx[:, None] - hp[None]) ** 2, 0))

    def from_scores(self, norms: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distances from anchors of these squared norms to rows of these scores; infinite scores give 0 and infinity."""
        return np.sqrt(np.maximum(norms + self.m2 - 2 * scores.astype(np.float64), 0))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = min(a.shape[1], b.shape[1])
    return a[:, :d] @ b[:, :d].T


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of equal length; what a shorter vector lacks is 0."""
    wide = max(map(len, vectors), default=0)
    if all(len(v) == wide for v in vectors):
        return np.array(vectors, np.float64).reshape(len(vectors), wide)
    out = np.zeros((len(vectors), wide))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def far_points(space: Space, x: np.ndarray, n: int) -> np.ndarray:
    """Numbers of up to n rows, each as far as can be from those before it."""
    chosen = [0]
    away = space.between(x, x[:1])[:, 0]
    while len(chosen) < min(n, len(x)) and away.max() > space.slack:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, space.between(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def ranges(away: np.ndarray, cell: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) distance from each point i to the rows of each cell j; an empty cell has an empty range."""
    low, high = np.full((away.shape[1], n), np.inf), np.full((away.shape[1], n), -np.inf)
    for j in np.unique(cell):
        own = away[cell == j]
        low[:, j], high[:, j] = own.min(0), own.max(0)
    return low, high


def grow(space: Space, x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """(order of the rows, tree): a leaf is (first, last + 1) in that order, a node (points, low, high, children)."""
    order: list[np.ndarray] = []
    placed = 0

    def node(rows: np.ndarray) -> tuple:
        nonlocal placed
        if len(rows) > LEAF:
            points = x[rows[far_points(space, x[rows[:: max(1, len(rows) // CHOICE)]], FAN) * max(1, len(rows) // CHOICE)]]
            away = space.between(x[rows], points)
            cell = away.argmin(1)
            if len(points) > 1 and np.bincount(cell).max() < len(rows):
                low, high = ranges(away, cell, len(points))
                return points, low, high, [node(rows[cell == j]) if (cell == j).any() else None for j in range(len(points))]
        order.append(rows)
        placed += len(rows)
        return placed - len(rows), placed

    tree = node(np.arange(len(x)))
    return np.concatenate(order), tree


def alive(space: Space, away: np.ndarray, inner: np.ndarray, outer: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which windows (rows) may have rows in which subtrees (columns): every point's range meets the annulus."""
    near = np.maximum(away - outer[:, None], inner[:, None] - away) - space.slack
    far = away + outer[:, None] + space.slack
    return ((near[:, :, None] <= high[None]) & (far[:, :, None] >= low[None])).all(1)


class Batch:
    """Windows of a batch of anchors: the search goes down a block's tree for all that are alive."""

    def __init__(self, space: Space, anchors: dict, k: int):
        self.space, self.k = space, k
        self.x = np.frombuffer(anchors["vectors"], np.float64).reshape(anchors["n"], -1)
        self.norms = (self.x * self.x).sum(1)
        read = lambda name, kind: np.frombuffer(anchors[name], kind)
        self.labels, self.block, self.at = read("labels", "<i8"), read("blocks", "<i8"), read("places", "<i8")
        self.same = anchors.get("windows") is None
        if self.same:
            self.owner = np.arange(anchors["n"])
            self.low, self.high = (np.full(anchors["n"], v, space.exact) for v in (-np.inf, np.inf))
            self.of = []
        else:
            self.of = sorted((w["anchor"], w["place"], w["id"], w["score"]) for w in anchors["windows"])
            self.owner = np.array([w[0] for w in self.of], np.int64)
            self.low = np.array([-(-LOW * w[3] // 100) for w in self.of], space.exact)
            self.high = np.array([HIGH * w[3] // 100 for w in self.of], space.exact)
        self.least = self.low.copy()
        self.found: list[tuple] = []
        self.held = 0

    def _fits(self, windows: np.ndarray, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Scores of rows for windows; -inf where label or score don't fit."""
        own, where = np.unique(self.owner[windows], return_inverse=True)
        scores = _dot(self.x[own].astype(self.space.exact), x.astype(self.space.exact))
        fits = (self.labels[own][:, None] == labels[None]) == self.same
        v = np.where(fits, scores, -np.inf)[where]
        v[(v > self.high[windows][:, None]) | (v < self.least[windows][:, None])] = -np.inf
        return v

    def seed(self, x: np.ndarray, labels: np.ndarray) -> None:
        """A floor for the worst of the best rows, from a few rows of the table (which may hold an anchor itself)."""
        k = self.k + self.same
        if len(x) >= k:
            for windows in np.array_split(np.arange(len(self.low)), -(-len(self.low) // 1024) or 1):
                if len(windows):
                    v = self._fits(windows, x, labels)
                    self.least[windows] = np.maximum(self.least[windows], np.partition(v, -k, axis=1)[:, -k])

    def annuli(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        norms = self.norms[self.owner[windows]]
        return self.space.from_scores(norms, self.high[windows]), self.space.from_scores(norms, self.least[windows])

    def search(self, tree: tuple, block: int, x: np.ndarray, labels: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        self._visit(tree, np.flatnonzero(self.low <= self.high), block, x, labels, ids, null)

    def _visit(self, node, windows, block, *rows) -> None:
        if node is None or not len(windows):
            return
        if len(node) == 2:
            self._leaf(node, windows, block, *rows)
            return
        points, low, high, children = node
        own, where = np.unique(self.owner[windows], return_inverse=True)
        away = self.space.from_scores(self.norms[own][:, None], _dot(self.x[own], points))
        for j in np.argsort(away.mean(0)):
            meets = alive(self.space, away[where], *self.annuli(windows), low[:, j : j + 1], high[:, j : j + 1])[:, 0]
            self._visit(children[j], windows[meets], block, *rows)

    def _leaf(self, node, windows, block, x, labels, ids, null) -> None:
        a, b = node
        for part in np.array_split(windows, -(-len(windows) * (b - a) // CELLS)):
            v = self._fits(part, x[a:b], labels[a:b])
            if self.same:
                here = np.flatnonzero((self.block[self.owner[part]] == block) & (self.at[self.owner[part]] >= a) & (self.at[self.owner[part]] < b))
                v[here, self.at[self.owner[part[here]]] - a] = -np.inf
            if b - a > self.k:
                kth = np.partition(v, -self.k, axis=1)[:, -self.k]
                self.least[part] = np.maximum(self.least[part], kth)
                v[v < self.least[part][:, None]] = -np.inf
            i, j = np.nonzero(v > -np.inf)
            self.found.append((part[i], v[i, j], ids[a:b][j], null[a:b][j]))
            self.held += len(i)
        if self.held > 4 * self.k * len(self.low) + CELLS:
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(window, score, id, null id) of the best k rows of each window; the floors rise with them."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, self.space.exact), np.zeros(0, np.int64), np.zeros(0, bool)
        window, score, ids, null = (np.concatenate(x) for x in zip(*self.found, strict=True))
        order = np.lexsort((ids, null, -score, window))
        rank = np.arange(len(order)) - np.searchsorted(window[order], window[order])
        last = order[rank == self.k - 1]
        self.least[window[last]] = np.maximum(self.least[window[last]], score[last])
        kept = order[rank < self.k]
        self.found = [(window[kept], score[kept], ids[kept], null[kept])]
        self.held = len(kept)
        return self.found[0]


ASSIGNED = "cell int, vec_id bigint, label bigint, vector binary"


def _assign(space: Space, points: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                vectors = [np.floor(256 * np.array(v, np.float64)) for v in part.column(2).to_pylist()]
                cell = space.between(_matrix(vectors), points).argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), part.column(0), part.column(1), pa.array([v.tobytes() for v in vectors], pa.binary())],
                    ["cell", "vec_id", "label", "vector"],
                )

    return run


BLOCKS = (
    "block bigint, cell int, n int, vectors binary, kind string, labels binary, ids binary, nulls binary, tree binary,"
    " low binary, high binary"
)


def _blocks(space: Space, points: np.ndarray):
    """Blocks of the rows of one cell each, from rows that come sorted by cell."""

    def block(number: int, cell: int, rows: list[tuple]) -> pa.RecordBatch:
        x = _matrix([np.frombuffer(r[2], np.float64) for r in rows])
        away = space.between(x, points)
        order, tree = grow(space, x)
        x = x[order]
        kind = next((k for k in ("<i2", "<i4") if np.abs(x).max(initial=0) < np.iinfo(k).max), "<f8")
        ids = np.array([np.iinfo(np.int64).max if r[0] is None else r[0] for r in rows], "<i8")[order]
        row = {
            "block": number, "cell": cell, "n": len(rows), "vectors": x.astype(kind).tobytes(), "kind": kind,
            "labels": np.array([r[1] for r in rows], "<i8")[order].tobytes(), "ids": ids.tobytes(),
            "nulls": np.array([r[0] is None for r in rows])[order].tobytes(), "tree": pickle.dumps(tree),
            "low": away.min(0).tobytes(), "high": away.max(0).tobytes(),
        }
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(a, kinds[b]) for a, b in (c.split() for c in BLOCKS.split(","))])
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now, rows, wide = TaskContext.get().partitionId() << 33, None, [], 0
        for batch in batches:
            for cell, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = max(wide, len(row[2]) // 8)
                if rows and (cell != now or len(rows) == BLOCK or (len(rows) + 1) * wide > CELLS):
                    yield block(number, now, rows)
                    number, rows, wide = number + 1, [], len(row[2]) // 8
                now = cell
                rows.append(tuple(row))
        if rows:
            yield block(number, now, rows)
        give_back()

    return run


def _rows_of(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(block["vectors"], block["kind"]).reshape(block["n"], -1).astype(np.float64)
    return x, *(np.frombuffer(block[k], t) for k, t in (("labels", "<i8"), ("ids", "<i8"), ("nulls", "?")))


ANCHORS = "batch bigint, n int, vectors binary, ids binary, labels binary, blocks binary, places binary"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of the rows whose id is divisible by 100, with their places in the blocks."""
    number, held = TaskContext.get().partitionId() << 33, []

    def row() -> pa.RecordBatch:
        x = _matrix([h[0] for h in held])
        packed = [pa.array([np.array([h[i] for h in held], "<i8").tobytes()], pa.binary()) for i in range(1, 5)]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(held)], pa.int32()), pa.array([x.tobytes()], pa.binary()), *packed],
            [c.split()[0] for c in ANCHORS.split(", ")],
        )

    for batch in batches:
        for block in batch.to_pylist():
            x, labels, ids, null = _rows_of(block)
            for i in np.flatnonzero((ids % 100 == 0) & ~null):
                held.append((x[i], ids[i], labels[i], block["block"], i))
                if len(held) == BATCH:
                    yield row()
                    number, held = number + 1, []
    if held:
        yield row()


def _cell_ranges(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell] * n, pa.int32()), pa.array(np.arange(n), pa.int32()), pa.array(np.frombuffer(low)), pa.array(np.frombuffer(high))],
                    ["cell", "point", "low", "high"],
                )

    return run


class Root:
    """What every worker knows: the space, the sample with its labels, the split points and the ranges of the cells."""

    def __init__(self, space: Space, sample: np.ndarray, labels: np.ndarray, points: np.ndarray):
        self.space, self.sample, self.labels, self.points = space, sample, labels, points
        self.low, self.high = np.full((len(points),) * 2, np.inf), np.full((len(points),) * 2, -np.inf)

    def batch(self, anchors: dict, k: int) -> Batch:
        found = Batch(self.space, anchors, k)
        found.seed(self.sample, self.labels)
        return found


def _routes(root: Root, k: int):
    """The cells that a batch has to look into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchors in batch.to_pylist():
                b = root.batch(anchors, k)
                away = root.space.from_scores(b.norms[:, None], _dot(b.x, root.points))
                cells = np.zeros(len(root.points), bool)
                for windows in np.array_split(np.flatnonzero(b.low <= b.high), -(-len(b.low) // 512) or 1):
                    cells |= alive(root.space, away[b.owner[windows]], *b.annuli(windows), root.low, root.high).any(0)
                own = np.flatnonzero(cells)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchors["batch"]] * len(own), pa.int64()), pa.array(own, pa.int32())], ["batch", "cell"]
                )

    return run


FOUND = "batch bigint, anchor int, place int, anchor_id bigint, positive_id bigint, positive_score bigint, id bigint, score bigint"


def _search(root: Root, k: int):
    """The best rows of each window in a run of blocks; the batch's own row comes before its blocks."""

    def rows(anchors: dict, b: Batch) -> pa.RecordBatch:
        window, score, ids, null = b.best()
        owner = b.owner[window]
        edge = np.iinfo(np.int64)
        score = np.clip(score, edge.min, root.space.exact(edge.max) if root.space.exact is np.longdouble else 2.0**62).astype(np.int64)
        of = lambda i: [b.of[w][i] for w in window] if b.of else [None] * len(window)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([anchors["batch"]] * len(window), pa.int64()), pa.array(owner, pa.int32()), pa.array(of(1), pa.int32()),
                pa.array(np.frombuffer(anchors["ids"], "<i8")[owner]), pa.array(of(2), pa.int64()), pa.array(of(3), pa.int64()),
                pa.array(ids, mask=null), pa.array(score),
            ],
            [c.split()[0] for c in FOUND.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, b = None, None
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] is None:
                    if b is not None:
                        yield rows(anchors, b)
                    anchors, b = row, root.batch(row, k)
                    continue
                x, labels, ids, null = _rows_of(row | {"n": row["block_n"], "vectors": row["block_vectors"], "labels": row["block_labels"], "ids": row["block_ids"]})
                b.search(pickle.loads(row["tree"]), row["block"], x, labels, ids, null)
        if b is not None:
            yield rows(anchors, b)
        give_back()

    return run


def _best_rows(root: Root, anchors: DataFrame, blocks: DataFrame, runs: int, k: int, *by: str) -> DataFrame:
    """FOUND with its rank, for the best k rows of each group of `by`."""
    n = parts(anchors.sparkSession)
    routes = maybe_broadcast(written(anchors.mapInArrow(_routes(root, k), "batch bigint, cell int"), "routes"))
    run = F.pmod(F.xxhash64("block"), F.lit(runs)).cast("int").alias("run")
    renamed = [F.col(c).alias(f"block_{c}") for c in ("n", "vectors", "labels", "ids")]
    met = blocks.join(routes, "cell").select("batch", run, "block", "kind", "nulls", "tree", *renamed)
    dealt = (
        anchors.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
        .unionByName(met, allowMissingColumns=True)
        .repartition(n, "batch", "run")
        .sortWithinPartitions(F.col("batch"), F.col("run"), F.col("block").asc_nulls_first())
    )
    order = Window.partitionBy("batch", *by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return dealt.mapInArrow(_search(root, k), FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, with labels as they are after relabelling."""
    def fits(x: Column) -> Column:
        return x.isNotNull() & (F.abs(256 * x) < float("inf"))

    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    vector = F.col("embedding").cast("array<double>")
    return embeddings.where(label.isNotNull() & F.coalesce(F.forall(vector, fits), F.lit(False))).select(
        vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), vector.alias("embedding")
    )


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """RESULT for every anchor of `embeddings` (vec_id, embedding, label; other columns are ignored).

    Rows with a null label or vector, or a component that is null or not finite (or not so after scaling), take no
    part. A row without vec_id is no anchor but may be a positive or a negative; among equal scores it comes last.
    Vectors of different lengths are compared over the shorter one's. Rows that repeat an id, a vector or both are rows
    of their own: an anchor's copy may be its positive. Scores are exact up to the range of a long, and end there. An
    anchor without positives, a positive without negatives and an empty table give no rows.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.floor(256 * x).cast("double") * F.floor(256 * x).cast("double"))
    whole = rows.agg(F.count("*"), F.max(square)).first()
    if not whole[0]:
        return spark.createDataFrame([], RESULT)
    space = Space(float(whole[1]))
    sample = rows.orderBy(F.xxhash64("vec_id", "label", "embedding")).limit(SAMPLE).collect()
    known = _matrix([np.floor(256 * np.array(r.embedding, np.float64)) for r in sample])
    points = known[far_points(space, known, ROOT)]
    root = Root(space, known, np.array([r.label for r in sample], np.int64), points)
    dealt = rows.mapInArrow(_assign(space, points), ASSIGNED).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    blocks = written(
        dealt.repartitionByRange(max(1, -(-whole[0] // BLOCK)), "cell", "salt").sortWithinPartitions("cell").drop("salt")
        .mapInArrow(_blocks(space, points), BLOCKS),
        "blocks",
    )
    for r in (
        blocks.select("cell", "low", "high").mapInArrow(_cell_ranges(len(points)), "cell int, point int, low double, high double")
        .groupBy("cell", "point").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ):
        root.low[r.point, r.cell], root.high[r.point, r.cell] = r.low, r.high
    blocks = blocks.drop("low", "high")
    anchors = written(blocks.mapInArrow(_anchors, ANCHORS), "anchors")
    runs = max(-(-whole[0] // RUN), min(parts(spark), -(-whole[0] // 8192)))
    positives = _best_rows(root, anchors, blocks, runs, POSITIVES, "anchor")
    windows = positives.groupBy("batch").agg(
        F.collect_list(F.struct("anchor", F.col("rank").alias("place"), "id", "score")).alias("windows")
    )
    with_windows = written(anchors.join(windows, "batch"), "windows")
    return _best_rows(root, with_windows, blocks, runs, NEGATIVES, "anchor", "place").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


SQL = """
with usable as (
    select row_number() over () as row, vec_id, [floor(256 * x::double) for x in embedding] as v,
        case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label
    from embeddings
    where label is not null and embedding is not null and not list_contains([x is null or not isfinite(x) for x in embedding], true)
), scored as (
    select a.row as anchor_row, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
    from usable a join usable b on a.vec_id % 100 = 0 and a.row <> b.row
), positives as (
    select anchor_row, anchor_id, vec_id as positive_id, score as positive_score,
        row_number() over (partition by anchor_row order by score desc, vec_id nulls last) as place
    from scored where same qualify place <= 5
), negatives as (
    select p.anchor_row, p.place, p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
        row_number() over (partition by p.anchor_row, p.place order by s.score desc, s.vec_id nulls last)::int as rank
    from positives p join scored s on s.anchor_row = p.anchor_row and not s.same
        and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
    qualify rank <= 10
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives
"""


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """All rows, by the windows of the module."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

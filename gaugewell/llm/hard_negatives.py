"""Hard negatives by a multiway hyperplane tree with sibling ranges.

A tree is fitted on a bounded sample: at each split point a row goes to the nearest of
``FANOUT`` pivots.  All rows are indexed, and each split point stores, for every two of its
subtrees, the range of distances from the one's pivot to the other's rows.  Inner products
become distances by one more coordinate that gives all rows the same length: the squared
distance from an anchor to a row is a constant less twice their product, so a window of
scores is an annulus around the anchor.

A search first reads the anchor's own leaf, which narrows its windows to what could still
be among the first k.  It then reads the other leaves whose ranges meet an annulus: a
subtree is left out when the distance to some sibling's pivot and its range say that no row
of it can lie there.  Leaves hold the rows' integers, so what is read is exact.

Leaves are tables dealt to blocks, so a crowded leaf is many tasks; a task multiplies one
block with the anchors that reach its leaf, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugewell.llm.common import dropped, stored, text_bytes

FANOUT = 8
#: Levels of split points at most: 512 leaves.
DEPTH = 3
#: Rows that the tree is fitted on at most.
SAMPLE = 4096
#: Rows of a leaf's block.
BLOCK = 4096
#: Rows that a leaf should hold.
LEAF = 2048
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LONG = (1 << 63) - 1


@dataclass
class Tree:
    """Split points by path; a path is the tuple of branches taken.  Bounded by FANOUT and DEPTH."""

    depth: int
    length2: float
    pivots: dict[tuple, np.ndarray] = field(default_factory=dict)
    #: (branches, branches) least and largest distance from pivot i to the rows of branch j; an empty range where none took it.
    least: dict[tuple, np.ndarray] = field(default_factory=dict)
    most: dict[tuple, np.ndarray] = field(default_factory=dict)

    def _spare(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length2 - np.einsum("ij,ij->i", x, x), 0))

    @np.errstate(over="ignore", invalid="ignore")  # what cannot be told is not left out
    def distances(self, path: tuple, x: np.ndarray, query: bool) -> np.ndarray:
        """(rows, branches) distances to the pivots; rows are of the index, or queries, whose added coordinate is 0."""
        p = self.pivots[path]
        squares = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", p, p) - 2 * (x @ p.T)
        own = np.zeros(len(x)) if query else self._spare(x)
        return np.sqrt(np.maximum(squares + (own[:, None] - self._spare(p)) ** 2, 0))

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Number of each row's leaf: its branches as digits."""
        out = np.zeros(len(x), np.int64)

        def descend(path: tuple, rows: np.ndarray, code: int) -> None:
            if path not in self.pivots or not len(rows):
                out[rows] = code * FANOUT ** (self.depth - len(path))
                return
            branch = self.distances(path, x[rows], False).argmin(axis=1)
            for j in range(len(self.pivots[path])):
                descend((*path, j), rows[branch == j], code * FANOUT + j)

        descend((), np.arange(len(x)), 0)
        return out

    def path(self, leaf: int) -> tuple:
        """The split points' branches on the way to a leaf."""
        digits = tuple(leaf // FANOUT**i % FANOUT for i in reversed(range(self.depth)))
        return next((digits[:i] for i in range(self.depth) if digits[:i] not in self.pivots), digits)

    def reached(self, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of x): the leaves that may hold rows in the annuli [near, far] (rows, windows) around x."""
        slack = 1e-6 * (np.sqrt(self.length2) + np.sqrt(np.einsum("ij,ij->i", x, x)))

        def descend(path: tuple, rows: np.ndarray, code: int) -> Iterator[tuple[int, np.ndarray]]:
            if not len(rows):
                return
            if path not in self.pivots:
                yield code * FANOUT ** (self.depth - len(path)), rows
                return
            d = self.distances(path, x[rows], True)
            lo, hi, s = near[rows][:, :, None], far[rows][:, :, None], slack[rows][:, None, None]
            for j in range(d.shape[1]):
                least, most = self.least[path][:, j], self.most[path][:, j]
                if (least == np.inf).all():
                    continue  # no row took this branch
                # for all pivots i: distances to rows of branch j lie in [gap, d + most]
                gap = np.maximum(np.maximum(least - d, d - most), 0)[:, None, :]
                out = (gap > hi + s) | ((d + most)[:, None, :] < lo - s)
                yield from descend((*path, j), rows[~out.any(axis=2).all(axis=1)], code * FANOUT + j)

        yield from descend((), np.arange(len(x)), 0)


def fit(sample: np.ndarray, rows: int, length2: float, seed: int = 7) -> Tree:
    """A tree whose leaves hold about ``LEAF`` of ``rows`` rows, split as the sample is; pivots lie far apart."""
    depth = 1
    while depth < DEPTH and rows > LEAF * FANOUT**depth:
        depth += 1
    tree, rng = Tree(depth, length2), np.random.default_rng(seed)

    def split(path: tuple, x: np.ndarray) -> None:
        if len(path) == depth or len(x) < 2:
            return
        some = x[rng.choice(len(x), min(len(x), 16 * FANOUT), replace=False)]
        chosen = [0]
        tree.pivots[path] = some[chosen]
        while len(chosen) < FANOUT:
            away = tree.distances(path, some, False).min(axis=1)
            if not away.max() > 0:
                break
            chosen.append(int(away.argmax()))
            tree.pivots[path] = some[chosen]
        branch = tree.distances(path, x, False).argmin(axis=1)
        for j in range(len(chosen)):
            split((*path, j), x[branch == j])

    split((), sample)
    return tree


def _matrix(column: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(column)
    return np.frombuffer(data.tobytes(), np.float64).reshape(len(offsets) - 1, -1)


def integers(vectors: DataFrame, dim: int, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vector (doubles as bytes, whole numbers), norm2: floor(scale * x), zeros up to ``dim``; rows that take part."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                lists = part.column("embedding")
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                row = np.repeat(np.arange(len(sizes)), sizes)
                x = np.zeros((len(sizes), dim))
                x[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(flat * scale)
                with np.errstate(over="ignore"):
                    norm2 = np.einsum("ij,ij->i", x, x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(norm2)],
                    ["vec_id", "label", "vector", "norm2"],
                )

    limit = float(1 << 1000)  # scaled, the components are doubles still
    sound = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < limit))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    return rows.mapInArrow(run, f"vec_id {kind}, label long, vector binary, norm2 double")


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles while they hold them, else Python's integers, at most 64 bits."""
    most = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    if most < 2**53:
        return q @ x.T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(q) @ whole(x).T, -LONG, LONG)


class Index:
    """Rows at the leaves of a tree: row, vec_id, label, vector, leaf, block; ``blocks`` of each leaf."""

    def __init__(self, rows: DataFrame):
        """``rows`` of :func:`integers`, stored."""
        n, top = rows.agg(F.count("*"), F.max("norm2")).first()
        order = F.xxhash64("vec_id", "label", "vector")
        sample = rows.orderBy(order).limit(SAMPLE).select("vector").collect()
        x = np.array([np.frombuffer(r.vector) for r in sample]) if sample else np.zeros((0, 1))
        tree = fit(x, n, top or 0.0)
        kind = rows.schema["vec_id"].dataType.simpleString()

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    leaf = pa.array(tree.leaves(_matrix(batch.column("vector"))))
                    yield batch.append_column("leaf", leaf)

        numbered = rows.select("vec_id", "label", "vector", F.monotonically_increasing_id().alias("row"))
        placed = stored(numbered.mapInArrow(place, f"vec_id {kind}, label long, vector binary, row long, leaf long"), "leaves")

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, leaf = _matrix(batch.column("vector")) if batch.num_rows else None, batch.column("leaf").to_numpy()
                found = []
                for code in np.unique(leaf):
                    path, own = tree.path(int(code)), x[leaf == code]
                    for level in range(len(path)):
                        d = tree.distances(path[:level], own, False)
                        name = ",".join(map(str, path[:level]))
                        found += [(name, path[level], i, float(d[:, i].min()), float(d[:, i].max())) for i in range(d.shape[1])]
                columns = list(zip(*found)) or [[]] * 5
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "branch", "pivot", "least", "most"])

        seen = placed.select("vector", "leaf").mapInArrow(ranges, "path string, branch int, pivot int, least double, most double")
        seen = seen.groupBy("path", "branch", "pivot").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        for path, pivots in tree.pivots.items():
            tree.least[path], tree.most[path] = (np.full((len(pivots), len(pivots)), end) for end in (np.inf, -np.inf))
        # at most a row for each two branches of each split point
        for r in seen.toLocalIterator():
            path = tuple(map(int, r.path.split(","))) if r.path else ()
            tree.least[path][r.pivot, r.branch], tree.most[path][r.pivot, r.branch] = r.least, r.most
        self.tree, self.rows = tree, placed
        sizes = placed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        self.sizes = stored(sizes, "leaf-sizes")

    def probes(self, queries: DataFrame) -> DataFrame:
        """The leaves other than its own that each query has to read: queries and ``leaf``."""
        tree = self.tree

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(s, BLOCK)
                    x, own = _matrix(part.column("vector")), part.column("home").to_numpy()
                    lo, hi = _windows(part)
                    base = (np.einsum("ij,ij->i", x, x) + tree.length2)[:, None]
                    # an empty window has no annulus
                    far = np.where(lo <= hi, np.sqrt(np.maximum(base - 2 * lo, 0)), -np.inf)
                    near = np.sqrt(np.maximum(base - 2 * hi, 0))
                    for leaf, rows in tree.reached(x, near, far):
                        rows = rows[own[rows] != leaf]
                        if len(rows):
                            yield part.take(pa.array(rows)).append_column("leaf", pa.array(np.full(len(rows), leaf)))

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema)
        return queries.mapInArrow(run, f"{kinds}, leaf long")

    def read(self, probes: DataFrame, k: int, same: bool) -> DataFrame:
        """query, window, row, vec_id, score: the first k rows of each block in each window of a probe.

        ``probes``: row, label, vector, windows (array of lo, hi), leaf; rows of the
        anchor's label, but for itself, or of other labels.
        """
        kind = self.rows.schema["vec_id"].dataType.simpleString()
        dealt = self.rows.join(self.sizes, "leaf").select(
            "leaf", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"), F.lit(0).alias("side"),
            "row", "vec_id", "label", "vector", F.lit(None).cast("array<struct<lo:double,hi:double>>").alias("windows"),
        )
        wanted = probes.join(self.sizes, "leaf").select(
            "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"),
            "row", F.lit(None).cast(kind).alias("vec_id"), "label", "vector", "windows",
        )
        keys = ["leaf", "block", "side"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, held, block = None, [], None
            for batch in batches:
                columns = [batch.column(c).to_numpy() for c in keys]
                new = np.zeros(batch.num_rows, bool)
                for c in columns:
                    new[1:] |= c[1:] != c[:-1]
                cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
                for s, e in zip(cuts, cuts[1:]):
                    if e == s:
                        continue
                    this = (columns[0][s], columns[1][s])
                    if this != key:
                        key, held, block = this, [], None
                    part = batch.slice(s, e - s)
                    if columns[2][s] == 0:
                        held.append(part)
                        continue
                    if not held:
                        continue
                    block = block or _Block(held)
                    for at in range(0, part.num_rows, 256):
                        yield block.first(part.slice(at, 256), k, same)

        both = dealt.unionAll(wanted).repartition("leaf", "block").sortWithinPartitions(*keys)
        return both.mapInArrow(run, f"query long, window int, vec_id {kind}, score long")


def _windows(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(rows, windows) lower and upper scores; short lists are filled up with empty windows."""
    lists = part.column("windows")
    sizes = np.diff(lists.offsets.to_numpy())
    flat, wide = lists.flatten(), int(sizes.max(initial=0))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lo, hi = np.full((len(sizes), wide), np.inf), np.full((len(sizes), wide), -np.inf)
    lo[row, place] = flat.field("lo").to_numpy(zero_copy_only=False)
    hi[row, place] = flat.field("hi").to_numpy(zero_copy_only=False)
    return lo, hi


class _Block:
    """Rows of a leaf's block in the order of their ids."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).select(["row", "vec_id", "label", "vector"])
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()
        self.row, self.label = (table.column(c).to_numpy() for c in ("row", "label"))
        self.vec_id = pa.concat_arrays(table.column("vec_id").chunks)
        self.x = _matrix(pa.concat_arrays(table.column("vector").chunks))

    def first(self, part: pa.RecordBatch, k: int, same: bool) -> pa.RecordBatch:
        row, label = part.column("row").to_numpy(), part.column("label").to_numpy()
        score = _products(_matrix(part.column("vector")), self.x)
        alike = label[:, None] == self.label
        able = alike & (row[:, None] != self.row) if same else ~alike
        lo, hi = _windows(part)
        query, window, at, value = [], [], [], []
        for w in range(lo.shape[1]):
            inside = able & (score >= lo[:, w : w + 1]) & (score <= hi[:, w : w + 1])
            left = np.where(inside, score.astype(np.float64), -np.inf) if score.dtype != object else np.where(inside, score, -LONG - 1)
            none = -np.inf if score.dtype != object else -LONG - 1
            rows = np.arange(len(row))
            for _ in range(min(k, len(self.row))):
                best = left[rows].argmax(axis=1) if left.dtype != object else np.array([max(range(left.shape[1]), key=left[r].__getitem__) for r in rows], np.int64)
                good = left[rows, best] > none
                rows, best = rows[good], best[good]
                if not len(rows):
                    break
                query.append(row[rows])
                window.append(np.full(len(rows), w, np.int32))
                at.append(best)
                value.append(score[rows, best].astype(np.int64))
                left[rows, best] = none
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (query, window, at, value)]
        return pa.RecordBatch.from_arrays(
            [pa.array(flat[0]), pa.array(flat[1].astype(np.int32)), self.vec_id.take(pa.array(flat[2])), pa.array(flat[3])],
            ["query", "window", "vec_id", "score"],
        )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query and window, with their ``rank``."""
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """query, window, vec_id, score, rank: the first k rows of the whole index in each window of each query.

    ``queries``: row, label, vector, home (its leaf), windows.  Higher scores come first,
    ties by the smaller vec_id.
    """
    near = stored(index.read(queries.withColumn("leaf", F.col("home")), k, same), "near-hits")
    # the k-th score at home is a floor for the rest
    floors = _ranked(near, k).where(F.col("rank") == k).select("query", "window", F.col("score").alias("floor"))
    floors = floors.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("floors"))
    raised = queries.join(floors.withColumnRenamed("query", "row"), "row", "left").withColumn(
        "windows",
        F.transform(
            "windows",
            lambda w, i: F.struct(F.greatest(w.lo, F.col("floors")[i.cast("int")].cast("double")).alias("lo"), w.hi.alias("hi")),
        ),
    )
    probes = stored(index.probes(raised.drop("floors")), "probes")
    out = stored(_ranked(near.unionAll(index.read(probes, k, same)), k), "hits")
    for done in (near, probes):
        dropped(done)
    return out


def hard_negatives(
    vectors: DataFrame,
    anchors,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """Hard negatives of anchors: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, embedding, label; ``anchors`` a condition on vec_id.  Scores are
    inner products of floor(``scale`` * x).  An anchor's positives are its first
    ``positives`` other rows of the same label; a positive's negatives are the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` per cent of the
    positive's.  Higher scores come first, ties by the smaller vec_id.

    Rows with a NULL id, label or vector, or any NULL or non-finite component, take no part.
    Vectors shorter than the longest count as filled up with zeros.  Repeated rows are rows
    of their own: an anchor's copy is another row, and each copy of an anchor is an anchor.
    Scores beyond 64 bits become the largest or smallest of 64 bits, windows beyond 53 bits
    are of doubles.  A positive of negative
    score has no negatives, as its window is empty.  An empty table gives no rows.
    """
    dim = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = stored(integers(vectors, max(dim, 1), scale), "integer-vectors")
    index = Index(rows)
    chosen = index.rows.where(anchors).select("row", "vec_id", "label", "vector", F.col("leaf").alias("home"))
    chosen = stored(chosen, "anchors")
    everything = F.array(F.struct(F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi")))
    near = search(index, chosen.withColumn("windows", everything), positives, True)
    near = near.select("query", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    positive = F.col("positive_score").cast("decimal(20,0)")
    window = F.struct(
        F.ceil(positive * low / 100).cast("double").alias("lo"), F.floor(positive * high / 100).cast("double").alias("hi")
    )
    # in the order of their places, so a window's number is its positive's place
    sets = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", window.alias("w")))).alias("ws"))
    sets = sets.select(F.col("query").alias("row"), F.transform("ws", lambda x: x.w).alias("windows"))
    found = search(index, chosen.join(sets, "row"), negatives, False)
    out = near.join(found.withColumn("place", F.col("window") + 1), ["query", "place"])
    out = out.join(chosen.select(F.col("row").alias("query"), F.col("vec_id").alias("anchor_id")), "query")
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("positive_score").cast("long").alias("positive_score"), F.col("score").alias("negative_score"),
    )

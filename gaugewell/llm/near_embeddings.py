"""Near-duplicates of embeddings: sign hashing in several tables, exact cosine, components.

Each table cuts space by random hyperplanes; the signs are a bucket.  Vectors that share a
bucket in any table are compared by exact cosine in double precision.  The number of
planes follows the number of vectors, so buckets keep their size, and the number of tables
follows from it: a pair at the threshold shares a bucket with probability ``recall``.

Buckets are dealt to blocks; a task multiplies two blocks.  A pair that meets in several
tables counts in the first.  From each task go sums of links per vector and a spanning
forest of its links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import stored
from gaugewell.llm.components import components

THRESHOLD = 0.9
RECALL = 0.999
BUCKET = 512
BLOCK = 1024
SEED = 20240601


def plan_tables(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(planes per table, tables) for n vectors."""
    planes = max(1, math.ceil(math.log2(max(n, 2) / BUCKET))) if n > BUCKET else 1
    alike = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, max(1, math.ceil(math.log(1 - recall) / math.log(1 - alike)))


def _codes(vectors: np.ndarray, planes: int, tables: int) -> np.ndarray:
    normal = np.random.default_rng(SEED + vectors.shape[1]).standard_normal((vectors.shape[1], planes * tables))
    signs = (vectors @ normal > 0).reshape(len(vectors), tables, planes)
    return signs @ (1 << np.arange(planes, dtype=np.int64))


def hashed(vectors: DataFrame, planes: int, tables: int) -> DataFrame:
    """node, copies, dim, vector (doubles as bytes), codes; vectors that can't be compared are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dim: dict[int, list] = {}
            for node, copies, v in zip(*(batch.column(c).to_pylist() for c in ("node", "copies", "embedding"))):
                if v and None not in v:
                    by_dim.setdefault(len(v), []).append((node, copies, v))
            for dim, rows in by_dim.items():
                x = np.array([v for _, _, v in rows], np.float64)
                with np.errstate(all="ignore"):
                    scale = np.abs(x).max(axis=1)
                    unit = x / scale[:, None]
                    unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
                good = np.isfinite(x).all(axis=1) & (scale > 0) & np.isfinite(unit).all(axis=1)
                unit = unit[good]
                kept = [r for r, g in zip(rows, good) if g]
                codes = _codes(unit, planes, tables)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in kept], pa.int64()),
                        pa.array([r[1] for r in kept], pa.int64()),
                        pa.array(np.full(len(kept), dim, np.int32)),
                        pa.array([u.tobytes() for u in unit], pa.binary()),
                        pa.array(list(codes), pa.list_(pa.int64())),
                    ],
                    ["node", "copies", "dim", "vector", "codes"],
                )

    return vectors.mapInArrow(run, "node long, copies long, dim int, vector binary, codes array<long>")


def _multiply(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): sums of links of node a with b NULL, and forest links (a, b) with links NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def task(key: tuple, group: list[tuple]) -> pa.RecordBatch:
            table, low, high = key[0], key[3], key[4]
            left = [r for r in group if r[0] == low]
            right = left if low == high else [r for r in group if r[0] == high]
            a, b, links = [], [], []
            if left and right:
                u, v = (np.stack([np.frombuffer(r[3]) for r in side]) for side in (left, right))
                cosine = u @ v.T
                close = np.abs(cosine - threshold) < 1e-9
                for i, j in zip(*np.nonzero(close)):  # rounding of blocked sums decides nothing
                    cosine[i, j] = math.fsum((u[i] * v[j]).tolist())
                alike = cosine >= threshold
                if low == high:
                    np.fill_diagonal(alike, False)
                counted = alike.copy()
                cu, cv = np.array([r[4] for r in left]), np.array([r[4] for r in right])
                for t in range(table):
                    if not counted.any():
                        break
                    counted &= cu[:, t][:, None] != cv[:, t][None, :]
                nl, nr = np.array([r[2] for r in left]), np.array([r[2] for r in right])
                sums = counted @ nr
                some = np.flatnonzero(sums)
                a += [left[i][1] for i in some]
                links += sums[some].tolist()
                if low != high:
                    sums = nl @ counted
                    some = np.flatnonzero(sums)
                    a += [right[i][1] for i in some]
                    links += sums[some].tolist()
                b += [None] * len(a)
                # spanning forest: labels sink to the smallest row of each connected part
                m = len(left)
                rows_at, columns_at = np.nonzero(alike)
                if low != high:
                    columns_at = columns_at + m
                total = m if low == high else m + len(right)
                label = np.arange(total)
                while len(rows_at):
                    least = label.copy()
                    np.minimum.at(least, rows_at, label[columns_at])
                    np.minimum.at(least, columns_at, label[rows_at])
                    least = least[least]
                    if (least == label).all():
                        break
                    label = least
                names = [r[1] for r in left] + ([] if low == high else [r[1] for r in right])
                for i in np.flatnonzero(label != np.arange(total)):
                    a.append(names[i])
                    b.append(names[label[i]])
                    links.append(None)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, links)], ["a", "b", "links"])

        key, group = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("table", "dim", "code", "low", "high", "block", "node", "copies", "vector", "codes")]
            for row in zip(*columns):
                if row[:5] != key:
                    if group:
                        yield task(key, group)
                    key, group = row[:5], []
                group.append(row[5:])
        if group:
            yield task(key, group)

    keys = ["table", "dim", "code", "low", "high"]
    dealt = rows.select(*keys, "block", "node", "copies", "vector", "codes").repartition(*keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, links long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row of ``vectors`` (vec_id, embedding).

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with
    nothing; vectors of different length neither.  Equal vectors are compared once and
    counted as often as they are.  Rows of one vec_id count as vectors of their own and
    share a component.
    """
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    key = F.xxhash64("embedding").alias("key")
    classes = given.where("embedding is not null").groupBy(key, "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    classes = stored(classes, "vector-classes")
    planes, tables = plan_tables(classes.count(), threshold, recall)
    nodes = stored(hashed(classes.select("node", "copies", "embedding"), planes, tables), "vector-codes")
    spots = nodes.select("node", "dim", F.posexplode("codes").alias("table", "code"))
    spot = ["table", "dim", "code"]
    sizes = spots.groupBy(*spot).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = spots.join(sizes.drop("n"), spot).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select(*spot, "node", "block", other)
    dealt = dealt.select(*spot, "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    found = stored(_multiply(dealt.join(nodes.drop("dim"), "node"), threshold), "vector-links")
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = components(found.where("b is not null").select("a", "b"))
    info = (
        classes.join(nodes.select("node"), "node")
        .join(links, "node", "left")
        .join(linked, "node", "left")
        .select("key", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    rows = given.select("vec_id", key, "embedding").join(info, ["key", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )

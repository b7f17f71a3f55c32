"""Hard negatives against all products."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugewell.llm import hard_negatives as hn
from gaugewell.llm import queries

CLASH = "vec_id long, embedding array<double>, label int, row int, leaf string, block int, score int, window string, vector int"


def brute(rows, every=50, pos=5, neg=3):
    import math

    good = [
        (i, [math.floor(256 * x) for x in v], c)
        for i, v, c in rows
        if i is not None and v is not None and c is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for a, (i, v, c) in enumerate(good):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d == c) for b, (j, w, d) in enumerate(good) if b != a)
        for s, j, _ in [r for r in scored if r[2]][:pos]:
            inside = [r for r in scored if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s][:neg]
            for k, (t, m, _) in enumerate(inside):
                out[i, j, k + 1, m, -s, -t] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "w", 4) for r in rows], CLASH).repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((5, 8))
    rows = [(i, (centres[i % 5] + rng.standard_normal(8) * (0.1 + i % 3)).tolist(), int(rng.integers(4))) for i in range(600)]
    same = centres[0].tolist()
    rows += [(1000 + i, same, i % 2) for i in range(300)]
    rows += [(50, same, 1), (50, same, 1), rows[150], (5000, [], 1), (5050, [1.0, 2.0], 2), (5100, [0.0] * 8, 0)]
    odd = [(6000, None, 1), (6050, same, None), (None, same, 1), (6100, [None] + same[1:], 1), (6150, [float("nan")] + same[1:], 0)]
    odd += [(6200, [float("inf")] + same[1:], 1), (6250, [float("-inf")] * 8, 1)]
    return rows + odd


def test_odd_rows(spark, rows, monkeypatch):
    want = brute(rows)
    docs = frame(spark, rows)
    anchors = F.col("vec_id") % 50 == 0
    got = hn.hard_negatives(docs, anchors)
    assert got.schema.simpleString() == (
        "struct<anchor_id:bigint,positive_id:bigint,rank:int,negative_id:bigint,positive_score:bigint,negative_score:bigint>"
    )
    assert Counter(map(tuple, got.collect())) == want and len(want) > 100
    assert hn.hard_negatives(docs.limit(0), anchors).collect() == []
    # deep trees and many blocks
    monkeypatch.setattr(hn, "LEAF", 4)
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "SAMPLE", 200)
    assert Counter(map(tuple, hn.hard_negatives(docs, anchors).collect())) == want


def test_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randint(0, 7) for _ in range(4)], i % 2) for i in range(120)]
    assert Counter(map(tuple, hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0).collect())) == brute(rows)
    rows = [(i, [1e300 * (i + 1), 1.0], i % 2) for i in range(60)]
    assert hn.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0).count() >= 0


def test_tree_leaves_out_only_what_cannot_match():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (rng.standard_normal((40, 1, 6)) * 3 + rng.standard_normal((40, 50, 6)) * 0.05)).reshape(-1, 6)
    tree = hn.fit(x[::3], 10**9, float((x * x).sum(axis=1).max()))
    leaf = tree.leaves(x)
    for path, p in tree.pivots.items():
        tree.least[path], tree.most[path] = (np.full((len(p), len(p)), end) for end in (np.inf, -np.inf))
    for code in np.unique(leaf):
        path, own = tree.path(int(code)), x[leaf == code]
        for level in range(len(path)):
            d, at, j = tree.distances(path[:level], own, False), path[:level], path[level]
            tree.least[at][:, j] = np.fmin(tree.least[at][:, j], d.min(axis=0))
            tree.most[at][:, j] = np.fmax(tree.most[at][:, j], d.max(axis=0))
    q = x[::37]
    score = q @ x.T
    lo, hi = np.sort(score, axis=1)[:, -60][:, None], np.sort(score, axis=1)[:, -20][:, None]
    base = (q * q).sum(axis=1)[:, None] + tree.length2
    reached = {(int(r), code) for code, rows in tree.reached(q, np.sqrt(base - 2 * hi), np.sqrt(base - 2 * lo)) for r in rows}
    needed = {(int(i), int(leaf[j])) for i, j in zip(*np.nonzero((score >= lo) & (score <= hi)))}
    assert needed <= reached
    assert len(reached) < 0.7 * len(q) * len(np.unique(leaf))


def test_whole_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, None if c is None else (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in rows]
    assert Counter(map(tuple, queries.op12_hard_negatives(spark, sf).collect())) == brute(rows)

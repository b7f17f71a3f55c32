"""Queries against their SQL, on the given tables and on odd rows."""

import random

import duckdb
import pytest

from gaugewell.llm import queries
from test_operators import prose

KEYS = ("op4_suffix_dedup", "op5_near_embeddings", "op6_near_minhash", "op11_exact_dedup", "op12_hard_negatives", "op13_spelling_groups")


def both(spark, folder, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    want = con.execute(queries.oracle_sql()[key])
    names = [d[0] for d in want.description]
    found = queries.queries()[key](spark, folder)
    assert sorted(found.columns) == sorted(names)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    return order(found.select(*names).collect()), order(want.fetchall())


@pytest.fixture(scope="module")
def given(spark, sf, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("given"))
    for name in ("documents", "embeddings"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls, empty texts, equal and close rows, close words, chains of them, links of all kinds."""
    rng = random.Random(31)
    folder = str(tmp_path_factory.mktemp("odd"))
    base = [prose(rng, 160) for _ in range(8)]
    near = base[0].split()
    near[30] = "changed"
    chain = " ".join(["straßenbahn"] * 90 + ["strassenbahn"] * 17 + ["Straßenbahnn"] * 40 + ["traßenbahnn"] * 6 + ["straßenbahx"] * 5)
    texts = [None, "", "a", "two  words", "Two\twords", *base, base[1], " ".join(near), base[2] + " é " + base[3][:450], base[4] * 3, chain]
    texts += ["x" * 900, "é" * 500, "Ünïcode ünïcode " * 9, "no  break"]
    rows = [*enumerate(texts), (6, base[1])]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, text_key string, n int")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    vectors = [[x + rng.gauss(0, 0.12) for x in rng.choice(centres)] for _ in range(150)]
    vectors += [None, [0.0] * 12, [float("nan")] * 12, [1.0, None] + [0.0] * 10, [float("inf")] * 12, vectors[3], [2 * x for x in vectors[4]]]
    rows = [(i, v, i % 10 if i % 13 else None) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("key", KEYS)
def test_given_tables(spark, given, key):
    got, want = both(spark, given, key)
    assert got == want and len(got) > 1


@pytest.mark.parametrize("key", KEYS)
def test_odd_rows(spark, odd, key):
    got, want = both(spark, odd, key)
    assert got == want and len(got) > 1

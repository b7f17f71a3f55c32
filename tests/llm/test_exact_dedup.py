"""Exact duplicates against grouping by the text."""

import hashlib
import re
from collections import Counter, defaultdict

from gaugewell.llm import exact_dedup, queries

LONG = "long text \t" * 500_000


def brute(rows):
    """doc_id, keep_id, size, sha256 of each row, and the number kept of each text."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[i, min(known) if known else None, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    return out, len(groups)


def held(found, rows):
    got = [tuple(r) for r in found.collect()]
    want, groups = brute(rows)
    assert Counter((i, k, n, sha) for i, k, n, _, sha in got) == want
    assert sum(kept for *_, kept, _ in got) == groups == len({sha for *_, kept, sha in got if kept})
    assert all(i == k for i, k, _, kept, _ in got if kept)


def test_odd_rows(spark):
    texts = [None, "", " ", "a  b", "a\t\n\x0b\x0c\rb", "a b", "a b", "A b", LONG, LONG.replace("\t", "\n"), "é", "é"]
    rows = [(40 - i, t) for i, t in enumerate(texts)] + [(33, "a b"), (33, "a b"), (None, "a b"), (None, "alone"), (None, "alone")]
    rows += [(100 + i, "common") for i in range(300)] + [(1000 + i, f"text {i % 90}") for i in range(200)]
    clash = "doc_id long, text string, node int, digest string, row string, n long, proof int, keep_id int"
    docs = spark.createDataFrame([(i, t, 1, "x", None, 7, 2, 3) for i, t in rows], clash).repartition(7)
    held(exact_dedup.exact_groups(docs, fan_in=2), rows)
    held(exact_dedup.exact_groups(docs, fan_in=3, parts=20), rows)
    assert exact_dedup.exact_groups(docs.limit(0)).collect() == []


def test_whole_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    held(queries.op11_exact_dedup(spark, sf), rows)


def test_rounds_meet_all_digits():
    for parts in (2, 8, 9, 51, 211, 5000):
        base, rounds = exact_dedup.radix(parts)
        assert 2 <= base <= exact_dedup.FAN_IN and base**rounds >= parts and base ** (rounds - 1) < parts


def test_runs_of_many_batches(spark):
    rows = [(i, f"text {i % 40}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        held(exact_dedup.exact_groups(docs), rows)
    finally:
        spark.conf.set(name, before)


def test_a_round_merges_a_common_text_to_a_few_entries(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "'same' AS text").repartition(16)
    rows = exact_dedup.digests(docs, 16)
    runs = exact_dedup.merged(rows.selectExpr("*", "1L AS n"))
    assert runs.count() == 16
    assert [(r.doc_id, r.n) for r in exact_dedup.exchanged(runs, 4, 2).collect()] == [(0, 1000)]

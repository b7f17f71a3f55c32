"""What every operator makes of odd rows, and the exact ways for hot groups."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugewell.llm import chat, decontaminate, html_extract, licenses, near_embeddings, near_minhash, packing, quality, suffix_dedup, toxicity
from gaugewell.llm.licenses import _words
from gaugewell.llm.queries import tokenizer_path
from test_operators import prose

CLASH = ("key", "batch", "node", "band", "row", "part", "block", "core", "lead", "n", "host", "paths", "runs", "hits", "text_key")


def clashing(df):
    return df.select("*", *[F.lit(i).cast("string" if i % 2 else "long").alias(c) for i, c in enumerate(CLASH) if c not in df.columns])


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(21)
    base = [prose(rng, 150) for _ in range(5)]
    texts = [None, "", "one", *base, base[0], base[1] + " more", "5 MB " * 1_000_000]
    rows = [*enumerate(texts), (3, base[0]), (None, base[2]), (None, None)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return clashing(spark.createDataFrame([(i, i % 2, i % 2) for i in range(3, 10)] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int"))


def operators(spark, labels):
    items = clashing(spark.createDataFrame([(1, "x " * 40), (2, None), (1, "x " * 40), (None, "y " * 30)], "item_id long, text string"))
    return {
        "packing": lambda d: packing.pack(d, tokenizer_path(), size=512),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "suffix": lambda d: suffix_dedup.drop_repeats(d),
        "words": lambda d: suffix_dedup.drop_repeated_words(d, 51),
        "minhash": lambda d: near_minhash.near_duplicates(d),
        "licenses": lambda d: licenses.scan(d),
        "decontaminate": lambda d: decontaminate.matches(d, items),
        "quality": lambda d: quality.resample(d, quality.labelled_target(d, labels)),
    }


@pytest.mark.parametrize("name", ["packing", "toxicity", "suffix", "words", "minhash", "licenses", "decontaminate", "quality"])
def test_odd_documents(spark, docs, labels, name):
    run = operators(spark, labels)[name]
    found = run(docs)
    ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
    got = Counter(r.doc_id for r in found.select("doc_id").collect())
    assert set(got) == set(ids) if name == "packing" else got == ids
    assert run(docs.where("false")).count() == 0


def test_odd_vectors_and_conversations(spark):
    vectors = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 1), (3, None, 1), (4, [0.0, 0.0], 1), (None, [1.0, 0.0], None)]
    got = near_embeddings.near_vectors(clashing(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"))).collect()
    assert Counter((r.vec_id, r.n_links) for r in got) == Counter([(1, 3), (1, 3), (2, 3), (None, 3), (3, 0), (4, 0)])
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "x " * 1000), (2, 0, None, None), (2, 1, "assistant", "")]
    rows = chat.read_back(chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"), tokenizer_path()))
    assert {r.conv_id: r.loss_chars for r in rows.collect()} == {1: 2000, 2: 0}


def overlap(a, b):
    bags = []
    for text in (a, b):
        words = _words(text)
        bags.append(Counter(zip(*(words[i:] for i in range(5)))) if len(words) >= 5 else Counter([tuple(words)]))
    both = (bags[0] & bags[1]).total()
    return both / (bags[0].total() + bags[1].total() - both)


def test_near_duplicates_in_small_blocks_are_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    texts = []
    for _ in range(8):
        base = prose(rng, 120).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    monkeypatch.setattr(near_minhash, "BLOCK", 2)
    rows = near_minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bands=60, rows=3).collect()
    up = list(range(len(texts)))
    find = lambda i: i if up[i] == i else find(up[i])
    for i in range(len(texts)):
        for j in range(i):
            if overlap(texts[i], texts[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                up[b] = a
    assert {r.doc_id: r.component_id for r in rows} == {i: find(i) for i in range(len(texts))}


def test_templates_of_a_caller(spark):
    own = [("own", "vorbehaltlich aller rechte [[des {{2}}]]", 0.9), ("only-gaps", "{{2}}", 0.1), ("plain", "as is", 0.5)]
    texts = ["Vorbehaltlich aller Rechte", "vorbehaltlich aller anderen", "given as is", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan(docs, templates=own[:1] + own[2:]).collect()}
    assert [rows[i].labels for i in range(4)] == ["own", "", "plain", ""]
    assert licenses.Automaton(own[1][1]).anchor is None


def test_learned_terms_have_no_cap(spark):
    terms = [f"zz{'abcdefghij'[i % 10]}{i:04d}q" for i in range(6000)]
    rows = [(i, " ".join(terms[(i * 300 + j) % 6000] for j in range(300)) + f" plain{i}", 1) for i in range(400)]
    rows += [(1000 + i, f"nothing but harmless talk {i} of words and days", 0) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    covered = [t for t in terms if t in set(model.words) or any(t.startswith(s) for s in model.stems)]
    assert len(covered) == 6000

"""The license query against regular expressions over words joined by spaces."""

import random
import re

import pytest

from gaugewell.llm import licenses, queries
from test_operators import prose


def pattern(template):
    """A template as an expression over words that each end with a space."""
    said = {"[[": "(?:", "]]": ")?"}
    marks = re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template)
    return re.compile("".join(said.get(m) or (f"(?:[^ ]+ ){{0,{m[2:-2]}}}" if m[0] == "{" else re.escape(m) + " ") for m in marks))


def plain(text):
    words = licenses._words(text or "")
    base = [(i, label) for phrase, label in licenses.PHRASES for k in [phrase.split()] for i in range(len(words)) if words[i : i + len(k)] == k]
    labels, score, spans = {label for _, label in base}, licenses.PHRASE_WEIGHT if base else 0.0, []
    for label, template, weight in licenses.TEMPLATES:
        expression, at, hit = pattern(template), 0, False
        while at < len(words):
            rest = " ".join(words[at : at + 150]) + " "
            ends = [n for n in range(1, len(words) - at + 1) if n <= 150 and expression.fullmatch(rest, 0, sum(len(w) + 1 for w in words[at : at + n]))] if expression.match(rest) else []
            if ends:
                spans.append((label, at, at + max(ends)))
                hit = True
            at += max(ends, default=1)
        if hit:
            labels.add(label)
            score = 1 - (1 - score) * (1 - weight)
    starts = [i for i, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in base})),
        ",".join(sorted(labels)), round(score, 12), spans,
    )


@pytest.fixture(scope="module")
def odd():
    """Templates filled at random within prose: optional parts in and out, gaps of all lengths, words missing."""
    rng = random.Random(41)
    texts = [None, "", "MIT License, apache license: CC-BY cc by\n gnu General (public) license"]
    for _ in range(60):
        parts = []
        for _, template, _ in rng.choices(licenses.TEMPLATES, k=rng.randint(1, 3)):
            filled = re.sub(r"\[\[([^\[\]]*)\]\]", lambda m: rng.choice([m[1], ""]), template)
            filled = re.sub(r"\{\{(\d+)\}\}", lambda m: " ".join(rng.choice(["2", "Any", "ünï"]) for _ in range(rng.randint(0, int(m[1]) + 1))), filled)
            said = filled.split()
            if rng.random() < 0.25:
                said[rng.randrange(len(said))] = rng.choice(["", "other"])
            parts += [prose(rng, rng.randint(0, 9)), rng.choice([" ", "\n", ", "]).join(said).title()]
        texts.append(rng.choice([" ", ". "]).join(parts))
    return [*enumerate(texts), (5, texts[5]), (None, texts[6])]


def columns(rows):
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    found = ((r.doc_id, *(r[n] for n in names), round(r.score, 12), [tuple(s) for s in r.spans]) for r in rows)
    return sorted(found, key=repr)


def test_odd_texts(spark, odd):
    docs = spark.createDataFrame(odd, "doc_id long, text string").repartition(3)
    got = columns(licenses.scan(docs).collect())
    assert got == sorted(((i, *plain(t)) for i, t in odd), key=repr)
    assert sum(len(r[-1]) for r in got) > 60
    assert {label for r in got for label, _, _ in r[-1]} == {label for label, _, _ in licenses.TEMPLATES}


def test_given_documents(spark, sf):
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = columns(queries.op8_license_scan(spark, sf).collect())
    assert got == sorted(((r.doc_id, *plain(r.text)) for r in given), key=repr)
    assert any(r[-1] for r in got)

"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from gaugewell.llm import queries, spelling

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    by_cut = {}
    for w in words:
        for i in range(len(w)):
            by_cut.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    near = {w: set() for w in words}
    for group in by_cut.values():
        for w in group:
            near[w].update(v for v in group if v != w)
    for w in words:
        for i in range(len(w)):
            if (v := w[:i] + w[i + 1 :]) in words:
                near[v].add(w)
                near[w].add(v)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 5 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def variants(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abé×ÿ")
    return rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :], word[:i] + word[i:][::-1]])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(60)] + ["x" * 60, "ab" * 40, "été" * 3]
    rows = []
    for i in range(400):
        words = [rng.choice(base) for _ in range(20)] + [variants(rng, variants(rng, rng.choice(base[:8] + base[-3:]))) for _ in range(12)]
        rows.append((i, rng.choice([" ", ", ", "1", "ž", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    rows += [(i, "chaina " + "chainaa " * 6 + "chainaaa " * 40) for i in range(500, 520)]
    long = "z" * 2_000
    return [*rows, rows[0], rows[0], (None, "without nothing ident"), (600, None), (601, ""), *[(700 + i, f"{long} {long}y") for i in range(6)]]


def test_groups(spark, rows, monkeypatch):
    clash = "doc_id long, text string, word string, n int, key int, side int, low string"
    docs = spark.createDataFrame([(*r, "w", 1, 2, 3, "l") for r in rows], clash).repartition(5)
    want = brute(rows)
    assert sum(1 for r in want if r[1]) > 20 and any(r[1] and r[1] != r[2] for r in want)
    got = spelling.spelling_groups(docs).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    # keys cut into many blocks
    got = spelling.spelling_groups(docs, block=30).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert spelling.spelling_groups(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcd") for _ in range(7)) for _ in range(300)]
    rows = [(1, " ".join(rng.choice(words) for _ in range(600_000))), (2, "q" * 200_000 + " nothing")]
    got = spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute(rows)


def test_whole_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_spelling_groups(spark, sf).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(set(got))


def test_near_finds_every_edit():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(3, 7))) for _ in range(1500)} | {"a" * 70, "a" * 71, "a" * 69 + "b"})
    i, j = spelling._near(pa.array(words), pa.array(words))
    got = {(words[a], words[b]) for a, b in zip(i, j)}
    assert got == {(a, b) for a in words for b in words if len(b) >= len(a) and one_edit(a, b)}

"""The whole pipeline against plain Python, stage by stage on what the stage before kept."""

import math
import random
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugewell.llm import decontaminate, quality
from gaugewell.llm.common import unit_hash
from gaugewell.llm.queries import tokenizer_path
from test_odd_rows import overlap
from test_operators import prose

ITEMS = [" ".join(["what", "is", "the", *prose(random.Random(70 + i), 18).split()]) for i in range(2)]


def documents():
    rng = random.Random(71)
    passage = prose(rng, 60)
    base = [prose(rng, rng.randint(80, 200)) for _ in range(14)]
    near = base[0].split()
    near[20] = "changed"
    hit = base[3].split()
    hit[40:40] = ITEMS[0].replace(ITEMS[0][9:11], "x", 1).split()
    texts = [*base, base[1], " ".join(near), f"{prose(rng, 30)}  {passage}\n{prose(rng, 40)}", f"{prose(rng, 35)} {passage} {prose(rng, 25)}"]
    texts += [passage, " ".join(hit[30:]), prose(rng, 20) + " " + ITEMS[1].upper() + " " + prose(rng, 20), None, "", "short one"]
    texts += [" ".join(w.upper() + "!!" for w in prose(rng, 60).split()) for _ in range(5)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[4], (None, base[5] + " more", "en", "s", 1)]


def drawn(spark, rows, good):
    """The quality stage: the n-grams' buckets are the operator's, models, weights and the draw are plain."""
    grams = [quality.bucket_rows(pa.array([r[1]], pa.string()), quality.BUCKETS)[1].tolist() for r in rows]
    raw, target = Counter(), Counter()
    for row, found in zip(rows, grams):
        raw.update(found)
        target.update(found if row[0] in good else ())
    share = target.total() / raw.total()
    ratio = lambda b: math.log(target[b] + quality.SMOOTHING) - math.log(raw[b] * share + quality.SMOOTHING)
    weights = [sum(map(ratio, found)) for found in grams]
    noise = {r.doc_id: r.u for r in spark.createDataFrame([(r[0],) for r in rows], "doc_id long").select("doc_id", unit_hash("doc_id").alias("u")).collect()}
    keys = [w - math.log(-math.log(noise[r[0]])) for w, r in zip(weights, rows)]
    k = sum(w >= math.log(quality.WORTH) for w in weights)
    return [r for r, key in zip(rows, keys) if key >= sorted(keys, reverse=True)[k - 1]]


def deduped(rows):
    up = {r[0]: r[0] for r in rows}
    find = lambda i: i if up[i] == i else find(up[i])
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[1] and b[1] and None not in (a[0], b[0]) and overlap(a[1], b[1]) >= 0.8:
                lo, hi = sorted((find(a[0]), find(b[0])))
                up[hi] = lo
    return [r for r in dict.fromkeys(rows) if up[r[0]] == r[0]]


def without_repeats(rows, size=51):
    """Texts as their words from here on."""
    found = [(r[1] or "").split() for r in rows]
    seen = Counter(tuple(w[i : i + size]) for w in found for i in range(len(w) - size + 1))
    out = []
    for row, w in zip(rows, found):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        if not gone or len(gone) < len(w):
            out.append((row[0], " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def holds(item, text):
    item, text = decontaminate.normal(item), np.frombuffer(decontaminate.normal(text).encode(), np.uint8)
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item.encode(), 1):
        step = np.concatenate(([i], np.minimum(row[:-1] + (text != c), row[1:] + 1)))
        row = np.minimum.accumulate(step - at) + at
    return row.min() <= decontaminate.budget(item)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(*r, "clash", 1) for r in documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, n int")
    docs.repartition(4).write.parquet(f"{base}/documents.parquet")
    labels = [(i, int(i < 8), 0) for i in (*range(8), 24, 25)] + [(None, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([*enumerate(ITEMS), (9, None)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_run_is_the_plain_version(spark, folder):
    rows = documents()
    kept = drawn(spark, rows, set(range(8)))
    alone = deduped(kept)
    clean = without_repeats(alone)
    want = Counter((i, t) for i, t in clean if not any(holds(item, t) for item in ITEMS))
    # every stage decides something here
    assert len(rows) > len(kept) > len(alone) > len(clean) > len(want) > 8
    assert sum(len(t.split()) for _, t in clean) < sum(len((r[1] or "").split()) for r in alone) - 150

    whole, sequences = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        whole[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    tokenizer, got = Tokenizer.from_file(tokenizer_path()), Counter()
    for doc_id, found in whole.items():
        ids = []
        for start, piece, _ in sorted(found):
            assert start == len(ids)
            ids += piece
        assert ids[-1] == 1 and {n for *_, n in found} == {len(ids)}
        got[doc_id, " ".join(tokenizer.decode(ids[:-1], skip_special_tokens=False).split())] += 1
    assert got == want
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


def test_stages_on_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*corpus_pipeline.COLUMNS).where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0

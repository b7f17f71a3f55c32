"""Stages of the pipeline on odd rows."""

import random
from collections import Counter

import corpus_pipeline
from test_operators import odd_docs, prose


def test_near_dedup_stage(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t, _, _ in odd_docs()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_dedup(spark, docs, "")
    assert tuple(out.columns) == corpus_pipeline.COLUMNS
    # 10 repeats document 5 and 11 is close to document 4; the repeated row is one
    ids = sorted((r.doc_id for r in out.collect()), key=lambda i: (i is None, i))
    assert ids == [*(i for i in range(16) if i not in (10, 11)), None]


def test_repeats_stage_counts_words(spark):
    rng = random.Random(12)
    texts = [prose(rng, 70) for _ in range(6)]
    short, less, signs = prose(rng, 51), prose(rng, 50), "".join(chr(0x4E00 + i) for i in rng.sample(range(3000), 60))
    assert len(short.encode()) < 400
    texts += [f"{prose(rng, 20)} {short} {prose(rng, 20)}", f"é\u00a0{short.replace(' ', '  ')}\n{prose(rng, 9)}", short]
    texts += [f"one {less} two", f"three {less} four", f"{signs} five", f"six {signs}", "", None]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(None, texts[0], "en", "s", 1)]
    seen = Counter()

    def split(text):
        return [w for part in (text or "").split() for w in ([*part] if part in signs else [part])]

    for _, text, *_ in rows:
        found = split(text)
        seen.update(tuple(found[i : i + 51]) for i in range(len(found) - 50))
    want = Counter()
    for doc_id, text, *_ in rows:
        found = split(text)
        gone = {j for i in range(len(found) - 50) if seen[tuple(found[i : i + 51])] > 1 for j in range(i, i + 51)}
        if len(gone) < len(found) or not found:
            want[doc_id, " ".join(w for j, w in enumerate(found) if j not in gone)] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.repeat_removal(spark, docs, "")
    assert tuple(out.columns) == corpus_pipeline.COLUMNS
    got = [(r.doc_id, " ".join(r.text.split()), r.n_chars == len(r.text)) for r in out.collect()]
    assert Counter((i, t) for i, t, _ in got) == want and all(ok for _, _, ok in got)
    assert (8, "") not in want and any(i == 6 and short not in t for i, t in want) and (9, texts[9]) in want

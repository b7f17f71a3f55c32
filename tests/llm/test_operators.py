"""Operators of the training-data pipeline against brute force, on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gaugewell.llm import (
    chat, decontaminate, html_extract, licenses, near_embeddings, near_minhash, packing, quality, suffix_dedup, toxicity,
)
from gaugewell.llm.components import components
from gaugewell.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, text_key string, n int"
WORDS = [a + b for a in "ka lo mi nu re".split() for b in "ta so vi".split()]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


def odd_docs(seed=1):
    """Nulls, empty and short texts, repeated rows, copies, near copies, shared passages."""
    rng = random.Random(seed)
    passage = prose(rng, 120)
    base = [prose(rng, rng.randint(150, 300)) for _ in range(6)]
    near = base[0].split(" ")
    near[40] = "other"
    texts = [None, "", "a", "two words", *base, base[1], " ".join(near), prose(rng, 30) + passage + prose(rng, 20),
             passage + "é" * 30, "x" * 900, "  odd \n spacing<|endoftext|> "]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, "no id", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_docs(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(docs, tokenizer_path(), size=256).collect()
    whole, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        whole[r.doc_id].append((r.start, r.length, zlib.crc32(r.ids), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, _, _ in set(odd_docs()):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        times = 2 if doc_id == 5 else 1
        got = Counter()
        for start, length, crc, n in whole[doc_id]:
            assert n == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            got.update(range(start, start + length))
        assert got == Counter({i: times for i in range(len(ids))})
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


def test_packing_plan_covers_every_rank():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(1, 64, 5000).tolist()) | {64: 5}
    plan = packing.plan_packing(counts, 64)
    assert sum(plan.dealt.values()) > 2000
    used = Counter()
    for length, n in counts.items():
        for rank in range(n):
            parts = plan.place(length, rank)
            assert sum(p[1] for p in parts) == length
            used.update((s, o + i) for _, k, s, o in parts for i in range(k))
    assert max(used.values()) == 1


def test_suffix_dedup(spark, docs, monkeypatch):
    length = 100

    def brute():
        texts = [(i, (t or "").encode()) for i, t, _, _ in odd_docs()]
        seen = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
        out = []
        for doc_id, b in texts:
            gone = bytearray(len(b))
            for i in range(len(b) - length + 1):
                if seen[b[i : i + length]] > 1:
                    gone[i : i + length] = b"\1" * length
            out.append((doc_id, len(b), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(b, gone) if not g)))
        return Counter(out)

    for together in (4096, 1):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
        rows = suffix_dedup.drop_repeats(docs, length).collect()
        assert Counter((r.doc_id, r.n_bytes, len(r.removed), bytes(r.kept)) for r in rows) == brute()
    assert suffix_dedup.drop_repeats(empty(spark)).count() == 0


def test_suffix_dedup_without_ids(spark, monkeypatch):
    length, rng = 100, random.Random(11)
    a, b, c = (prose(rng, 60) for _ in range(3))
    # 1 and 2 share only a part with the rows without an id, whose class of equal stretches has several members
    rows = [(None, a + b), (None, a + b), (None, "head " + c), (1, c + " tail"), (2, b[40:] + prose(rng, 40)), (3, prose(rng, 60)), (0, a[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = [(i, t.encode()) for i, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    want = Counter()
    for doc_id, t in texts:
        gone = {j for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1 for j in range(i, i + length)}
        want[doc_id, bytes(x for j, x in enumerate(t) if j not in gone)] += 1
    for together in (4096, 1):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
        assert Counter((r.doc_id, bytes(r.kept)) for r in suffix_dedup.drop_repeats(docs, length).collect()) == want


def test_suffix_dedup_moves_texts_once(spark, monkeypatch):
    """Both ways of comparing strings read what one join with the texts cut out, however many fingerprints go each way."""
    length, rng = 100, random.Random(12)
    shared, rare = prose(rng, 60), prose(rng, 60)
    # every text holds a part of the one passage; the first two of the other as well, whose fingerprints have two classes
    texts = [prose(rng, 30) + shared[i : i + 150] + prose(rng, 30) + (rare[i : i + 150] if i < 2 else "") for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).persist()
    seen = spark.sparkContext.accumulator(0)

    def coder(part):
        seen.add(part.num_rows)
        return suffix_dedup.text_bytes(part.column("text"))

    found = []
    for together in (4096, 2, 1):
        monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
        before = seen.value
        spans = suffix_dedup.repeated_spans(docs, length, coder=coder).collect()
        assert len(texts) < seen.value - before <= 2 * len(texts)
        found.append({(r.doc_id, at) for r in spans for at in range(r.lo, r.hi + 1)})
    assert found[0] and found[0] == found[1] == found[2]


def test_suffix_dedup_splits_hot_fingerprints(spark, monkeypatch):
    """The join that keeps the suffixes of known fingerprints has no aggregate that keeps a hot one in one task."""
    plans = []

    def kept(df, label, stored=suffix_dedup.stored):
        if label == "suffixes-known":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, label)

    monkeypatch.setattr(suffix_dedup, "stored", kept)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        suffix_dedup.repeated_spans(spark.createDataFrame([(i, "x" * 300) for i in range(4)], "doc_id long, text string"), 100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(plans) == 1 and "LeftSemi" in plans[0] and "Aggregate" not in plans[0]


def test_near_minhash(spark, docs):
    rows = near_minhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd_docs())
    found = {r.doc_id: r.component_id for r in rows}
    assert found[10] == 5 and found[11] == 4 and found[0] == 0 and found[1] == 1 and found[6] == 6
    assert near_minhash.near_duplicates(empty(spark)).count() == 0


def test_signatures_are_unbiased():
    a, b = Counter({i: 1 + i % 5 for i in range(60)}), Counter({i: 1 + i % 3 for i in range(20, 80)})
    spread = lambda c: np.array(sorted(c.elements()), np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x, y = spread(a), spread(b)
    s = near_minhash.signatures(np.repeat([0, 1], [len(x), len(y)]), np.concatenate((x, y)), 2, 4000)
    assert abs((s[0] == s[1]).mean() - near_minhash.overlap(a, b)) < 0.03


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 450)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        up[hi] = lo
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for n in up if any(n in link and link[0] != link[1] for link in links)}


def test_near_embeddings(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((5, 16))
    x = (centre[rng.integers(0, 5, 120)] + 0.12 * rng.standard_normal((120, 16))).tolist()
    x += [x[3], x[3], [0.0] * 16, [float("nan")] * 16, [1.0] + [None] * 15, None, [], [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>").repartition(4)
    rows = {r.vec_id: r for r in near_embeddings.near_vectors(df, recall=0.999999).collect()}
    good = np.array(x[:122])
    unit = good / np.linalg.norm(good, axis=1)[:, None]
    alike = unit @ unit.T >= 0.9
    assert [rows[i].n_links for i in range(122)] == (alike.sum(axis=1) - 1).tolist()
    assert all(rows[i].n_links == 0 and rows[i].component_id == i for i in range(122, 127))
    assert rows[127].n_links == rows[128].n_links == 1 and rows[128].component_id == 127 and len(rows) == len(x)
    assert near_embeddings.near_vectors(df.where("false")).count() == 0


def test_decontaminate(spark):
    rng = random.Random(5)
    items = [prose(rng, 30) for _ in range(8)]
    typo = items[1][:50] + "zz" + items[1][54:]
    texts = [None, "", prose(rng, 50), prose(rng, 9) + " " + items[0].upper() + " end", "x " + typo + " y", items[2][:80], items[3]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (99, ""), (98, None)], "item_id long, text string")
    got = {r.doc_id: [(h.item_id, h.distance) for h in r.hits] for r in decontaminate.matches(docs, bench).collect()}

    def distance(item, text):
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            before, row[0] = row[0], i
            for j, d in enumerate(text, 1):
                before, row[j] = row[j], min(before + (c != d), row[j] + 1, row[j - 1] + 1)
        return min(row)

    for i, text in enumerate(texts):
        near = [(k, distance(decontaminate.normal(t), decontaminate.normal(text))) for k, t in enumerate(items)]
        assert got[i] == [(k, d) for k, d in near if d <= decontaminate.budget(decontaminate.normal(items[k]))]
    assert decontaminate.matches(docs, bench.where("false")).where("size(hits) > 0").count() == 0
    # blocks of one, two and a few items: the same hits, row by row, NULL and repeated ids too
    odd = docs.unionAll(docs.where("doc_id > 2")).unionAll(docs.selectExpr("cast(null as long)", "text"))
    whole = Counter(str(r) for r in decontaminate.matches(odd, bench).collect())
    sizes = [len(b) for b in decontaminate.item_blocks(bench, 500)]
    assert len(sizes) > 2 and sum(sizes) == len(items) and max(sizes) > 1
    for chars in (1, 500):
        assert Counter(str(r) for r in decontaminate.matches(odd, bench, block_chars=chars).collect()) == whole


def test_quality(spark):
    rng = random.Random(6)
    good = [prose(rng, 80) for _ in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in prose(rng, 60).split()) for _ in range(12)]
    rows = list(enumerate([*good, *bad, None, ""]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.where("doc_id < 20").select("text")
    kept = {r.doc_id for r in quality.resample(docs, target).where("kept").collect()}
    assert kept == {*range(60), 72, 73}
    keys = [r.gumbel_key for r in quality.resample(docs, target, keep=17).where("kept").collect()]
    assert len(keys) == 17
    assert quality.resample(docs, target.where("false")).where("kept").count() == len(rows)
    assert quality.resample(docs.where("false"), target).count() == 0


def test_kth_largest(spark):
    rng = random.Random(7)
    values = [rng.choice([0.1, 0.2, rng.random(), 1e9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 250, 499, 500):
        assert quality.kth_largest(df, "x", k, bins=8) == sorted(values, reverse=True)[k - 1]


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    texts = [None, "", "MIT License, mit\nLICENSE", "Licensed under the GNU General Public License, version 3.", mit, mit.replace("granted", "given"), "apache   license cc by"]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (rows[0].n_words, rows[0].n_base, rows[0].first_word, rows[0].labels, rows[0].score) == (0, 0, None, "", 0.0)
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].base_labels) == (2, 0, 2, "mit")
    assert rows[3].labels == "gpl,gpl-notice" and rows[3].first_word == 3
    assert "mit-text" in rows[4].labels and "mit-text" not in rows[5].labels
    assert rows[6].base_labels == "apache,cc-by" and rows[6].last_word == 2


def test_toxicity_automaton():
    lexicon = toxicity.Lexicon(["idiot", "scum"], ["lowei"])
    assert [lexicon.look(w) for w in ("idiot", "idiott", "idot", "idjot", "iddjot", "scum", "scam", "loweisch", "lowe", "x")] == [1, 2, 2, 2, 0, 1, 0, 1, 0, 0]
    clean, bad = set(), {}
    f, hits = toxicity.features(lexicon, frozenset(), clean, bad, 'he said "you idiot" and idiot')
    assert [h[2] for h in hits] == [True, False] and f[1] == 1.0 and f[2] == 1.0


def test_toxicity_automaton_is_edit_distance():
    rng = random.Random(9)
    terms = ["grumko", "vexorn", "blatter", "scum", "oaf"]
    lexicon = toxicity.Lexicon(terms, [])

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, d in enumerate(b, 1):
                before, row[j] = row[j], min(before + (c != d), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    levels = Counter()
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", *"gruvexo"])
        word = "".join(word)
        found = lexicon.look(word)
        levels[found] += 1
        near = any(distance(word, t) <= toxicity.edits(t) for t in terms)
        assert found == (1 if word in terms else 2 if near else 0), word
    assert levels[0] and levels[1] and levels[2]


def test_toxicity_fit(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 40) + (f" grumk{rng.choice('aeiou')} vexorn" if i % 8 == 0 else "")) for i in range(400)] + [(900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(0, 400) if i % 3], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert all((scores[i] >= 0.7) == (i % 8 == 0) for i in range(400)) and scores[900] < 0.7
    assert toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).count() == 401


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<|end|>", "<\\|x <\\\\|", "[\\INST]", "<", "", "[/\\INST] <s>"])
def test_escape(text):
    assert chat.unescape(chat.escape(text)) == text
    rendered, _ = chat.render([("user", text), (text, "b")])
    assert chat.parse(rendered) == [("user", text), (text, "b")]


def test_chat(spark):
    rows = [(1, 1, "assistant", "é😀 <|end|> ok"), (1, 0, "user", "hi"), (1, 2, "assistant", " two\n"), (2, 0, None, None), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, tokenizer_path())).collect()}
    loss = "é😀 <|end|> ok two\n"
    assert got[1].n_turns == 3 and got[1].loss_chars == len(loss)
    assert got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(("user\nhi\nassistant\né😀 <|end|> ok\nassistant\n two\n\n").encode()).hexdigest()
    assert got[2].loss_chars == 0 and got[None].n_turns == 1
    assert chat.read_back(chat.format_conversations(df.where("false"), tokenizer_path())).count() == 0


def test_html(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p>'</script></head><body><nav><a href=x>menu</a></nav>"
        "<div class='sidebar'>side</div><article><h1>Head &amp; line</h1><p><b>First&nbsp; text<br>more<p>Second\n text</p>"
        "<div class=ad>buy</div><form>f</form></article><div id=comments><p>reader</p></div><footer>&copy;</footer></body></html>"
    )
    rows = [(1, "http://a.example/1", page), (2, "http://a.example/2", None), (3, None, ""), (4, "http://b.example/", "plain text"), (1, "http://a.example/1", page)]
    got = [(r.page_id, r.text) for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    article = "Head & line\nFirst text more\nSecond text"
    assert Counter(got) == Counter([(1, article), (1, article), (2, ""), (3, ""), (4, "plain text")])


def test_html_article_in_unequal_boxes(spark):
    lead, body = "Lead words of it. " * 3, "Body words of it. " * 7
    boxes = f"<div class=lead><p>{lead}</p></div><div class=body><p>{body}</p><p><a href=x>source</a></p></div>"
    menu = "<nav><a href=x>menu</a></nav><div class=sidebar>side</div><div class=links><a href=y>more pages</a></div>"
    pages = [
        f"<html><body>{menu}<div class=post>{boxes}</div><footer>end</footer></body></html>",
        f"<html><body>{menu}<div class=teaser>other</div><article><div class=a><div class=b>{boxes}</div></div><p>Last</p></article></body></html>",
        boxes,
    ]
    rows = [(i, f"http://h{i % 3}.example/{i}", pages[i % 3]) for i in range(9)]
    want = "\n".join(" ".join(x.split()) for x in (lead, body, "source"))
    for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text == want + "\nLast" * (r.page_id % 3 == 1)
        assert r.path == ["html>body>div.post", "html>body>article", None][r.page_id % 3]

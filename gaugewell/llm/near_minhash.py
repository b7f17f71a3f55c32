"""Near-duplicates of texts by BagMinHash.

A text is the multiset of its runs of five words.  Each (run, weight) is a Poisson process
over the strip [0, weight) of weights: points arrive in order of time, each with a place
in the strip and a signature component; a component keeps the earliest point it gets.
Two texts share a component's point with the probability of their weighted Jaccard
similarity.  The strip is split into dyadic levels, so a level's points are the same for
every weight that covers it, and a level that is covered in part drops points beyond the
weight.  Points later than what the whole signature needs are never made: a text of any
length costs one hash per run and a bounded number of points.

Signatures are cut into bands; texts that share a band are compared by exact multiset
overlap; links join into components.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import BASE, Words, mix, slices, stored
from gaugewell.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(rows: np.ndarray, shingles: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """(n_rows, size) signatures of texts given as (row, run) pairs; rows without runs get zeros."""
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(rows)))
    rows, shingles = rows[first], shingles[first]
    total = np.bincount(rows, weight, minlength=n_rows)
    out = np.zeros((n_rows, size), np.uint64)
    todo = np.flatnonzero(total > 0)
    bound = np.zeros(n_rows)
    # time by which all components have a point, but for one text in some hundreds
    bound[todo] = size * (np.log(size) + 6) / total[todo]
    while len(todo):
        active = np.zeros(n_rows, bool)
        active[todo] = True
        times = np.full((n_rows, size), np.inf)
        mask = active[rows]
        r, s, w = rows[mask], shingles[mask], weight[mask]
        level, lo = 0, 0
        while len(r):  # levels [0, 1), [1, 2), [2, 4), [4, 8) ...
            width = max(lo, 1)
            key = mix(s + np.uint64((level + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            kr, kk, kw, t, j = r, key, w, np.zeros(len(r)), 0
            while len(kr):
                step = mix(kk + np.uint64((j + 1) * BASE & (1 << 64) - 1))
                t = t - np.log(_uniform(step)) / width
                on = t < bound[kr]
                kr, kk, kw, t, step = kr[on], kk[on], kw[on], t[on], step[on]
                if len(kr):
                    place = lo + _uniform(mix(step + np.uint64(1))) * width
                    slot = (mix(step + np.uint64(2)) % np.uint64(size)).astype(np.int64)
                    inside = place < kw
                    a, b, c, d = kr[inside], slot[inside], t[inside], step[inside]
                    best = np.lexsort((c, a * size + b))[::-1]  # earliest last, so that it stays
                    a, b, c, d = a[best], b[best], c[best], d[best]
                    flat = a * size + b
                    last = np.ones(len(flat), bool)
                    last[:-1] = flat[:-1] != flat[1:]
                    a, b, c, d = a[last], b[last], c[last], d[last]
                    better = c < times[a, b]
                    times[a[better], b[better]] = c[better]
                    out[a[better], b[better]] = d[better]
                j += 1
            lo = width if level == 0 else lo * 2
            level += 1
            more = w > lo
            r, s, w = r[more], s[more], w[more]
        todo = todo[np.isinf(times[todo]).any(axis=1)]
        out[todo] = 0
        bound[todo] *= 2
    return out


def bags(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = WORDS) -> DataFrame:
    """doc_id, n_words, bag (two hashes of the word sequence, NULL without words), bands (array of hashes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                n = part.num_rows
                at, found = words.shingles(size)
                signature = signatures(at, found, n, bands * rows)
                keys = np.zeros((n, bands), np.uint64)
                for j in range(rows):
                    keys = mix(keys * np.uint64(BASE) + signature[:, j::rows])
                keys = mix(keys + np.arange(bands, dtype=np.uint64) * np.uint64(BASE)).view(np.int64)
                # hash of the whole sequence of words
                place = np.arange(len(words.rows)) - words.first[words.rows]
                ordered = mix(words.hashes + mix((place + 1).astype(np.uint64)))
                whole = np.zeros((n, 2), np.uint64)
                np.add.at(whole[:, 0], words.rows, ordered)
                np.add.at(whole[:, 1], words.rows, mix(ordered + np.uint64(BASE)))
                empty = words.counts == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(whole[:, 0].view(np.int64), mask=empty),
                        pa.array(whole[:, 1].view(np.int64), mask=empty),
                        pa.array([[] if e else k for e, k in zip(empty, keys)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_words", "bag_a", "bag_b", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, bag_a long, bag_b long, bands array<long>"
    )


Runs = tuple[np.ndarray, np.ndarray]


def _bags(texts: pa.Array, size: int) -> list[Runs]:
    """The multiset of runs of each text: hashes in order, each once, and how often each is there."""
    words = Words(texts)
    rows, shingles = words.shingles(size)
    order = np.lexsort((shingles, rows))
    rows, shingles = rows[order], shingles[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingles[1:] != shingles[:-1])
    first = np.flatnonzero(new)
    counts, shingles = np.diff(np.append(first, len(rows))), shingles[first]
    cuts = np.searchsorted(rows[first], np.arange(len(texts) + 1))
    return [(shingles[a:b].copy(), counts[a:b].copy()) for a, b in zip(cuts[:-1], cuts[1:])]


def _alike(a: Runs, b: Runs, similarity: float) -> bool:
    """Whether two multisets overlap by ``similarity`` or more."""
    if not len(a[0]) or not len(b[0]):
        return False
    if len(b[0]) < len(a[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = int(np.where(b[0][at] == a[0], np.minimum(a[1], b[1][at]), 0).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both) >= similarity


def overlap(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    if len(b) < len(a):
        a, b = b, a
    both = sum(min(n, b[k]) for k, n in a.items() if k in b)
    return both / max(a.total() + b.total() - both, 1)


# --- comparison -----------------------------------------------------------------------------

#: Rows of a block; a task compares two blocks at a time.
BLOCK = 256


def _blocks(members: DataFrame, *keep: str) -> DataFrame:
    """Deal the members of each ``band`` to blocks, and each block to all pairs of blocks it is in.

    Adds ``pair`` (two block numbers) and ``side``.  A band of n members becomes about
    (n / BLOCK)^2 / 2 tasks' worth of rows, none of them larger than two blocks.
    """
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("band", *keep, "block", other).select(
        "band", *keep, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block"
    )


class _Groups:
    """Union-find over the nodes of a task."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[a] = b
        return a != b


def _compared(rows: DataFrame, node_kind: str, similarity: float, size: int) -> DataFrame:
    """Links (a, b) that join groups, from blocks of rows: band, low, high, block, node, comp, bands, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(group: list[tuple], key: tuple) -> list[tuple]:
            band, low, high = key
            groups, found = _Groups(), []
            made = group
            total = [int(m[4][1].sum()) for m in made]
            sets = [frozenset(m[3]) for m in made]
            for i, (node, comp, block, bands, bag) in enumerate(made):
                for j in range(i + 1, len(made)):
                    other, other_comp, other_block, other_bands, other_bag = made[j]
                    if low != high and block == other_block:
                        continue
                    if min(total[i], total[j]) < similarity * max(total[i], total[j]):
                        continue
                    if groups.find(comp) == groups.find(other_comp):
                        continue
                    if len(sets[i] & sets[j]) > 1 and min(sets[i] & sets[j], key=bands.index) != band:
                        continue  # compared where they meet first
                    if _alike(bag, other_bag, similarity):
                        groups.join(comp, other_comp)
                        found.append((node, other))
            return found

        key, group, out = None, [], []
        for batch in (part for whole in batches for part in slices(whole, "text")):
            names = ("band", "low", "high", "block", "node", "comp", "bands")
            found = _bags(batch.column("text"), size)
            for band, low, high, block, *row in zip(*(batch.column(n).to_pylist() for n in names), found):
                if (band, low, high) != key:
                    out += links(group, key) if group else []
                    key, group = (band, low, high), []
                node, comp, bands, bag = row
                group.append((node, comp, block, bands, bag))
        out += links(group, key) if group else []
        a, b = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = rows.select("band", "low", "high", "block", "node", "comp", "bands", "text").repartition("band", "low", "high")
    return dealt.sortWithinPartitions("band", "low", "high", "node").mapInArrow(run, f"a {node_kind}, b {node_kind}")


def _star_links(stars: DataFrame, texts: DataFrame, node_kind: str, similarity: float, size: int) -> DataFrame:
    """Pairs (lead, node) that are similar; a lead's nodes are dealt to salts of bounded size, each with the lead."""
    sizes = stars.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
    nodes = stars.join(sizes, "lead").select("lead", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), F.lit(1).alias("part"), "node")
    leads = sizes.select("lead", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"), F.col("lead").alias("node"))
    rows = texts.join(nodes.unionAll(leads).hint("shuffle_hash"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bags_of_lead, out = None, [], []
        for batch in (part for whole in batches for part in slices(whole, "text")):
            found = _bags(batch.column("text"), size)
            for lead, salt, part, node, bag in zip(*(batch.column(n).to_pylist() for n in ("lead", "salt", "part", "node")), found):
                if (lead, salt) != key:
                    key, bags_of_lead = (lead, salt), []
                if part == 0:
                    bags_of_lead.append(bag)
                elif any(_alike(b, bag, similarity) for b in bags_of_lead):
                    out.append((lead, node))
        a, b = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = rows.select("lead", "salt", "part", "node", "text").repartition("lead", "salt")
    return dealt.sortWithinPartitions("lead", "salt", "part").mapInArrow(run, f"a {node_kind}, b {node_kind}")


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = WORDS
) -> DataFrame:
    """Groups of near-duplicates: doc_id, n_words, class_id, component_id, kept; one row per row of ``docs``.

    Words are runs of digits, letters and non-ASCII characters in lower case.  A text of
    fewer than ``size`` words has one run, all it has; a text without words (NULL, empty)
    is in no group.  Texts of equal words are one class, ``class_id`` its smallest doc_id;
    classes that share a band and whose runs overlap by ``similarity`` or more are linked,
    ``component_id`` is the smallest doc_id reachable, and that row is ``kept``.  Rows of
    one doc_id are one document: linked if any of its texts is, one fate for all.

    Each band's members are first compared with one lead.  Members of a band that are in
    different components after that are compared with each other, in blocks, pairs of one
    component left out: a link between them would change nothing.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    members = stored(bags(docs, bands, rows, size), "bags")
    worded = members.where("bag_a is not null")
    classes = worded.groupBy("bag_a", "bag_b").agg(F.min("doc_id").alias("class_id"), F.min("bands").alias("bands"))
    classes = stored(classes, "bag-classes")
    nodes = classes.select(F.col("class_id").alias("node"), "bands")
    in_band = nodes.select("node", F.explode("bands").alias("band")).distinct()
    shared = in_band.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    met = stored(in_band.join(shared.select("band", "lead"), "band"), "bands")
    wanted = met.select("node").distinct()
    # a shuffle at every size: what is wanted grows with the table
    text_of = docs.select(F.col("doc_id").alias("node"), "text").join(wanted.hint("shuffle_hash"), "node", "left_semi")
    texts = stored(text_of, "band-texts")
    stars = met.where("node <> lead").select("lead", "node").distinct()
    links = stored(_star_links(stars, texts, kind, similarity, size), "star-links")
    # ids with several texts are in several classes
    same = worded.join(classes.drop("bands"), ["bag_a", "bag_b"]).where("doc_id <> class_id")
    several = worded.groupBy("doc_id").agg(F.countDistinct("bag_a").alias("n")).where("n > 1")
    twice = same.join(several, "doc_id", "left_semi").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    first = components(links.unionAll(twice))
    labelled = met.join(first, "node", "left").select("band", "node", F.coalesce("component", "node").alias("comp"))
    mixed = labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
    rest = stored(labelled.join(mixed, "band", "left_semi").join(nodes.dropDuplicates(["node"]), "node"), "bands-mixed")
    # a band whose members are all alone was compared with its lead only: pairs of two need no more
    pairs = rest.groupBy("band").agg(F.count("*").alias("n")).where("n > 2").select("band")
    rest = rest.join(pairs, "band", "left_semi")
    more = _compared(_blocks(rest, "node", "comp", "bands").join(texts, "node"), kind, similarity, size)
    linked = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more))
    out = members.join(classes.drop("bands"), ["bag_a", "bag_b"], "left")
    out = out.withColumn("class_id", F.coalesce("class_id", "doc_id"))
    out = out.join(linked.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
    component = F.coalesce("component", "class_id")
    return out.select("doc_id", "n_words", "class_id", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))

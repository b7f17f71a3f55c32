"""Spelling variants by blocked Gram matrices of letter counts.

Words one edit apart have letter counts whose squared distance is 1 (a letter more) or 2 (a
letter replaced).  Words are dealt by the counts of a few groups of letters: one edit moves
such a key to itself, up by one in one group, or from one group to another, so a key's
words meet those of a handful of keys of their own length and the next.  In a task finer
keys cut the same way, and one matrix product a fine block gives the squared distances of
its words to all words they could be near; pairs at two or less are compared letter by
letter.

Keys add: the number of a key is the sum of its letters' random numbers, so the keys an edit
away are found by adding.  A key with more words than ``BLOCK`` is cut into blocks, and
blocks meet in pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import LOWER, RangeHash, dropped, mix, runs, slices, stored, text_bytes

SHORTEST = 6
LEAST = 5
RATIO = 5
NOISE = 199
#: Words of a key that one task takes on either side.
BLOCK = 4096
#: Groups of letters that cut a task's words.
FINE = 8
#: Letters by how common they are in European texts; they are dealt to groups in this order.
ORDER = "etaoinsrhldcumfpgwybvkxjqz"
#: Bytes of words beyond this are handled one word at a time.
WIDE = 48

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def _crc32(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of ``size`` bytes of ``data`` from ``start``, carried on from ``state``."""
    out = np.zeros(len(start), np.uint32)
    long = size > WIDE
    for i in np.flatnonzero(long):
        out[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes(), int(state[i]))
    short = np.flatnonzero(~long)
    short = short[np.argsort(-size[short], kind="stable")]
    at, left, crc = start[short], size[short], ~state[short]
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j))  # words longer than j come first
        crc[:n] = _CRC[(crc[:n] ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (crc[:n] >> np.uint32(8))
    out[short] = ~crc
    return out


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of ranges of a buffer."""
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    place = np.arange(ends[-1]) - np.repeat(ends[:-1] - start, size)
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data[place])]).cast(pa.string())


def _counted(part: pa.RecordBatch, shortest: int, noise: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Words of a slice of texts with their numbers: (words, n)."""
    data, offsets = text_bytes(part.column("text"))
    lead = data == 0xC3  # all of U+00C0 to U+00FF
    member = ((data | 32) >= 97) & ((data | 32) <= 122) | lead
    member[1:] |= lead[:-1]
    start, end = runs(member, offsets)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    letters = (end - start) - (leads[end] - leads[start])
    wanted = letters >= shortest
    start, end, letters = start[wanted], end[wanted], letters[wanted]
    if not len(start):
        return
    lower = LOWER[data]
    row = np.searchsorted(offsets, start, side="right") - 1
    ids = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in part.column("doc_id").to_pylist()]
    crc = _crc32(np.array(ids, np.uint32)[row], lower, start, end - start)
    hit = crc % np.uint32(noise) == 0
    cut = []
    for s, e, n, h in zip(start[hit], end[hit], letters[hit], crc[hit]):
        if n > shortest:
            word, at = lower[s:e].tobytes().decode(), int(h) % int(n)
            cut.append(word[:at] + word[at + 1 :])
    if cut:
        yield pa.array(cut, pa.string()), pa.array(np.ones(len(cut), np.int64))
    start, end = start[~hit], end[~hit]
    value = RangeHash(lower)(start, end)
    _, first, n = np.unique(value, return_index=True, return_counts=True)
    yield _gather(lower, start[first], (end - start)[first]), pa.array(n.astype(np.int64))


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, noise: int = NOISE) -> DataFrame:
    """word, n: the words of all texts, ``shortest`` letters and ``least`` occurrences at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for words, n in _counted(part, shortest, noise):
                    yield pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    # a slice's words are counted before they leave Python, a task's before they are shuffled
    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --- letters -------------------------------------------------------------------------------


class Letters:
    """Words as Latin-1 letters: one byte each, ranges of a buffer."""

    def __init__(self, words: pa.Array):
        data, offsets = text_bytes(words)
        lead = data == 0xC3
        kept = np.zeros(len(data) + 1, np.int64)
        np.cumsum(~lead, out=kept[1:])
        after = np.zeros(len(data), bool)
        after[1:] = lead[:-1]
        self.data = np.where(after, data + np.uint8(64), data)[~lead]
        self.start = kept[offsets[:-1]]
        self.size = kept[offsets[1:]] - self.start
        self.n = len(self.size)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Sums over each word of a number per letter value."""
        sums = np.zeros(len(self.data) + 1, values.dtype)
        np.cumsum(values[self.data], out=sums[1:], dtype=values.dtype)
        return sums[self.start + self.size] - sums[self.start]

    def counts(self) -> np.ndarray:
        """(words, letters in use) counts; exact in single precision for words of up to 2,048 letters, else in double."""
        kind = np.float32 if not self.n or self.size.max() <= 2048 else np.float64
        used = np.flatnonzero(np.bincount(self.data, minlength=256))
        rank = np.zeros(256, np.int64)
        rank[used] = np.arange(len(used))
        flat = np.repeat(np.arange(self.n), self.size) * len(used) + rank[self.data]
        return np.bincount(flat, minlength=self.n * len(used)).reshape(self.n, -1).astype(kind)


def _numbers(groups: int) -> np.ndarray:
    return mix(np.arange(1, groups + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * groups & (1 << 64) - 1))


def _values(groups: int) -> np.ndarray:
    """Random number of each letter's group."""
    rank = np.arange(256)
    for i, c in enumerate(ORDER):
        rank[ord(c)] = i
    return _numbers(groups)[rank % groups]


def _steps(groups: int, both: bool) -> np.ndarray:
    """What one edit adds to a key: nothing, a letter, or a letter for another (one way, or both ways)."""
    r = _numbers(groups)
    g, h = np.nonzero(~np.eye(groups, dtype=bool) if both else np.triu(np.ones((groups, groups), bool), 1))
    return np.concatenate((np.zeros(1, np.uint64), r, r[g] - r[h]))


def groups_for(words: int, block: int = BLOCK) -> int:
    """Groups of letters whose keys hold about ``block`` words at most: a group more cuts them by about three."""
    groups = 2
    while groups < 12 and words > 16 * block * 3 ** (groups - 2):
        groups += 1
    return groups


def _dealt(words: DataFrame, groups: int) -> DataFrame:
    """key, side, word, n: each word on the left of its own key and on the right of all keys an edit below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, steps = _values(groups), _steps(groups, both=False)
        for batch in batches:
            if not batch.num_rows:
                continue
            code = Letters(batch.column("word")).per_word(values)
            for side, step in [(0, np.uint64(0)), *((1, s) for s in steps)]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array((code - step).view(np.int64)), pa.array(np.full(len(code), side, np.int8)), *batch.columns],
                    ["key", "side", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(run, "key long, side byte, word string, n long")


def _one_edit(data: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Which pairs of letter ranges (starts a, b; b as long as a or one longer) differ by exactly one edit."""
    good = np.zeros(len(a), bool)
    long = size_a > WIDE
    for i in np.flatnonzero(long):
        x, y = data[a[i] : a[i] + size_a[i]], data[b[i] : b[i] + size_b[i]]
        if len(x) == len(y):
            good[i] = np.count_nonzero(x != y) == 1
        else:
            differs = np.flatnonzero(x != y[:-1])
            good[i] = not len(differs) or bool((x[differs[0] :] == y[differs[0] + 1 :]).all())
    for lo in range(0, len(a), 200_000):
        at = np.arange(lo, min(lo + 200_000, len(a)))
        at = at[~long[at]]
        if not len(at):
            continue
        place = np.arange(int(size_a[at].max()))
        inside = place < size_a[at][:, None]
        top = len(data) - 1
        x = data[np.minimum(a[at][:, None] + place, top)]
        same = x == data[np.minimum(b[at][:, None] + place, top)]
        shifted = x == data[np.minimum(b[at][:, None] + place + 1, top)]
        replaced = (~same & inside).sum(axis=1) == 1
        # a letter more: equal up to some place, and one further from there on
        before = np.where((~same & inside).any(axis=1), (~same & inside).argmax(axis=1), len(place))
        wrong = ~shifted & inside
        after = np.where(wrong.any(axis=1), len(place) - 1 - wrong[:, ::-1].argmax(axis=1), -1)
        good[at] = np.where(size_a[at] == size_b[at], replaced, after < before)
    return good


def _near(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Indices of words of ``left`` and ``right`` that are one edit apart, the right one no shorter."""
    n = len(left)
    if not n or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = Letters(pa.concat_arrays([left, right]))
    code, steps = words.per_word(_values(FINE)), _steps(FINE, both=True)
    counts = words.counts()
    squares = np.einsum("ij,ij->i", counts, counts)
    by_right = n + np.argsort(code[n:], kind="stable")
    right_codes, right_first = np.unique(code[by_right], return_index=True)
    right_end = np.append(right_first[1:], len(by_right))
    by_left = np.argsort(code[:n], kind="stable")
    left_codes, left_first = np.unique(code[by_left], return_index=True)
    left_end = np.append(left_first[1:], n)
    found = []
    for block, s, e in zip(left_codes, left_first, left_end):
        wanted = np.unique(block + steps)
        at = np.minimum(np.searchsorted(right_codes, wanted), len(right_codes) - 1)
        at = at[right_codes[at] == wanted]
        if not len(at):
            continue
        others = np.concatenate([by_right[right_first[i] : right_end[i]] for i in at])
        step = max(1, (1 << 22) // len(others))
        for lo in range(s, e, step):
            own = by_left[lo : min(lo + step, e)]
            distance = squares[own][:, None] + squares[others] - 2 * (counts[own] @ counts[others].T)
            i, j = np.nonzero(distance <= 2.5)
            i, j = own[i], others[j]
            longer = words.size[j] - words.size[i]
            kept = (longer == 0) | (longer == 1)
            i, j = i[kept], j[kept]
            edit = _one_edit(words.data, words.start[i], words.start[j], words.size[i], words.size[j])
            found.append((i[edit], j[edit] - n))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """a, n_a, b, n_b: every two words of ``words`` (word, n; distinct) one edit apart, once.

    A task takes ``block`` words on the left and four times as many on the right at most.
    """
    groups = groups_for(words.count(), block)
    dealt = stored(_dealt(words, groups), "spelling-keys")
    left = F.col("side") == 0
    sizes = dealt.groupBy("key").agg(
        F.ceil(F.count_if(left) / block).cast("int").alias("lefts"),
        F.ceil(F.count_if(~left) / (4 * block)).cast("int").alias("rights"),
    )
    # a key without left words has nothing to compare: its right words have keys of their own
    both = dealt.join(sizes.where("lefts > 0"), "key")
    own = F.pmod(F.xxhash64("word"), F.when(left, F.col("lefts")).otherwise(F.col("rights"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(left, F.col("rights")).otherwise(F.col("lefts")) - 1))
    both = both.select("key", "side", "word", "n", own.alias("own"), other.alias("other"))
    low, high = (F.when(side, F.col("own")).otherwise(F.col("other")) for side in (left, ~left))
    keys = ["key", "low", "high"]
    rows = both.select("key", low.alias("low"), high.alias("high"), "side", "word", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(group: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(group)
            side = table.column("side").to_numpy()
            one, two = (table.filter(pa.array(side == i)).select(["word", "n"]).combine_chunks() for i in (0, 1))
            one, two = (pa.RecordBatch.from_arrays([_flat(t.column(c)) for c in ("word", "n")], ["word", "n"]) for t in (one, two))
            i, j = _near(one.column("word"), two.column("word"))
            one, two = one.take(pa.array(i)), two.take(pa.array(j))
            if len(i):
                # words of one key are on both sides: their pairs count where the left one is the smaller
                a, b = (Letters(t.column("word")).per_word(_values(groups)) for t in (one, two))
                once = pa.array(a != b) if (a != b).all() else pc.or_(pa.array(a != b), pc.less(one.column("word"), two.column("word")))
                one, two = one.filter(once), two.filter(once)
            return pa.RecordBatch.from_arrays([*one.columns, *two.columns], ["a", "n_a", "b", "n_b"])

        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in keys]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                if e == s:
                    continue
                this = tuple(c[s] for c in columns)
                if this != key and held:
                    yield settle(held)
                    held = []
                key = this
                held.append(batch.slice(s, e - s))
        if held:
            yield settle(held)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a string, n_a long, b string, n_b long")


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


# --- groups --------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached by following forms (word, form).  Paths double in length with every step."""
    paths = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = paths.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = stored(after, "spelling-roots")
        dropped(paths)
        paths = after.drop("moved")
        if not after.where("moved").limit(1).count():
            return paths


def spelling_groups(
    docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, noise: int = NOISE, block: int = BLOCK
) -> DataFrame:
    """Words of all texts and their common spelling: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters (A to Z, U+00C0 to U+00FF) of whole texts, A to Z in
    lower case, ``shortest`` letters and ``least`` occurrences at least.  Where ``noise``
    divides the CRC-32 of ``<doc_id>:<word>`` the word loses a letter first.  Two words are
    near if one inserted, deleted or replaced letter tells them apart.  ``form`` is the near
    word of largest n (of equals the smallest), NULL unless its n is ``ratio`` times the
    word's; ``root`` is the last word that forms lead to, the word itself without any.

    A NULL text has no words; a NULL doc_id is spelled as nothing.  Repeated rows count as
    often as they are there.  An empty table gives no rows; other columns are not read.
    ``ratio`` is above 1, so forms never lead in a circle.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = stored(vocabulary(docs, shortest, least, noise), "spelling-words")
    pairs = stored(near_pairs(words, block), "spelling-pairs")
    both = pairs.unionAll(pairs.select(F.col("b"), "n_b", "a", "n_a")).toDF("word", "n", "other", "other_n")
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.less")).alias("n"))).alias("f"),
    )
    known = stored(known.select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n")), "spelling-forms")
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Repeated byte strings by a logarithmic family of suffix arrays.

A string of ``length`` bytes that starts in two places is found through its *anchor*: the
place in the string's first half or so whose following bytes have the least hash.  The
anchor depends on the string alone, so both copies have it at the same offset, and the
suffixes at anchors (about one in a hundred bytes) stand for all suffixes.  A suffix array
here is the list of these suffixes ordered by a fingerprint of their leading bytes, which
puts equal leading bytes next to each other; ordering them by the bytes would say no more
about equality and would carry the bytes along.

New batches of texts get a suffix array of their own.  It is merge-scanned against each
level of the index (tables bucketed and sorted by the fingerprint, so a scan is a merge of
sorted files) for suffixes whose leading bytes are known, and against itself.  It then
becomes a level; two levels of equal size merge into one of twice the size.

Long matches are settled on the suffixes that the scans found: where the whole stretch
around an anchor is repeated, all its strings are; else its strings are compared with those
of its fingerprint, by 128 bits of hash: in one task while they are few, dealt by string
where they are many.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.llm.common import RangeHash, dropped, mix, slices, stored, text_bytes
from gaugewell.session import scratch_path

LENGTH = 400
BATCHES = 4
GRAM = 16


def _reach(length: int) -> int:
    """Number of places in which a string's anchor is looked for."""
    return max(1, min(length * 3 // 5, length - GRAM + 1))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by minima from the left and from the right of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    padded = np.concatenate((values, np.full(pad, np.iinfo(values.dtype).max, values.dtype))).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with the same anchor: (row, anchor, first string, last string, core, whole).

    Places are in the buffer.  ``core`` hashes the bytes that all strings with this anchor
    share, ``whole`` all bytes of the run's strings together with the anchor's place in them.
    """
    reach, gram, n = _reach(length), min(GRAM, length), len(data)
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    hashes = RangeHash(data)
    at = np.arange(n - gram + 1)
    value = hashes(at, at + gram)
    # leftmost of equal hashes: the place breaks ties
    value = (value & np.uint64(0xFFFFFFFF << 31 & (1 << 64) - 1)) | at.astype(np.uint64)
    anchor = (_least(value, reach) & np.uint64((1 << 31) - 1)).astype(np.int64)
    start = np.arange(len(anchor))
    row = np.searchsorted(offsets, start, side="right") - 1
    fits = start + length <= offsets[row + 1]
    start, anchor, row = start[fits], anchor[fits], row[fits]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1 if len(first) else first
    lo, hi, at, row = start[first], start[last], anchor[first], row[first]
    core = hashes(at, at + length - reach + 1)
    whole = mix(hashes(lo, hi + length) + mix((at - lo + 1).astype(np.uint64)))
    return row, at, lo, hi, core, whole


#: What a task makes of a slice of texts: the bytes that strings are looked for in, and where each row's start.
Coder = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def _plain(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(part.column("text"))


def suffixes(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, coder: Coder = _plain, shortest: int | None = None) -> DataFrame:
    """The suffixes at anchors of all texts: doc_id, key (hash of id and text), at, back, fore, core, whole, batch.

    ``at`` is the anchor's byte, its strings start at ``at - back`` to ``at - back + fore``.
    Texts of fewer than ``shortest`` bytes hold no string.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, "text"):
                data, offsets = coder(part)
                row, at, lo, hi, core, whole = anchor_runs(data, offsets, length)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(taken),
                        part.column("key").take(taken),
                        pa.array(at - offsets[row]),
                        pa.array((at - lo).astype(np.int32)),
                        pa.array((hi - lo).astype(np.int32)),
                        pa.array(core.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        part.column("batch").take(taken),
                    ],
                    ["doc_id", "key", "at", "back", "fore", "core", "whole", "batch"],
                )

    keyed = _keyed(docs).withColumn("batch", F.pmod("key", F.lit(batches)).cast("int"))
    return keyed.where(F.octet_length("text") >= (shortest or length)).mapInArrow(
        run, f"doc_id {kind}, key long, at long, back int, fore int, core long, whole long, batch int"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def _of_row(keyed: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of a keyed frame with what was found for their id and key; a NULL id is a value like others."""
    found = found.withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    same = keyed["doc_id"].eqNullSafe(found["found_id"]) & (keyed["key"] == found["found_key"])
    return keyed.join(found, same, how).drop("found_id", "found_key")


class SuffixIndex:
    """Levels of sorted suffix fingerprints; ``add`` scans a batch against all levels and then takes it in.

    Level i holds 2^i batches, at most one level of each size.  Levels are tables in the
    shared folder, bucketed and sorted by fingerprint.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}

    def _write(self, entries: DataFrame) -> str:
        name = f"suffixes_{uuid.uuid4().hex}"
        counted = entries.groupBy("core").agg(F.sum("n").alias("n"))
        spread = counted.repartition(self.buckets, "core")
        path = scratch_path(self.spark, "suffix-level")
        spread.write.bucketBy(self.buckets, "core").sortBy("core").option("path", path).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        table = self.spark.table(name)
        self.spark.sql(f"SELECT 1 FROM {name} LIMIT 0")
        dropped(table)
        self.spark.sql(f"DROP TABLE {name}")

    def add(self, batch: DataFrame) -> DataFrame:
        """Fingerprints (core) of the batch's suffixes that are repeated in it or known to a level."""
        array = self._write(batch.select("core", F.lit(1).cast("long").alias("n")))
        own = self.spark.table(array)
        found = own.where("n > 1").select("core")
        for level in sorted(self.levels):
            found = found.unionAll(own.join(self.spark.table(self.levels[level]).select("core").hint("merge"), "core").select("core"))
        found = stored(found.distinct(), "suffix-matches")
        size = 0
        while size in self.levels:
            other = self.levels.pop(size)
            merged = self._write(self.spark.table(array).unionAll(self.spark.table(other)))
            self._drop(array)
            self._drop(other)
            array, size = merged, size + 1
        self.levels[size] = array
        return found

    def close(self) -> None:
        for name in self.levels.values():
            self._drop(name)
        self.levels = {}


#: Stretches around one fingerprint that a task compares at once; a fingerprint with more goes string by string.
TOGETHER = 4096


def _stretches(docs: DataFrame, runs: DataFrame, length: int, coder: Coder) -> DataFrame:
    """doc_id, key, lo, back, core, many, stretch: the bytes of the strings of each given run."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = runs.groupBy("doc_id", "key").agg(F.collect_list(F.struct("at", "back", "fore", "core", "many")).alias("runs"))
    joined = _of_row(_keyed(docs), lists.hint("shuffle_hash")).select("doc_id", "key", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = coder(part)
                lists = part.column("runs")
                flat = lists.flatten()
                at, back, fore, core, many = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(5))
                row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                lo = at - back
                whole, starts = data.tobytes(), offsets[row] + lo
                sizes = fore.astype(np.int64) + length
                for s in range(0, len(row), 2000):
                    e = s + 2000
                    cut = [whole[a : a + n] for a, n in zip(starts[s:e].tolist(), sizes[s:e].tolist())]
                    taken = pa.array(row[s:e])
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(taken), part.column("key").take(taken), pa.array(lo[s:e]),
                            pa.array(back[s:e]), pa.array(core[s:e]), pa.array(many[s:e]), pa.array(cut, pa.binary()),
                        ],
                        ["doc_id", "key", "lo", "back", "core", "many", "stretch"],
                    )

    return joined.mapInArrow(run, f"doc_id {kind}, key long, lo long, back int, core long, many boolean, stretch binary")


def _string_hashes(stretches: DataFrame, length: int) -> DataFrame:
    """core, back (anchor's offset in a string), string (hash), and where: every string of the given stretches."""
    kind = stretches.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "stretch"):
                data, offsets = text_bytes(part.column("stretch"))
                lo, back, core = (part.column(c).to_numpy() for c in ("lo", "back", "core"))
                count = np.diff(offsets) - length + 1
                which = np.repeat(np.arange(len(count)), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                place = offsets[which] + step
                string = RangeHash(data)(place, place + length)
                taken = pa.array(which)
                for s in range(0, len(which), 500_000):
                    e = s + 500_000
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(taken[s:e]),
                            part.column("key").take(taken[s:e]),
                            pa.array((lo[which] + step)[s:e]),
                            pa.array(core[which][s:e]),
                            pa.array((back[which] - step)[s:e].astype(np.int32)),
                            pa.array(string[s:e].view(np.int64)),
                        ],
                        ["doc_id", "key", "start", "core", "back", "string"],
                    )

    return stretches.select("doc_id", "key", "lo", "back", "core", "stretch").mapInArrow(
        run, f"doc_id {kind}, key long, start long, core long, back int, string long"
    )


def _stretch_spans(stretches: DataFrame, length: int) -> DataFrame:
    """doc_id, key, lo, hi: repeated strings of the given stretches, compared fingerprint by fingerprint.

    The bytes of each run's strings go to the task of its fingerprint (core), which holds
    ``TOGETHER`` stretches at most, each shorter than two strings.
    """
    kind = stretches.schema["doc_id"].dataType.simpleString()
    rows = stretches.select("doc_id", "key", "lo", "back", "core", "stretch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(group: pa.Table) -> pa.RecordBatch:
            data, offsets = text_bytes(group.column("stretch").combine_chunks())
            back = group.column("back").to_numpy().astype(np.int64)
            count = np.diff(offsets) - length + 1
            which = np.repeat(np.arange(len(count)), count)
            step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            place = offsets[which] + step
            string = RangeHash(data)(place, place + length) + mix((back[which] - step + 1).astype(np.uint64))
            _, inverse, n = np.unique(string, return_inverse=True, return_counts=True)
            twice = np.flatnonzero(n[inverse] > 1)
            first = np.ones(len(twice), bool)
            first[1:] = (np.diff(twice) != 1) | (np.diff(which[twice]) != 0)
            a = np.flatnonzero(first)
            b = np.append(a[1:], len(twice)) - 1 if len(a) else a
            row = which[twice[a]]
            start = group.column("lo").to_numpy()[row]
            taken = group.select(["doc_id", "key"]).take(pa.array(row)).combine_chunks()
            columns = [taken.column(c).combine_chunks() for c in ("doc_id", "key")]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(start + step[twice[a]]), pa.array(start + step[twice[b]])], ["doc_id", "key", "lo", "hi"]
            )

        core, held = None, []
        for batch in batches:
            cores = batch.column("core").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cores)) + 1).tolist(), len(cores)]
            for s, e in zip(cuts, cuts[1:]):
                if e > s and cores[s] != core:
                    if held:
                        yield settle(pa.Table.from_batches(held))
                    core, held = cores[s], []
                if e > s:
                    held.append(batch.slice(s, e - s))
        if held:
            yield settle(pa.Table.from_batches(held))

    dealt = rows.repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, f"doc_id {kind}, key long, lo long, hi long")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, coder: Coder = _plain, shortest: int | None = None
) -> DataFrame:
    """Where repeated strings start: doc_id, key, lo, hi (first and last start of a run of repeated strings)."""
    all_runs = stored(suffixes(docs, length, batches, coder, shortest), "suffixes")
    index = SuffixIndex(docs.sparkSession)
    cores = None
    for i in range(batches):
        found = index.add(all_runs.where(F.col("batch") == i))
        cores = found if cores is None else cores.unionAll(found)
    # written once: classes and spans both read it.  Fingerprints found in several batches are there several times:
    # with an aggregate between, the rows of a hot one could not be split in the join
    known = stored(all_runs.join(cores, "core", "left_semi").drop("batch"), "suffixes-known")
    index.close()
    dropped(all_runs)
    classes = known.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "at", "back", "fore")).alias("one"))
    classes = stored(classes, "suffix-classes")
    repeated = classes.where("n > 1").select("core", "whole")
    whole = known.join(repeated, ["core", "whole"], "left_semi")
    whole = whole.select("doc_id", "key", (F.col("at") - F.col("back")).alias("lo"), (F.col("at") - F.col("back") + F.col("fore")).alias("hi"))
    # strings of classes that are not repeated as a whole, and of one of each class that they could meet
    per = classes.groupBy("core").agg(F.count("*").alias("classes"), F.count_if(F.col("n") == 1).alias("lone"))
    per = per.where("classes > 1 and lone > 0").select("core", (F.col("classes") > TOGETHER).alias("many"))
    # texts move once for both ways of comparing, which read the bytes cut out of them
    stretches = stored(_stretches(docs, classes.join(per, "core").select("one.*", "core", "many"), length, coder), "suffix-stretches")
    used = [known, classes, stretches]
    single = _stretch_spans(stretches.where("not many"), length)
    many = stretches.where("many")
    if many.limit(1).count():
        strings = stored(_string_hashes(many, length), "strings")
        used.append(strings)
        same = strings.groupBy("core", "back", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        hot = strings.join(same, ["core", "back", "string"], "left_semi")
        single = single.unionAll(hot.select("doc_id", "key", F.col("start").alias("lo"), F.col("start").alias("hi")))
    spans = stored(whole.unionAll(single), "spans")
    for done in used:
        dropped(done)
    return spans


def _covered(lo: list[int], hi: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by strings that start in [lo, hi]."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo, hi)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def drop_repeats(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """Take out every byte covered by a ``length``-byte string that also starts elsewhere.

    doc_id, n_bytes, removed array<struct<lo, hi>> (bytes), kept (binary); one row per row
    of ``docs``.  Texts are their UTF-8 bytes, NULL is empty; texts shorter than
    ``length`` lose nothing; rows of equal id, or of none, are texts of their own, so equal
    rows lose all they have.  Touching ranges are one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(docs, length, batches)
    # runs of neighbouring starts first, so that a text's list has one entry per stretch
    lists = spans.distinct().groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = _of_row(_keyed(docs), lists, "left").select("doc_id", "text", "spans")
    removed_type = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                whole = data.tobytes()
                removed, kept = [], []
                for i, found in enumerate(part.column("spans").to_pylist()):
                    text = whole[offsets[i] : offsets[i + 1]]
                    out = _covered([s["lo"] for s in found], [s["hi"] for s in found], length) if found else []
                    left, at = [], 0
                    for lo, hi in out:
                        left.append(text[at:lo])
                        at = hi
                    kept.append(b"".join([*left, text[at:]]))
                    removed.append([{"lo": lo, "hi": hi} for lo, hi in out])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, removed_type), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "removed", "kept"],
                )

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, removed array<struct<lo:long,hi:long>>, kept binary")


# --- runs of words -------------------------------------------------------------------------

#: Bytes that stand for a word: its hash.
CODE = 8


def _spaces(data: np.ndarray) -> np.ndarray:
    """Whether each byte is white space or part of it: that of ASCII, U+0085, U+00A0, U+2000 to U+200A, 2028, 2029, 202F, 205F, 3000."""
    space = ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 32))
    if len(data) < 2 or data.max() < 0xC2:
        return space
    one = np.append(data[1:], np.uint8(0))
    two = np.append(data[2:], np.zeros(2, np.uint8))
    pair = (data == 0xC2) & ((one == 0x85) | (one == 0xA0))
    punctuation = (data == 0xE2) & (one == 0x80) & ((two >= 0x80) & (two <= 0x8A) | np.isin(two, (0xA8, 0xA9, 0xAF)))
    triple = punctuation | (data == 0xE2) & (one == 0x81) & (two == 0x9F) | (data == 0xE3) & (one == 0x80) & (two == 0x80)
    for width, at in ((2, np.flatnonzero(pair)), (3, np.flatnonzero(triple))):
        for i in range(width):
            space[at + i] = True
    return space


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the number of the first word of each row, and one more.

    A word is what lies between white space; kana and ideographs, which are written without it, are words each.
    """
    n = len(data)
    member = ~_spaces(data)
    one = np.append(data[1:], np.uint8(0))[:n]
    sign = np.flatnonzero((data >= 0xE4) & (data <= 0xE9) | (data == 0xE3) & (one >= 0x81))
    first = np.zeros(n + 3, bool)
    first[offsets] = first[sign] = first[sign + 3] = True
    before = np.concatenate(([False], member[:-1]))[:n]
    after = np.concatenate((member[1:], [False]))[:n]
    starts = np.flatnonzero(member & (~before | first[:n]))
    ends = np.flatnonzero(member & (~after | first[1 : n + 1])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _word_codes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text's words one after another, as bytes."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, first = words(data, offsets)
    return RangeHash(data)(starts, ends).view(np.uint8), first * CODE


def drop_repeated_words(docs: DataFrame, n_words: int, batches: int = BATCHES) -> DataFrame:
    """Take out every word covered by a run of ``n_words`` words that also starts elsewhere.

    doc_id, text, cut (whether anything was taken); one row per row of ``docs``.  Words are
    equal byte for byte, whatever white space lies between them; that around a run stays.
    NULL is empty; rows of equal id, or of none, are texts of their own.

    A word is its hash here, so runs of words are strings of bytes of one length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    length = n_words * CODE
    # a word has a byte at least
    spans = repeated_spans(docs, length, batches, _word_codes, n_words)
    lists = spans.distinct().groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = _of_row(_keyed(docs), lists, "left").select("doc_id", "text", "spans")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                starts, ends, first = words(data, offsets)
                whole = data.tobytes()
                texts, cut = [], []
                for i, found in enumerate(part.column("spans").to_pylist()):
                    left, at = [], offsets[i]
                    for lo, hi in _covered([s["lo"] for s in found], [s["hi"] for s in found], length) if found else []:
                        left.append(whole[at : starts[first[i] - -lo // CODE]])
                        at = ends[first[i] + hi // CODE - 1]
                    cut.append(bool(left))
                    texts.append(b"".join([*left, whole[at : offsets[i + 1]]]).decode())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), pa.array(cut)], ["doc_id", "text", "cut"])

    return joined.mapInArrow(run, f"doc_id {kind}, text string, cut boolean")


def digest(kept: bytes) -> str:
    return sha256(kept).hexdigest()

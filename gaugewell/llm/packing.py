"""Packing by cutting-stock column generation.

Documents become token ids with a closing id.  Stretches of a whole sequence are sequences
of their own; what is left of a document is an *item* shorter than a sequence.  The
histogram of item lengths is the order list of a cutting-stock problem:

* a linear program over patterns (multisets of lengths that fit a sequence) asks for the
  fewest sequences.  Its columns come from a knapsack dynamic program that prices lengths with
  duals: first with length / size, at which patterns without an unused place are the best
  there are and meet nearly all of a large demand; what they leave is solved by the simplex
  method with its own duals;
* solutions are rounded down, so whole patterns are used a whole number of times;
* items are ranked within their length and dealt to the patterns' places by rank.

What rounding leaves over fills the few unused places and is then laid end to end and cut
at sequence edges, the tail at powers of two, so nothing is padded and few documents are cut.

Only the histogram (one count per length) reaches the driver; ranks are counts per input
part and length, summed by Spark.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugewell.llm.common import slices, stored

SEQUENCE = 2048
#: Most places of a pattern that pieces of cut documents fill.
SLACK = 64
END_ID = 1


# --- linear program ------------------------------------------------------------------------


def _fill(lengths: list[int], left: list[int], room: int, below: int) -> list[tuple[int, int]] | None:
    """(index, copies) of lengths before ``below`` that add up to ``room``, at most ``left`` of each, longest first.

    A knapsack by dynamic programming over the sums that can be reached, held as the bits of
    one number; copies are taken in powers of two.
    """
    whole, reached, steps = 1 << room, 1, []
    for i in range(min(below, bisect.bisect_right(lengths, room)) - 1, -1, -1):
        if reached & whole:
            break
        copies, n = min(left[i], room // lengths[i]), 1
        while copies > 0:
            n = min(n, copies)
            steps.append((i, n, reached))
            reached |= (reached << n * lengths[i]) & (2 * whole - 1)
            copies -= n
            n *= 2
    if not reached & whole:
        return None
    found: dict[int, int] = {}
    for i, n, before in reversed(steps):
        if not before >> room & 1:
            found[i] = found.get(i, 0) + n
            room -= n * lengths[i]
    return list(found.items())


def full_patterns(lengths: np.ndarray, demand: np.ndarray, size: int) -> tuple[list[tuple[list[tuple[int, int]], int]], np.ndarray]:
    """Patterns without an unused place, each with how often it is used, and the demand they leave.

    At the duals length / size, which no pattern exceeds, exactly these have a reduced cost of
    0: as long as they meet the demand, primal and dual agree and the program is solved.
    """
    own, left, patterns = lengths.tolist(), demand.tolist(), []
    for i in range(len(own) - 1, -1, -1):
        while left[i]:
            left[i] -= 1
            rest = _fill(own, left, size - own[i], i + 1)
            left[i] += 1
            if rest is None:
                break
            column = dict(rest)
            column[i] = column.get(i, 0) + 1
            times = min(left[k] // n for k, n in column.items())
            for k, n in column.items():
                left[k] -= times * n
            patterns.append((sorted(column.items(), reverse=True), times))
    return patterns, np.array(left, np.int64)


def _price(lengths: np.ndarray, duals: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The pattern of largest dual value, by dynamic programming over capacities."""
    best, choice = np.zeros(size + 1), np.full(size + 1, -1)
    useful = np.flatnonzero(duals > 1e-12)
    own, value = lengths[useful], duals[useful]
    for c in range(1, size + 1):
        k = np.searchsorted(own, c, side="right")
        best[c] = best[c - 1]
        if k:
            found = best[c - own[:k]] + value[:k]
            i = int(np.argmax(found))
            if found[i] > best[c] + 1e-15:
                best[c], choice[c] = found[i], useful[i]
    column, c = np.zeros(len(lengths)), size
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            column[choice[c]] += 1
            c -= lengths[choice[c]]
    return float(best[size]), column


def solve(lengths: np.ndarray, demand: np.ndarray, size: int, tolerance: float = 1e-4, rounds: int = 2000):
    """Patterns (columns), how often each is used, fractions allowed, and a proven bound from below.

    Simplex on the patterns generated so far, from patterns of one length each; a new column
    is priced until the use is within ``tolerance`` of the bound (the dual solution over the
    value of its best pattern, or the tokens over the size).  ``rounds`` columns end it
    too; the solution is feasible after each.
    """
    columns = np.diag((size // lengths).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    x = demand / np.diag(columns)
    least = float((lengths * demand).sum()) / size
    for done in range(1, rounds + 1):
        duals = np.maximum(inverse.sum(axis=0), 0)
        value, column = _price(lengths, duals, size)
        least = max(least, float(demand @ duals) / max(value, 1.0))
        if value <= 1 + 1e-9 or x.sum() <= least * (1 + tolerance):
            break
        some = np.flatnonzero(column)
        step = inverse[:, some] @ column[some]
        able = step > 1e-9
        ratio = np.where(able, x / np.where(able, step, 1), np.inf)
        out = int(np.argmax(np.where(ratio <= ratio.min() + 1e-9, step, 0)))  # of equal ones the safest pivot
        pivot, move = inverse[out] / step[out], x[out] / step[out]
        x = np.maximum(x - move * step, 0)
        x[out] = move
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        columns[:, out] = column
        if done % 500 == 0:  # rounding errors do not add up
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ demand, 0)
    return columns, x, least


# --- plan ----------------------------------------------------------------------------------


@dataclass
class Plan:
    """Places for every rank of every length, in closed form."""

    size: int
    #: Per length: ranks from ``starts[i]`` on go to sequences from ``sequences[i]`` on, at ``offsets[i]``.
    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    dealt: dict[int, int]  # ranks below go to patterns
    pool: dict[int, int]  # token position of a length's first rest
    pool_sequence: int
    pool_tokens: int
    #: Unused places of patterns: pool position, sequence, offset and width of each run of equal ones, and all their tokens.
    gaps: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    gap_tokens: int

    def _cuts(self, position: int, length: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of a stretch of the pool."""
        out, start = [], 0
        laid = self.pool_tokens - self.gap_tokens
        whole = laid // self.size
        while start < length:
            at = position + start - self.gap_tokens
            if at < 0:  # in a gap
                i = int(np.searchsorted(self.gaps[0], position + start, side="right")) - 1
                nth, inside = divmod(position + start - int(self.gaps[0][i]), int(self.gaps[3][i]))
                n = min(int(self.gaps[3][i]) - inside, length - start)
                out.append((start, n, int(self.gaps[1][i]) + nth, int(self.gaps[2][i]) + inside))
                start += n
                continue
            if at // self.size < whole:
                sequence, offset, room = at // self.size, at % self.size, self.size - at % self.size
            else:  # the tail, in sequences of powers of two
                rest, sequence, offset = laid - whole * self.size, whole, at - whole * self.size
                piece = 1 << (rest.bit_length() - 1)
                while offset >= piece:
                    offset -= piece
                    rest -= piece
                    sequence += 1
                    piece = 1 << (rest.bit_length() - 1)
                room = piece - offset
            n = min(room, length - start)
            out.append((start, n, self.pool_sequence + sequence, offset))
            start += n
        return out

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the item of this length and rank; several where it is cut."""
        if length == self.size:
            return [(0, length, rank, 0)]
        if rank < self.dealt.get(length, 0):
            starts, sequences, offsets = self.places[length]
            i = int(np.searchsorted(starts, rank, side="right")) - 1
            return [(0, length, int(sequences[i]) + rank - int(starts[i]), int(offsets[i]))]
        return self._cuts(self.pool[length] + (rank - self.dealt.get(length, 0)) * length, length)


def plan_packing(counts: dict[int, int], size: int = SEQUENCE, slack: int = SLACK) -> Plan:
    """A plan for items of the given lengths; patterns with more than ``slack`` places unused go to the pool.

    Unused places of the others are filled by the first tokens of the pool; patterns whose
    places the pool is too small for go to it, those with most unused first.
    """
    whole = counts.get(size, 0)
    items = {k: n for k, n in counts.items() if 0 < k < size and n > 0}
    lengths = np.array(sorted(items), np.int64)
    demand = np.array([items[k] for k in lengths], np.int64)
    patterns, left = full_patterns(lengths, demand, size)
    asked = np.flatnonzero(left)
    gaps: list[tuple[int, list[tuple[int, int]], int]] = []
    if len(asked):
        columns, x, _ = solve(lengths[asked], left[asked], size)
        for j in np.argsort(-x, kind="stable"):
            column = [(int(asked[i]), int(columns[i, j])) for i in np.flatnonzero(columns[:, j])[::-1]]
            times = min(int(np.floor(x[j] + 1e-6)), *(int(left[i]) // n for i, n in column))
            gap = size - sum(int(lengths[i]) * n for i, n in column)
            if times > 0 and gap <= slack:
                gaps.append((gap, column, times))
                for i, n in column:
                    left[i] -= times * n
    gaps.sort(key=lambda g: g[0])
    free = sum(gap * times for gap, _, times in gaps)
    tokens = int((lengths * left).sum())
    while free > tokens:
        gap, column, times = gaps.pop()
        back = min(times, -(-(free - tokens) // size))
        free -= gap * back
        tokens += (size - gap) * back
        for i, n in column:
            left[i] += back * n
        if times > back:
            gaps.append((gap, column, times - back))
    found: dict[int, list[tuple[int, int, int]]] = {}
    dealt: dict[int, int] = {}
    sequence, filled, at = whole, [], 0
    for gap, column, times in [(0, *p) for p in patterns] + gaps:
        offset = 0
        for i, n in column:
            k = int(lengths[i])
            for _ in range(n):
                found.setdefault(k, []).append((dealt.get(k, 0), sequence, offset))
                dealt[k] = dealt.get(k, 0) + times
                offset += k
        if gap:
            filled.append((at, sequence, offset, gap))
            at += gap * times
        sequence += times
    pool, position = {}, 0
    for k in lengths[::-1].tolist():
        pool[k] = position
        position += (items[k] - dealt.get(k, 0)) * k
    places = {k: tuple(np.array(v, np.int64).T) for k, v in found.items()}
    return Plan(size, places, dealt, pool, sequence, position, tuple(np.array(filled, np.int64).reshape(-1, 4).T), at)


# --- tokens --------------------------------------------------------------------------------


# Fixed value: the split pattern of the byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of whole texts, as bytes of unsigned 16-bit ids.

    The tokenizer's own vocabulary is read into a faster encoder of the same ids; texts
    that hold a special token's name go to the tokenizer itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in self.specials}
        self.encoding = tiktoken.Encoding("ids", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, "<u2").tobytes()


def tokenized(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE) -> DataFrame:
    """Ids of every row with its place in the input: part, row, doc_id, ids, tokens, whole_rank, rest_rank.

    ``whole_rank`` counts the whole sequences in rows before it in its part, ``rest_rank``
    the rows before it whose rest has the same length.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    closing = np.array([END_ID], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen, row = np.zeros(size + 1, np.int64), 0
        for batch in batches:
            for piece in slices(batch, "text"):
                ids = [encode(t or "") + closing for t in piece.column("text").to_pylist()]
                tokens = [len(i) // 2 for i in ids]
                whole, rest = [], []
                for n in tokens:
                    whole.append(int(seen[size]))
                    seen[size] += n // size
                    rest.append(int(seen[n % size]))
                    seen[n % size] += n % size > 0
                rows = np.arange(row, row + len(ids)) + (part << 33)
                row += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(rows),
                        piece.column("doc_id"),
                        pa.array(ids, pa.binary()),
                        pa.array(tokens, pa.int64()),
                        pa.array(whole, pa.int64()),
                        pa.array(rest, pa.int64()),
                    ],
                    ["part", "row", "doc_id", "ids", "tokens", "whole_rank", "rest_rank"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"part int, row long, doc_id {kind}, ids binary, tokens long, whole_rank long, rest_rank long"
    )


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, slack: int = SLACK) -> DataFrame:
    """Pieces of all documents, packed: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's ids as unsigned little-endian 32-bit numbers.  A NULL or empty
    text is the closing id alone; rows of equal id are documents of their own; an empty
    table has no pieces.  Every id lies in exactly one piece, the offsets of a sequence
    have no gap, and sequences are full or of a power of two.
    """
    tokens = stored(tokenized(docs, tokenizer_path, size), "packing-tokens")
    narrow = tokens.select("part", "row", "tokens", "whole_rank", "rest_rank")
    items = narrow.select(
        "part", "row",
        F.explode(
            F.array(
                F.struct(F.lit(size).cast("long").alias("length"), F.col("whole_rank").alias("rank"), F.floor(F.col("tokens") / size).alias("n")),
                F.struct((F.col("tokens") % size).alias("length"), F.col("rest_rank").alias("rank"), (F.col("tokens") % size > 0).cast("long").alias("n")),
            )
        ).alias("i"),
        (F.floor(F.col("tokens") / size) * size).alias("whole_tokens"),
    ).select("part", "row", "i.*", "whole_tokens").where("n > 0")
    per_part = items.groupBy("part", "length").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = stored(per_part.select("part", "length", "n", F.coalesce(before, F.lit(0)).alias("base")), "packing-bases")
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(counts, size, slack)
    ranked = items.drop("part").withColumn("part", F.shiftright("row", 33).cast("int")).join(bases.drop("n"), ["part", "length"])
    ranked = ranked.select("row", "length", (F.col("rank") + F.col("base")).alias("rank"), "n", "whole_tokens")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, length, rank, n, whole in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if length == size:
                    out += [(row, j * size, size, rank + j, 0) for j in range(n)]
                else:
                    out += [(row, whole + start, k, s, o) for start, k, s, o in plan.place(length, rank)]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["row", "start", "length", "sequence_id", "offset"]
            )

    pieces = ranked.mapInArrow(deal, "row long, start long, length long, sequence_id long, offset long")
    joined = tokens.select("row", "doc_id", "ids", F.col("tokens").alias("doc_tokens")).join(pieces.hint("shuffle_hash"), "row")
    cut = F.substring(F.col("ids"), (F.col("start") * 2 + 1).cast("int"), (F.col("length") * 2).cast("int"))
    cut = joined.select("doc_id", "start", "length", cut.alias("ids"), "doc_tokens", "sequence_id", "offset")

    at = cut.columns.index("ids")

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                wide = [np.frombuffer(b.as_buffer(), "<u2").astype("<u4").tobytes() for b in part.column("ids")]
                yield part.set_column(at, "ids", pa.array(wide, pa.binary()))

    return cut.mapInArrow(widen, cut.schema)

"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may differ from a passage by e = floor(rate * n) edits.  Cut into
e + 1 pieces, at least one piece is untouched in any such passage, so exact hits of the
pieces (one automaton for all pieces) are the only places to look at.  Each place is
verified by Myers' bit-parallel distance of the whole item against the text around it.
Nothing is lost: the hits are a superset of all matches.

Texts are compared in lower case with white space runs as one space.  Items go to the tasks
in blocks of bounded size, one pass over the documents each: driver and tasks hold one block
at a time however long the benchmark is, and what a pass found is written before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import dropped, slices, stored

ERROR_RATE = 0.05
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces that cover the item, as (offset, piece); sizes differ by one at most."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    """Myers' character masks: bit i is set where the item has the character at i."""
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def myers(peq: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of an item to any substring of ``text`` and the first end of one, if at most ``most``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for end, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
    return best


class Matcher:
    """All items of a block, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(item_id, text, budget(text, rate), masks(text)) for item_id, text in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for at, (_, text, errors, _) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                found.setdefault(piece, []).append((at, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, owners)
        if found:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of every item that the normalised text holds."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, owners in self.automaton.iter(text):
            for at, into in owners:
                _, item, errors, _ = self.items[at]
                lo = max(0, end + 1 - into - errors)
                hi = min(len(text), end + 1 - into + len(item) + errors)
                known = windows.setdefault(at, [])
                if known and lo <= known[-1][1]:
                    known[-1][1] = max(known[-1][1], hi)
                    known[-1][0] = min(known[-1][0], lo)
                else:
                    known.append([lo, hi])
        out = []
        for at, spans in windows.items():
            item_id, item, errors, peq = self.items[at]
            best = None
            for lo, hi in spans:
                exact = text.find(item, lo, hi)
                found = (0, exact + len(item) - lo) if exact >= 0 else myers(peq, len(item), text[lo:hi], errors)
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], found[1] + lo)
                if best and best[0] == 0:
                    break
            if best:
                out.append((item_id, *best))
        return sorted(out)


def item_blocks(benchmark: DataFrame, most: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of at most ``most`` characters (one item at least); empty ones are no items."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if not text:
            continue
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document the items it holds: doc_id, hits array<struct<item_id, distance, end>>.

    One row per row of ``docs``; no hits is an empty array.  ``end`` counts characters of
    the normalised text.  NULL texts and items are empty and match nothing.  Items of one
    id are looked for one by one.
    """
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    hit = "struct<item_id:long,distance:int,end:int>"
    hit_type = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int32())]))

    def looking(items, names):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate)
            for batch in batches:
                for part in slices(batch, "text"):
                    hits = []
                    for text, before in zip(part.column("text"), part.column("hits")):
                        found = [dict(zip(("item_id", "distance", "end"), h)) for h in matcher(normal(text.as_py()))]
                        hits.append(before.as_py() + found)
                    columns = {"doc_id": part.column("doc_id"), "text": part.column("text"), "hits": pa.array(hits, hit_type)}
                    yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

        return run

    found = docs.select("doc_id", "text", F.expr(f"cast(array() as array<{hit}>)").alias("hits"))
    ddl = {"doc_id": f"doc_id {id_kind}", "text": "text string", "hits": f"hits array<{hit}>"}

    def searched(given: DataFrame, items: list[tuple[int, str]], names: list[str]) -> DataFrame:
        return given.mapInArrow(looking(items, names), ", ".join(ddl[n] for n in names))

    blocks = item_blocks(benchmark, block_chars)
    block, written = next(blocks, None), None
    while block is not None:
        after = next(blocks, None)
        if after is None:
            return searched(found, block, ["doc_id", "hits"])
        found = stored(searched(found, block, ["doc_id", "text", "hits"]), "benchmark-hits")
        if written is not None:
            dropped(written)
        block, written = after, found
    return found.select("doc_id", "hits")

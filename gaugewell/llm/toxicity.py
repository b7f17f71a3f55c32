"""Toxicity: a lexicon trie run through Levenshtein automata, with context windows.

The lexicon is learned from labelled rows: words, and stems with several endings, that
stand in toxic texts far more often than in others.  The trie of its terms is intersected
with Levenshtein automata: a state is a set of (trie node, edits so far), so one run over
a word finds every term within its edit budget.  States are made once and kept, so most
words die after two or three letters.

A hit is judged in its context: inside quotation marks, or after a word that reports
speech, it counts as quotation, else as abuse.  The score is a logistic model of the
counts of both kinds and of the densest window.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import slices

#: Bound of the labelled rows that the model is fitted on.
FIT_ROWS = 20_000
WINDOW = 12
#: Characters before and after a hit in which its quotation marks stand.
QUOTE_REACH = 400
STEMS = (4, 5, 6)
#: Terms known without any label.
SEED = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "loser")
_QUOTES = "\"“”„«»"
_CUES = frozenset("said says called calls quoted quote wrote writes word term".split())
_WORD = re.compile(r"[^\W_]+")


def edits(term: str) -> int:
    """Edit budget of a whole term; short ones must be exact."""
    return 0 if len(term) < 5 else 1


class Lexicon:
    """Terms in a trie, and the determinised product with their Levenshtein automata."""

    def __init__(self, words, stems=(), fuzzy: bool = True):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]  # edit budget of the term that ends at a node
        self.stem: list[bool] = [False]
        self.most: list[int] = [0]  # largest budget below a node
        for term in sorted(words):
            self._add(term, edits(term) if fuzzy else 0, False)
        for term in sorted(stems):
            self._add(term, 0, True)
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.verdict: list[int] = []  # 0 none, 1 exact, 2 misspelled; 3 a stem: any ending
        self.start = self._state({(0, 0)})

    def _add(self, term: str, budget: int, stem: bool) -> None:
        node = 0
        self.most[0] = max(self.most[0], budget)
        for c in term:
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.ends.append(-1)
                self.stem.append(False)
                self.most.append(0)
            node = self.children[node][c]
            self.most[node] = max(self.most[node], budget)
        if stem:
            self.stem[node] = True
        else:
            self.ends[node] = max(self.ends[node], budget)

    def _state(self, positions: set[tuple[int, int]]) -> int:
        """The state of a set of positions, closed under left-out letters; -1 if it is empty."""
        best: dict[int, int] = {}
        todo = list(positions)
        while todo:
            node, e = todo.pop()
            if best.get(node, 99) <= e:
                continue
            best[node] = e
            for child in self.children[node].values():
                if e + 1 <= self.most[child]:
                    todo.append((child, e + 1))
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.states:
            verdict = 0
            for node, e in key:
                if self.stem[node] and e == 0:
                    verdict = 3
                elif self.ends[node] >= e and verdict != 3:
                    verdict = 1 if e == 0 or verdict == 1 else 2
            self.states[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
            self.verdict.append(verdict)
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        into: set[tuple[int, int]] = set()
        for node, e in self.members[state]:
            for letter, child in self.children[node].items():
                if letter == c:
                    into.add((child, e))
                elif e < self.most[child]:
                    into.add((child, e + 1))
            if e < self.most[node]:
                into.add((node, e + 1))
        return self._state(into)

    def look(self, word: str) -> int:
        """0: no term, 1: a term as it is written, 2: misspelled."""
        state = self.start
        for c in word:
            found = self.moves[state].get(c)
            if found is None:
                found = self.moves[state][c] = self._move(state, c)
            if found < 0:
                return 0
            if self.verdict[found] == 3:
                return 1
            state = found
        return self.verdict[state] if self.verdict[state] < 3 else 1


@dataclass
class Model:
    words: list[str] = field(default_factory=lambda: list(SEED))
    stems: list[str] = field(default_factory=list)
    #: Words that the automaton accepts though labelled texts show them to be harmless.
    harmless: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [-3.0, 2.5, 0.5, 1.0])


def features(lexicon: Lexicon, harmless: frozenset, clean: set, bad: dict, text: str) -> tuple[list[float], list]:
    """[1, abuse, quoted, densest window] of a text, and its hits (word number, word, quoted)."""
    lower = text.lower()
    found = set(_WORD.findall(lower))
    for word in found - clean - bad.keys():
        verdict = lexicon.look(word) if word not in harmless else 0
        if verdict:
            bad[word] = verdict
        else:
            clean.add(word)
    if not any(w in bad for w in found):
        return [1.0, 0.0, 0.0, 0.0], []
    hits, recent, abuse, quoted = [], [], 0.0, 0.0
    for number, m in enumerate(_WORD.finditer(lower)):
        word = m[0]
        if word in bad:
            near = max(m.start() - QUOTE_REACH, 0)
            line = lower[max(lower.rfind("\n", near, m.start()) + 1, near) : m.start()]
            inside = sum(line.count(q) for q in _QUOTES) % 2 == 1
            is_quote = inside and any(q in lower[m.end() : m.end() + QUOTE_REACH] for q in _QUOTES) or any(w in _CUES for w in recent[-3:])
            weight = 1.0 if bad[word] == 1 else 0.8
            if is_quote:
                quoted += weight
            else:
                abuse += weight
            hits.append((number, word, is_quote))
        recent = (recent + [word])[-WINDOW:]
    places = [n for n, _, q in hits if not q]
    dense = max((bisect_left(places, a + WINDOW) - i for i, a in enumerate(places)), default=0)
    return [1.0, min(abuse, 6.0), min(quoted, 6.0), float(min(dense, 4))], hits


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn lexicon and weights from labelled rows (doc_id, toxic), at most ``rows`` of them by hash of the id.

    Equal texts count once.  Without toxic rows the seed terms and default weights stay.
    """
    spark = docs.sparkSession
    labelled = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = spark.createDataFrame(
        labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect(), labelled.schema
    )  # bounded by ``rows``: small enough to broadcast
    train = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["text"]).where("text is not null")
    words = train.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))).alias("word"))
    train, words = train.cache(), words.where("length(word) >= 3")
    tally = (F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    total = train.agg(*tally).first()
    if not total["bad"] or total["bad"] == total["n"]:
        train.unpersist()
        return Model()
    base = total["bad"] / total["n"]
    per_word = words.groupBy("word").agg(*tally)
    per_word.cache()
    per_stem = (
        per_word.select(F.explode(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEMS])).alias("word"), "bad", "n")
        .where("word is not null").groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.count("*").alias("forms"), F.max("bad").alias("top"))
        .where("forms >= 4 and top < 0.7 * bad")
    )
    tests = max(per_word.count(), 2)

    def telling(frame: DataFrame) -> list[str]:
        # bad of n draws by chance: n * (relative entropy) bounds the log of the p-value; all terms together below 1 in 100
        q = F.least(F.col("bad") / F.col("n"), F.lit(0.999999))
        surprise = F.col("n") * (q * F.log(q / base) + (1 - q) * F.log((1 - q) / (1 - base)))
        # what the fitted rows hold bounds this list
        chosen = frame.where((q >= 0.9) & (surprise > math.log(tests * 100))).select("word")
        return sorted(r["word"] for r in chosen.collect())

    exact = telling(per_word)
    stems = telling(per_stem)
    known = set(stems)
    stems = [s for s in stems if not any(s[:k] in known for k in STEMS if k < len(s))]
    exact = [w for w in exact if not any(w[:k] in known for k in STEMS)]
    terms = sorted({*exact, *SEED})
    whole = Lexicon(terms, stems)
    common = per_word.where(f"n >= 2 and bad < {0.5} * n").select("word")

    def accepted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([w for w in batch.column("word").to_pylist() if whole.look(w)], pa.string())], ["word"])

    harmless = sorted(r["word"] for r in common.mapInArrow(accepted, "word string").collect())
    model = Model(terms, stems, harmless)
    seen = _run(train.select("doc_id", "text", "toxic"), model, fitted=False).collect()
    x, y = np.array([r["features"] for r in seen]), np.array([r["toxic"] for r in seen], float)
    model.weights = _logistic(x, y).tolist()
    per_word.unpersist()
    train.unpersist()
    return model


def _run(docs: DataFrame, model: Model, fitted: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    weights = np.array(model.weights)
    hit_type = pa.list_(pa.struct([("word", pa.int32()), ("term", pa.string()), ("quoted", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, harmless = Lexicon(model.words, model.stems), frozenset(model.harmless)
        clean: set[str] = set()
        bad: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                both = [features(lexicon, harmless, clean, bad, t.as_py() or "") for t in part.column("text")]
                if len(clean) > 400_000:
                    clean.clear()
                if not fitted:
                    lists = pa.array([f for f, _ in both], pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([lists, part.column("toxic")], ["features", "toxic"])
                    continue
                x = np.array([f for f, _ in both])
                hits = [[dict(zip(("word", "term", "quoted"), h)) for h in found] for _, found in both]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(1 / (1 + np.exp(-x @ weights))), pa.array(hits, hit_type)],
                    ["doc_id", "score", "hits"],
                )

    if not fitted:
        return docs.mapInArrow(run, f"features array<double>, toxic {docs.schema['toxic'].dataType.simpleString()}")
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, hits array<struct<word:int,term:string,quoted:boolean>>"
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score in 0..1, hits (word number, word as written, quoted).

    NULL and empty texts score as texts without a hit.
    """
    return _run(docs, model, fitted=True)

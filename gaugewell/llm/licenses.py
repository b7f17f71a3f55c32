"""License scans: phrases, and templates compiled into token automata.

A template is mandatory wording with two kinds of marked regions: ``[[words]]`` may be
left out, ``{{n}}`` stands for up to n words of any kind (a name, a year).  It compiles
into an automaton over words; a text holds the license where the automaton runs from its
first word to its last, so all mandatory wording is there exactly and in order.  Case,
punctuation and white space do not count.

Base phrases are places where fixed words stand one after another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugewell.llm.common import LOWER, RangeHash, Words, slices

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of public licenses and usual notices, with marked regions: (label, template, weight).
TEMPLATES = (
    ("gpl-notice", "licensed under the gnu general public license [[version {{1}}]]", 0.9),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license as published by the free software foundation "
     "[[either version {{1}} of the license or at your option any later version]]", 1.0),
    ("apache-2.0-notice", "licensed under the apache license version 2 [[0]]", 0.9),
    ("apache-2.0-header", "licensed under the apache license version 2 0 the license you may not use this file except "
     "in compliance with the license you may obtain a copy of the license at {{8}} unless required by applicable law "
     "or agreed to in writing software distributed under the license is distributed on an as is basis without "
     "warranties or conditions of any kind", 1.0),
    ("cc-by-notice", "licensed under [[a]] [[the]] cc by [[nc]] [[sa]] [[nd]] {{1}} 0", 0.9),
    ("cc-by-long-notice", "licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[sharealike]] "
     "[[noderivatives]] {{1}} 0 [[international]] [[license]]", 0.9),
    ("mit-notice", "released under the mit license", 0.9),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
     "and to permit persons to whom the software is furnished to do so subject to the following conditions "
     "[[the above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the software]]", 1.0),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted provided that the above copyright notice and this permission notice appear in all copies", 1.0),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met [[1]] redistributions of source code must retain the above "
     "copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must "
     "reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
     "and or other materials provided with the distribution "
     "[[3 neither the name of {{12}} nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission]]", 1.0),
    ("spdx-tag", "spdx license identifier {{1}}", 0.8),
)
PHRASE_WEIGHT = 0.5
#: Words that say nothing about which template a text may hold; one of them anchors a template only if it has no other.
PLAIN_WORDS = frozenset("a all and any are as at be by copy for free from in is it not of on or that the this to use with you 0 1 2 3".split())


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(RangeHash(LOWER[data])(np.array([0]), np.array([len(data)]))[0])


def _words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Automaton:
    """A template over word hashes: each step is a word, an optional region's entry or a gap of up to n words."""

    def __init__(self, template: str):
        steps: list[tuple] = []
        opened: list[int] = []
        for mark in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template):
            if mark == "[[":
                opened.append(len(steps))
                steps.append(("skip", 0))
            elif mark == "]]":
                steps[opened.pop()] = ("skip", len(steps))
            elif mark.startswith("{{"):
                steps.append(("gap", int(mark[2:-2])))
            else:
                steps += [("word", _word_hash(w)) for w in _words(mark)]
        self.steps = steps
        self.anchor = self._anchor(template)
        self.first = {self.steps[s][1] for s, _ in self._closed({(0, 0)}) if s < len(steps) and steps[s][0] == "word"}

    @staticmethod
    def _anchor(template: str) -> int | None:
        """A word that every accepted text holds: the longest mandatory one that is not plain; None without any word."""
        outside = re.sub(r"\{\{\d+\}\}", " ", template)
        while "[[" in outside:
            shorter = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", outside, flags=re.S)
            if shorter == outside:
                break
            outside = shorter
        words = _words(outside)
        if not words:
            return None
        return _word_hash(max(words, key=lambda w: (w not in PLAIN_WORDS, len(w), w)))

    def _closed(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """States reached without reading: (step, words read in a gap)."""
        todo, seen = list(states), set()
        while todo:
            step, used = todo.pop()
            if (step, used) in seen:
                continue
            seen.add((step, used))
            if step < len(self.steps):
                kind, value = self.steps[step]
                if kind == "skip":
                    todo += [(step + 1, 0), (value, 0)]
                elif kind == "gap":
                    todo.append((step + 1, 0))
        return seen

    def match(self, words: list[int], at: int) -> int | None:
        """End of the longest accepted run of words from ``at``."""
        states, end, done = self._closed({(0, 0)}), None, len(self.steps)
        while True:
            if (done, 0) in states:
                end = at
            if at >= len(words):
                return end
            word, into = words[at], set()
            for step, used in states:
                if step < done:
                    kind, value = self.steps[step]
                    if kind == "word" and value == word:
                        into.add((step + 1, 0))
                    elif kind == "gap" and used < value:
                        into.add((step, used + 1))
            if not into:
                return end
            states, at = self._closed(into), at + 1


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), from whole texts.

    doc_id, n_words, n_base (places of base phrases), first_word, last_word (smallest and
    largest start, NULL without any), base_labels, labels (with those of accepted
    templates; sorted, comma-joined, '' without any), score (0 to 1: how sure that the
    text is under a license), spans array<struct<label, start, end>> of accepted
    templates in words.  NULL texts are empty: no words, score 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = [([np.uint64(_word_hash(w)) for w in phrase.split()], label) for phrase, label in phrases]
        compiled = [(label, Automaton(text), weight) for label, text, weight in templates]
        # rows without a template's anchor cannot hold it; a template without any is run on all
        anchors = np.array([a.anchor for _, a, _ in compiled if a.anchor is not None], np.uint64)
        loose = any(a.anchor is None for _, a, _ in compiled)
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                n, h, rows = part.num_rows, words.hashes, words.rows
                n_base = np.zeros(n, np.int64)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in coded:
                    m = len(h) - len(phrase) + 1
                    if m <= 0:
                        continue
                    at = np.flatnonzero(h[:m] == phrase[0])
                    for j in range(1, len(phrase)):
                        at = at[(h[at + j] == phrase[j]) & (rows[at + j] == rows[at])]
                    row, place = rows[at], at - words.first[rows[at]]
                    n_base += np.bincount(row, minlength=n)
                    np.minimum.at(first, row, place)
                    np.maximum.at(last, row, place)
                    for r in np.unique(row):
                        base[r].add(label)
                spans: list[list[dict]] = [[] for _ in range(n)]
                labels = [set(b) for b in base]
                score = np.where(n_base > 0, PHRASE_WEIGHT, 0.0)
                for r in np.unique(rows if loose else rows[np.isin(h, anchors)]):
                    own = h[words.first[r] : words.first[r + 1]].tolist()
                    has = set(own)
                    for label, automaton, weight in compiled:
                        if automaton.anchor is not None and automaton.anchor not in has:
                            continue
                        at, hit = 0, False
                        while at < len(own):
                            end = automaton.match(own, at) if own[at] in automaton.first else None
                            if end is not None:
                                spans[r].append({"label": label, "start": at, "end": end})
                                hit = True
                            at = max(at + 1, end or 0)
                        if hit:
                            labels[r].add(label)
                            score[r] = 1 - (1 - score[r]) * (1 - weight)
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(n_base),
                        pa.array(first, mask=none),
                        pa.array(last.astype(np.int64), mask=none),
                        pa.array([",".join(sorted(x)) for x in base]),
                        pa.array([",".join(sorted(x)) for x in labels]),
                        pa.array(score),
                        pa.array(spans, span_type),
                    ],
                    names,
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,start:long,end:long>>",
    )



"""Quality by importance resampling.

Two generative models of hashed n-grams are fitted: one on the *target* (rows labelled
good), one on the *raw* text (all rows).  A document's weight is the log of
p_target / p_raw over its n-grams, and the documents are drawn without replacement with
these weights by Gumbel top-k: each weight gets standard Gumbel noise, a function of the
document's id, and the k largest stay.

N-grams are of token shapes, so that the models are dense in any language: a word is its
letter case and length class, a punctuation run its own bytes, a token equal to the one
before a repeat mark.  Both models are sums over all rows; what reaches the driver is one
count per hash bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import (
    BASE,
    IS_WORD,
    RangeHash,
    mix,
    runs,
    schema_of,
    slices,
    stored,
    text_bytes,
    unit_hash,
)

BUCKETS = 4096
SMOOTHING = 2.0
MAX_N = 2
#: Least p_target / p_raw of a document that counts towards the default k.
WORTH = 0.05

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, symbol hash) of every token in order."""
    data, offsets = text_bytes(column)
    word = IS_WORD[data]
    ws, we = runs(word, offsets)
    ps, pe = runs(~word & ~_SPACE[data], offsets)
    starts, ends = np.concatenate((ws, ps)), np.concatenate((we, pe))
    is_word = np.arange(len(starts)) < len(ws)
    order = np.argsort(starts, kind="stable")
    starts, ends, is_word = starts[order], ends[order], is_word[order]
    exact = RangeHash(data)(starts, ends)
    ups = np.concatenate(([0], np.cumsum(_UPPER[data])))
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    size = ends - starts
    n_up, n_digit = ups[ends] - ups[starts], digits[ends] - digits[starts]
    first_up = _UPPER[data[starts]] if len(starts) else n_up
    case = np.select(
        [n_digit == size, n_digit > 0, (n_up == size) & (size > 1), (n_up == 1) & (first_up == 1), n_up > 0],
        [1, 2, 3, 4, 5],
        0,
    )
    shape = mix((case * 64 + np.minimum(size, 24) // 4 + 7).astype(np.uint64) * np.uint64(BASE))
    symbol = np.where(is_word, shape, exact)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    repeated = np.zeros(len(starts), bool)
    # words are compared with the word before, whatever stands between
    at = np.flatnonzero(is_word)
    same = (exact[at[1:]] == exact[at[:-1]]) & (rows[at[1:]] == rows[at[:-1]])
    repeated[at[1:][same]] = True
    symbol[repeated] = np.uint64(0xD1B54A32D192ED03)
    return rows, symbol


def bucket_rows(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of a column of texts, n from 1 to ``MAX_N``."""
    rows, symbols = _tokens(column)
    kept_rows, kept = [rows], [mix(symbols) % np.uint64(buckets)]
    grams = symbols
    for n in range(2, MAX_N + 1):
        grams = grams[:-1] * np.uint64(BASE) + symbols[n - 1 :]
        inside = rows[: len(grams)] == rows[n - 1 :]
        kept_rows.append(rows[: len(grams)][inside])
        kept.append(mix(grams)[inside] % np.uint64(buckets))
    return np.concatenate(kept_rows), np.concatenate(kept).astype(np.int64)


def gram_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of the hashed n-grams of all rows of a one-column frame, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += np.bincount(bucket_rows(part.column("text"), buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets)
    for row in found.collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw per bucket.

    Counts of the target are held against those expected under the raw model, both with
    ``smoothing`` more, so a bucket of few expected counts says little in either direction.
    """
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log(target + smoothing) - np.log(expected + smoothing)


def weigh(docs: DataFrame, ratios: np.ndarray, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of ``carry``, ``log_weight``: the sum of the log ratios over a document's n-grams
    (0 without any), and ``n_grams``."""
    buckets = len(ratios)
    passed = ("doc_id", *(c for c in carry if c != "doc_id"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, found = bucket_rows(part.column("text"), buckets)
                sums = np.bincount(rows, ratios[found], minlength=part.num_rows)
                n = np.bincount(rows, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in passed), pa.array(sums), pa.array(n)], [*passed, "log_weight", "n_grams"]
                )

    given = docs.select(*dict.fromkeys(("doc_id", "text", *passed)))
    return given.mapInArrow(score, f"{schema_of(docs, *passed)}, log_weight double, n_grams long")


def kth_largest(keys: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of a column, exactly: histograms of ever narrower ranges, no sort."""
    lo, hi, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return None
    if k >= n:
        return lo
    left = k  # the wanted value is the left-th largest of those in [lo, hi]
    while lo < hi:
        step = (hi - lo) / bins
        if step <= 0 or lo + step == lo:
            values = keys.where(F.col(column).between(lo, hi)).groupBy(column).count().orderBy(F.desc(column))
            for row in values.toLocalIterator():  # a few neighbouring doubles
                left -= row["count"]
                if left <= 0:
                    return row[column]
        bin_of = F.least(F.floor((F.col(column) - lo) / step), F.lit(bins - 1))
        counts = (
            keys.where(F.col(column).between(lo, hi))
            .groupBy(bin_of.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            .collect()  # one row per bin
        )
        for row in sorted(counts, key=lambda r: -r["bin"]):
            if left <= row["n"]:
                lo, hi = row["lo"], row["hi"]
                break
            left -= row["n"]
    return lo


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, keep: int | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Importance resampling of ``docs`` (doc_id, text) towards ``target`` (text).

    Returns doc_id, n_grams, log_weight, gumbel_key, kept; one row per row of ``docs``, with the
    columns of ``docs`` named in ``carry``, which spares a join when the rows are wanted whole.
    ``keep`` is k; by default the number of rows at least as likely under the target model as
    under the raw model, times ``WORTH``.  A NULL text is empty, an
    empty text has weight 0.  Rows of equal id and text share their key, and rows tied
    with the k-th key all stay.  Without target rows the weights are 0 and all rows stay.
    """
    raw = gram_counts(docs, buckets)
    good = gram_counts(target, buckets)
    ratios = log_ratios(good, raw) if good.sum() else np.zeros(buckets)
    uniform = unit_hash("doc_id")
    weighed = weigh(docs, ratios, carry).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    weighed = stored(weighed, "quality-keys")
    k = keep if keep is not None else weighed.where(F.col("log_weight") >= math.log(WORTH)).count()
    least = kth_largest(weighed, "gumbel_key", k)
    return weighed.withColumn("kept", F.lit(False) if least is None else F.col("gumbel_key") >= least)


def labelled_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of the rows that a label calls good: one shuffle of ids and texts, the same plan at every size."""
    good = labels.where("quality = 1").select("doc_id").distinct().hint("merge")
    return docs.join(good, "doc_id", "left_semi").select("text")

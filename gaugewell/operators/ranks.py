"""Value-ranked metrics: frequent, shortest and longest values, exact distinct.

The values of all columns are counted together by (column, value).  Repeats
fold map-side, so a value that fills a third of the table costs one row per
task, and the shuffle is spread by value, never by column alone.  The k best of
each column are then cut within every partition before the final ranking, which
sees at most k rows per column, ranking and partition.

Long text stays where it is: a value of more than ``LEAD`` characters is shuffled as its
first ``LEAD`` characters, its length and a digest of 128 bits.  Only the k best
are looked up again, by one more scan that finds them by length and lead and then
compares digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugewell.operators.cells import Cells

TOP = 5
#: Characters of a value that stand for it in a shuffle, with a digest where there are more.
LEAD = 64
FREQUENT, SHORTEST, LONGEST = "frequent", "shortest", "longest"
RANKINGS = (FREQUENT, SHORTEST, LONGEST)


def _text_of(cells: Cells) -> Column | None:
    lanes = [F.col(name) for name in cells.text_lanes()]
    return F.coalesce(*lanes) if lanes else None


def _lead(text: Column) -> Column:
    return F.when(F.length(text) > LEAD, F.substring(text, 1, LEAD)).otherwise(text)


def _tail(text: Column) -> Column:
    """What tells longer values of one lead apart, in four bytes of length and the digest; NULL where the lead is all."""
    size = F.lpad(F.hex(F.length(text)), 8, "0")
    return F.when(F.length(text) > LEAD, F.unhex(F.concat(size, F.md5(text))))


def _chars(lead: Column, tail: Column) -> Column:
    """Length of a value from its lead and tail."""
    long = F.conv(F.hex(F.substring(tail, 1, 4)), 16, 10).cast("bigint")
    return F.when(tail.isNotNull(), long).otherwise(F.length(lead).cast("bigint"))


def _length(cells: Cells) -> Column:
    """Length of a counted value of a text column."""
    text = cells.string_lane()
    return F.when(text.isNotNull(), _chars(text, F.col("tail")))


def counted_values(cells: Cells, frame: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL values of every column with their count ``n``.

    Text lanes hold the lead of a value, ``tail`` what a longer one has besides.
    """
    present = (cells.frame if frame is None else frame).where(cells.present())
    text, short = _text_of(cells), cells.text_lanes()
    if text is None:
        counted = present.groupBy("col_id", *cells.keys).agg(F.count(F.lit(1)).alias("n"))
        return counted.withColumn("tail", F.lit(None).cast("binary"))
    leads = [_lead(F.col(k)).alias(k) if k in short else F.col(k) for k in cells.keys]
    keyed = present.select("col_id", *leads, _tail(text).alias("tail"))
    return keyed.groupBy("col_id", *cells.keys, "tail").agg(F.count(F.lit(1)).alias("n"))


def _value_buckets(cells: Cells, k: int) -> DataFrame:
    """The distinct values of each column dealt to 16 k buckets by hash: their number, cells and extremes."""
    values = counted_values(cells)
    bucket = F.pmod(F.xxhash64(*cells.keys, "tail"), F.lit(16 * k)).alias("bucket")
    length = _length(cells)
    return values.groupBy("col_id", bucket).agg(
        F.count(F.lit(1)).alias("values"),
        F.sum("n").alias("cells"),
        F.max("n").alias("most"),
        F.max(length).alias("longest"),
        F.min(length).alias("shortest"),
    )


def distinct_counts(cells: Cells, k: int = TOP) -> DataFrame:
    """Exact number of distinct values per column.

    Also sums ``n``: the plan below the buckets is then that of :func:`ranked_values`
    for the same ``k``, and Spark reuses its shuffles.
    """
    return (
        _value_buckets(cells, k)
        .groupBy("col_id")
        .agg(F.sum("values").alias("number_distinct_values"), F.sum("cells").alias("counted_cells"))
    )


def _kth(name: str, k: int, asc: bool) -> Column:
    return F.get(F.sort_array(F.collect_list(name), asc=asc), F.lit(k - 1))


def value_bounds(cells: Cells, k: int = TOP) -> DataFrame:
    """Counts and lengths that no value among the k best of a column can miss.

    Buckets hold different values, so at least k distinct values are as frequent as the
    k-th largest count of a bucket; so for lengths.  One row per column; a column with
    fewer than k buckets filled has no bounds.  At most 16 k rows per column are gathered.
    """
    return _value_buckets(cells, k).groupBy("col_id").agg(
        _kth("most", k, False).alias("often_from"),
        _kth("longest", k, False).alias("long_from"),
        _kth("shortest", k, True).alias("short_to"),
    )


def length_bounds(cells: Cells, k: int = TOP) -> DataFrame:
    """Lengths no value among the k shortest or k longest of a text column can miss.

    Values are dealt into buckets by hash and each bucket keeps its extreme
    lengths.  Buckets hold different values, so at least k distinct values are as
    long as the k-th longest bucket maximum, and as short as the k-th shortest
    minimum.  One row per column; columns with fewer than k buckets filled have
    no bounds.
    """
    text = cells.string_lane()
    buckets = (
        cells.frame.where(text.isNotNull())
        .select("col_id", F.pmod(F.xxhash64(text), F.lit(16 * k)).alias("bucket"), F.length(text).alias("length"))
        .groupBy("col_id", "bucket")
        .agg(F.max("length").alias("longest"), F.min("length").alias("shortest"))
    )
    # At most 16 k bucket rows per column are gathered here.
    return buckets.groupBy("col_id").agg(
        _kth("longest", k, False).alias("long_from"), _kth("shortest", k, True).alias("short_to")
    )


def _extreme_lengths(cells: Cells, rankings: tuple[str, ...], k: int) -> DataFrame:
    """Cells of text columns that may be among the shortest or longest.

    The bounds have one row per column of the table, so they are broadcast.
    """
    length = F.length(cells.string_lane())
    tests = {
        SHORTEST: length <= F.coalesce("short_to", length),
        LONGEST: length >= F.coalesce("long_from", length),
    }
    wanted = [tests[r] for r in rankings]
    keep = wanted[0] | wanted[1] if len(wanted) == 2 else wanted[0]
    bounded = cells.frame.where(cells.string_lane().isNotNull()).join(
        F.broadcast(length_bounds(cells, k)), "col_id"
    )
    return bounded.where(keep).select("col_id", *cells.keys)


def ranked_values(cells: Cells, rankings: tuple[str, ...] = RANKINGS, k: int = TOP) -> DataFrame:
    """Rows (col_id, ranking, rank, value, n), ``rank`` from 1 to ``k``.

    Frequent: count descending, then value.  Shortest and longest: text columns
    only, distinct values by length, then value.  Values that agree in their first
    ``LEAD`` characters go by their length, then by their digest.

    Counts and lengths are bounded first, so most values are neither printed nor sorted.
    Where lengths alone are asked for, a first scan bounds them, and values in between
    are never shuffled.
    """
    unknown = set(rankings) - set(RANKINGS)
    if unknown or not rankings:
        raise ValueError(f"rankings must be among {RANKINGS}")
    frame = None if FREQUENT in rankings else _extreme_lengths(cells, rankings, k)
    length = _length(cells)
    values = counted_values(cells, frame)
    if frame is None:
        # one row per column of the table
        values = values.join(F.broadcast(value_bounds(cells, k)), "col_id")
        sort_keys = {
            FREQUENT: F.when(F.col("n") >= F.coalesce("often_from", "n"), -F.col("n")),
            SHORTEST: F.when(length <= F.coalesce("short_to", length), length),
            LONGEST: F.when(length >= F.coalesce("long_from", length), -length),
        }
    else:
        sort_keys = {SHORTEST: length, LONGEST: -length}
    values = values.select("col_id", *cells.keys, "tail", "n", *[sort_keys[r].alias(r) for r in rankings])
    # Values are printed when they may be among the best.
    values = values.where(F.coalesce(*rankings).isNotNull()).select(
        "col_id", cells.text().alias("value"), "tail", "n", *rankings
    )
    # One stream for all rankings: the counted values are computed and sorted once.
    identity = ["col_id", "value", "tail", "n"]
    entries = values.unpivot(identity, list(rankings), "ranking", "sort_key").where("sort_key IS NOT NULL")
    best = W.partitionBy("col_id", "ranking").orderBy("sort_key", "value", "tail")
    ranked = entries.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if cells.text_lanes():
        ranked = _with_whole_values(cells, ranked)
    return ranked.select("col_id", "ranking", "rank", "value", "n")


def _with_whole_values(cells: Cells, ranked: DataFrame) -> DataFrame:
    """Ranked values with the whole text in place of the lead.

    At most k rows per column and ranking are looked up, so their leads and tails are
    broadcast.  Cells are found by length and lead; digests are computed of those alone, which
    is why their comparison must not become a key of the join.  Cells of one digest must be
    equal.  Where no value is longer than its lead the second scan falls away.
    """
    text = _text_of(cells)
    long = ranked.where("tail IS NOT NULL").withColumnRenamed("value", "lead")
    long = long.withColumn("chars", _chars(F.col("lead"), F.col("tail")))
    cell = cells.frame.where(F.length(text) > LEAD).select(
        "col_id", text.alias("text"), _lead(text).alias("lead"), F.length(text).cast("bigint").alias("chars")
    )
    met = cell.join(F.broadcast(long), ["col_id", "lead", "chars"])
    same = met.where(F.nullif(F.col("tail"), _tail(F.col("text"))).isNull())
    whole = same.groupBy("col_id", "ranking", "rank", "n").agg(F.min("text").alias("value"), F.max("text").alias("other"))
    one = F.when(F.col("value") == F.col("other"), F.col("value")).otherwise(
        F.raise_error(F.lit("two values of one digest")).cast("string")
    )
    columns = ["col_id", "ranking", "rank", "value", "n"]
    return ranked.where("tail IS NULL").select(columns).unionAll(whole.withColumn("value", one).select(columns))


def ranked_lists(cells: Cells, rankings: tuple[str, ...] = RANKINGS, k: int = TOP) -> DataFrame:
    """One row per column with ``<ranking>_values`` arrays, best first."""
    entry = F.struct("rank", "value")

    def values(ranking: str):
        found = F.sort_array(F.collect_list(F.when(F.col("ranking") == ranking, entry)))
        return F.when(F.size(found) > 0, found["value"]).alias(f"{ranking}_values")

    return ranked_values(cells, rankings, k).groupBy("col_id").agg(*[values(r) for r in rankings])

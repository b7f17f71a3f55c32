"""Row numbers without bringing rows together.

Rows are range-partitioned and sorted, then written with their place in their task.  A
row's number is its place after the rows of all tasks before it: one count per task.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.sources.tables import staged


def numbered(df: DataFrame, *order: str | Column, name: str = "ordinal") -> DataFrame:
    """``df`` with row numbers from 1 in the given order.

    Ties are numbered in any order.  What goes through the driver is a count per task of
    the sort.
    """
    task, place = "_task_", "_place_"
    placed = df.orderBy(*order).select("*", F.spark_partition_id().alias(task), F.monotonically_increasing_id().alias(place))
    placed = staged(placed)
    counts = sorted(placed.groupBy(task).agg(F.count("*"), F.min(place)).collect())
    before = [0, *accumulate(r[1] for r in counts)]
    shifts = [(r[0], n - r[2] + 1) for r, n in zip(counts, before)]
    shift = df.sparkSession.createDataFrame(shifts, f"{task} int, _shift_ long")
    return placed.join(shift, task).withColumn(name, F.col(place) + F.col("_shift_")).drop(task, place, "_shift_")

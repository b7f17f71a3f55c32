"""Counts and statistics of every column, in one scan without a data shuffle.

Cells are grouped by column.  Each task folds its cells into one buffer per
column before anything is exchanged, so a shuffle carries (tasks x columns)
small rows no matter how long the table is or how full one column is.
Readings are projected first and so evaluated once per cell, not per metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.functions.readings import as_date, as_real, as_whole, in_range
from gaugewell.operators.cells import Cells

SECTIONS = ("fill", "integer", "real", "date", "text")


def _count(name: str) -> Column:
    """Count of a reading; a reading no cell fits has no count at all."""
    return F.nullif(F.count(name), F.lit(0).cast("bigint"))


def _numeric(name: str, prefix: str) -> list[Column]:
    return [
        _count(name).alias(f"{prefix}_count"),
        F.max(name).alias(f"{prefix}_max_value"),
        F.min(name).alias(f"{prefix}_min_value"),
        F.avg(name).alias(f"{prefix}_mean"),
        F.stddev_samp(name).alias(f"{prefix}_stddev"),
    ]


def scalar_metrics(
    cells: Cells,
    sections: tuple[str, ...] = SECTIONS,
    int_type: str = "int",
    approx_distinct: bool = False,
    rsd: float = 0.05,
    native_dates: bool = False,
) -> DataFrame:
    """One row per column: ``col_id`` and the metrics of the wanted sections.

    ``native_dates`` counts cells of date and time columns as dates, beside text that reads so.
    """
    unknown = set(sections) - set(SECTIONS)
    if unknown:
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    read = [F.col("col_id")]
    wanted: list[Column] = []
    if "fill" in sections:
        read.append(cells.present().alias("present"))
        wanted += [
            F.count_if("present").cast("bigint").alias("number_non_empty_cells"),
            F.count_if(~F.col("present")).cast("bigint").alias("number_empty_cells"),
        ]
    if "integer" in sections:
        read.append(cells.read(as_whole).alias("whole"))
        wanted += _numeric("as_int", "integer")
    if "real" in sections:
        read.append(cells.read(as_real).alias("as_real"))
        wanted += _numeric("as_real", "real")
    if "date" in sections:
        date = cells.read(lambda c, t: as_date(c, t, True)) if native_dates else as_date(cells.string_lane())
        read.append(date.alias("as_date"))
        wanted += [
            _count("as_date").alias("date_count"),
            F.max("as_date").alias("date_max_value"),
            F.min("as_date").alias("date_min_value"),
        ]
    if "text" in sections:
        read.append(F.length(cells.string_lane()).alias("text_length"))
        wanted += [
            F.count("text_length").alias("string_count"),
            F.avg("text_length").alias("string_average_length"),
        ]
    if approx_distinct:
        # A cell fills one lane only, so the lanes' estimates add up to its column's.
        read += [F.col(k) for k in cells.keys]
        estimate = sum((F.approx_count_distinct(k, rsd) for k in cells.keys), F.lit(0).cast("bigint"))
        wanted.append(estimate.alias("number_distinct_values"))
    rows = cells.frame.select(*read)
    if "integer" in sections:
        rows = rows.withColumn("as_int", in_range(F.col("whole"), int_type))
    return rows.groupBy("col_id").agg(*wanted)

"""The semantic profile: which real-world kinds the cells of a column look like.

All columns are one frame of (column, value) and every detector is counted in
one aggregation, so a run is one scan and one exchange of small rows whatever
the number of columns.  Task-side folding makes a dominant column harmless.

Detectors by a table of names add a scan each: cells no longer than the longest name
are counted by value first, so a value that fills the table is one row a task, and the
counted values are then semi-joined with the names, which Spark broadcasts if they are few.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.functions.detectors import Detector, detectors, named_types
from gaugewell.operators.cells import to_cells
from gaugewell.operators.sample import FRACTION, pilot_sample

NON_EMPTY = "number_of_non_empty_cells"

WEIGHT = "n"


def column_values(df: DataFrame) -> DataFrame:
    """A table as (column_name, value), values as text."""
    cells = to_cells(df)
    return cells.frame.select(
        cells.name_of(F.col("col_id")).alias("column_name"), cells.text().alias("value")
    )


def counted_column_values(df: DataFrame) -> DataFrame:
    """A table as (column_name, value, n), each value of a column once.

    Cells are counted in their native types first, so detectors and printing run
    once per distinct value.  Worth its shuffle for tables, whose columns repeat
    values; for columns of unique long texts use :func:`column_values`.
    """
    cells = to_cells(df)
    counted = cells.frame.groupBy("col_id", *cells.keys).agg(F.count(F.lit(1)).alias(WEIGHT))
    return counted.select(
        cells.name_of(F.col("col_id")).alias("column_name"), cells.text().alias("value"), WEIGHT
    )


def _total(values: DataFrame, test: Column) -> Column:
    """Rows that pass a test; a row counts once, or as often as its weight says."""
    if WEIGHT in values.columns:
        return F.coalesce(F.sum(F.when(test, F.col(WEIGHT))), F.lit(0).cast("bigint"))
    return F.count_if(test).cast("bigint")


def _listed_counts(values: DataFrame, detector: Detector, column: str) -> DataFrame:
    """(column, <detector>): cells whose lower-cased value is in the detector's table of names."""
    first = detector.names.columns[0]
    names = detector.names.select(F.lower(F.col(f"`{first}`")).alias("lowered")).where("lowered IS NOT NULL").distinct()
    longest = names.agg(F.max(F.length("lowered"))).scalar()
    short = values.where(F.length("value") <= longest).select("*", F.lower("value").alias("lowered"))
    counted = short.groupBy(column, "lowered").agg(_total(values, F.lit(True)).alias("times"))
    return counted.join(names, "lowered", "left_semi").groupBy(column).agg(F.sum("times").alias(detector.name))


def _counts(
    values: DataFrame, found: Iterable[Detector], column: str
) -> DataFrame:
    """One row per column: non-empty cells and the hits of each detector."""
    found = list(found)
    lowered = values.select("*", F.lower("value").alias("lowered"))
    hits = [_total(values, d.hits("value", "lowered")).alias(d.name) for d in found if d.names is None]
    counts = lowered.groupBy(column).agg(_total(values, F.col("value").isNotNull()).alias(NON_EMPTY), *hits)
    listed = [d for d in found if d.names is not None]
    for d in listed:
        counts = counts.join(_listed_counts(values, d, column), column, "left")
    return counts.fillna(0, [d.name for d in listed]) if listed else counts


def detector_counts(
    values: DataFrame, found: list[Detector] | None = None, column: str = "column_name"
) -> DataFrame:
    """Exact hits of every detector on every column, in one scan."""
    return _counts(values, detectors() if found is None else found, column)


def long_counts(counts: DataFrame, found: list[Detector], column: str = "column_name") -> DataFrame:
    """Counts as rows (column, label, count), non-empty cells last."""
    labels = [d.name for d in found] + [NON_EMPTY]
    pairs = F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("count")) for n in labels])
    return counts.select(column, F.inline(pairs))


def candidates(
    values: DataFrame,
    key: Column,
    found: list[Detector] | None = None,
    column: str = "column_name",
    fraction: float = FRACTION,
) -> DataFrame:
    """Labels with a hit in a pilot sample of rows, as (column, label, count): a preview.

    Counts of the profile itself are always of all rows.  ``key`` identifies a row, so
    ``values`` must not be counted beforehand.
    """
    if WEIGHT in values.columns:
        raise ValueError("sample the rows of a column, not its counted values")
    found = detectors() if found is None else found
    pilot = _counts(pilot_sample(values, key, column, fraction), found, column)
    return long_counts(pilot, found, column).where("count > 0")


def semantic_types(
    counts: DataFrame,
    found: list[Detector],
    column: str = "column_name",
    name: Column | None = None,
) -> DataFrame:
    """Nested result per column: ``column_name`` and ``semantic_types``.

    Detectors with hits in detector order, then the types the column's name
    implies (all its non-empty cells), else ``other`` labelled with the name.
    """
    name = F.col(column) if name is None else name

    def entry(kind: Column, count: Column, label: Column | None = None) -> Column:
        label = F.lit(None) if label is None else label
        return F.struct(
            kind.alias("semantic_type"), label.cast("string").alias("label"), count.alias("count")
        )

    by_value = F.array_compact(
        F.array(*[F.when(F.col(d.name) > 0, entry(F.lit(d.name), F.col(d.name))) for d in found])
    )
    by_name = F.transform(named_types(name), lambda kind: entry(kind, F.col(NON_EMPTY)))
    types = F.concat(by_value, by_name)
    other = F.array(entry(F.lit("other"), F.col(NON_EMPTY), name))
    keep = [column] if column != "column_name" else []
    return counts.select(
        *keep,
        name.alias("column_name"),
        F.when(F.size(types) > 0, types).otherwise(other).alias("semantic_types"),
    )


def semantic_profile(
    values: DataFrame,
    found: list[Detector] | None = None,
    column: str = "column_name",
    name: Column | None = None,
    names: Iterable[str] = (),
) -> DataFrame:
    """Semantic profile of every column of ``values`` (``column``, ``value``), all detectors counted on all rows.

    ``names`` lists columns that get a row though they may have no cells, as those of an empty table.
    """
    found = detectors() if found is None else found
    counts = detector_counts(values, found, column)
    listed = [(n,) for n in dict.fromkeys(names)]
    if listed:
        every = values.sparkSession.createDataFrame(listed, f"`{column}` string")
        counts = every.join(counts, column, "full").fillna(0)
    return semantic_types(counts, found, column, name)

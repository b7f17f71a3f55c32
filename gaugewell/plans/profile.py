"""The generic profile: what each column of a table holds.

Two independent streams over the table meet at one row per column:

* scalar metrics: scan, fold per task, exchange of a few small rows;
* ranked values: scan, one shuffle of the distinct values, k best per column.

The first is never held up by the cardinality of a column and costs no data
shuffle; the second is the only one that moves values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.operators.cells import Cells, to_cells, union_cells
from gaugewell.operators.ranks import RANKINGS, TOP, distinct_counts, ranked_lists
from gaugewell.operators.scalars import scalar_metrics

# Counts that are 0, not NULL, for a column without cells.
COUNTS = ("number_non_empty_cells", "number_empty_cells", "number_distinct_values", "string_count")

# Section labels of a column profile, in output order.
INTEGER_TYPE, REAL_TYPE, DATE_TYPE, TEXT_TYPE = "INTEGER (LONG)", "REAL", "DATE/TIME", "TEXT"


def column_metrics(
    df: DataFrame,
    distinct: str = "exact",
    int_type: str = "int",
    skip_dotted: bool = False,
    k: int = TOP,
    rsd: float = 0.05,
    native_dates: bool = False,
) -> DataFrame:
    """All metrics, flat: one row per column, metric names as columns.

    ``distinct='exact'`` counts the values the rankings group anyway;
    ``'approx'`` estimates them within ``rsd`` during the scalar scan.  ``native_dates``
    gives date and time columns a date section too.
    """
    return _metrics(to_cells(df, skip_dotted), distinct, int_type, k, rsd, native_dates)


def _metrics(cells: Cells, distinct: str, int_type: str, k: int, rsd: float, native_dates: bool) -> DataFrame:
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    merged = scalar_metrics(cells, int_type=int_type, approx_distinct=distinct == "approx", rsd=rsd, native_dates=native_dates)
    # From every column's number, as columns without cells, as those of an empty table, have rows too.
    merged = cells.columns().join(merged, "col_id", "left")
    if distinct == "exact":
        # The non-empty cells are taken from here as well: that keeps the count of
        # each value in this stream, so that it shares the shuffle of the rankings.
        merged = (
            merged.drop("number_non_empty_cells")
            .join(distinct_counts(cells, k), "col_id", "left")
            .withColumnRenamed("counted_cells", "number_non_empty_cells")
        )
    merged = merged.join(ranked_lists(cells, RANKINGS, k), "col_id", "left").fillna(0, list(COUNTS))
    is_text = F.element_at(F.array(*[F.lit(t == "string") for t in cells.dtypes]), F.col("col_id") + 1)
    described = {"column_name": cells.name_of(F.col("col_id")), "is_text": is_text}
    if cells.datasets is not None:
        described["dataset_id"] = cells.dataset_of(F.col("col_id"))
    return merged.withColumns(described)


def _section(label: str, **values: Column) -> Column:
    empty = {
        "count": "bigint",
        "max_value": "string",
        "min_value": "string",
        "mean": "double",
        "stddev": "double",
        "shortest_values": "array<string>",
        "longest_values": "array<string>",
        "average_length": "double",
    }
    fields = [F.lit(label).alias("type")]
    for name, dtype in empty.items():
        fields.append(values.get(name, F.lit(None)).cast(dtype).alias(name))
    return F.struct(*fields)


def _numeric_section(label: str, prefix: str) -> Column:
    return _section(
        label,
        **{m: F.col(f"{prefix}_{m}") for m in ("count", "max_value", "min_value", "mean", "stddev")},
    )


def column_profiles(metrics: DataFrame) -> DataFrame:
    """Flat metrics as ``col_id`` and the struct ``profile``, sections nested.

    A section is present when some cell reads that way; TEXT whenever the
    column itself is text.
    """
    text = _section(
        TEXT_TYPE,
        count=F.col("string_count"),
        shortest_values=F.col("shortest_values"),
        longest_values=F.col("longest_values"),
        average_length=F.col("string_average_length"),
    )
    dates = _section(
        DATE_TYPE, **{m: F.col(f"date_{m}") for m in ("count", "max_value", "min_value")}
    )
    sections = F.array(
        F.when(F.col("integer_count").isNotNull(), _numeric_section(INTEGER_TYPE, "integer")),
        F.when(F.col("real_count").isNotNull(), _numeric_section(REAL_TYPE, "real")),
        F.when(F.col("date_count").isNotNull(), dates),
        F.when(F.col("is_text"), text),
    )
    return metrics.select(
        *[c for c in ("dataset_id",) if c in metrics.columns],
        "col_id",
        F.struct(
            "column_name",
            "number_non_empty_cells",
            "number_empty_cells",
            "number_distinct_values",
            "frequent_values",
            F.array_compact(sections).alias("data_types"),
        ).alias("profile"),
    )


def profile(df: DataFrame, dataset_name: str | None = None, **options) -> DataFrame:
    """Nested profile of one table: ``dataset_name`` and ``columns``, in column order.

    The columns of an empty table are listed with counts of 0.
    """
    entries = column_profiles(column_metrics(df, **options))
    ordered = F.sort_array(F.collect_list(F.struct("col_id", "profile")))
    return entries.agg(ordered["profile"].alias("columns")).select(
        F.lit(dataset_name).cast("string").alias("dataset_name"), "columns"
    )


def dataset_metrics(
    datasets: dict[str, DataFrame],
    distinct: str = "exact",
    int_type: str = "int",
    skip_dotted: bool = False,
    k: int = TOP,
    rsd: float = 0.05,
    native_dates: bool = False,
) -> DataFrame:
    """Flat metrics of several tables of any schemas, in one plan.

    Columns are numbered through all tables, so each table adds its scan and nothing else:
    there are as many shuffles for twenty tables as for one.
    """
    return _metrics(union_cells(datasets, skip_dotted), distinct, int_type, k, rsd, native_dates)


def dataset_profiles(datasets: dict[str, DataFrame], names: DataFrame | None = None, **options) -> DataFrame:
    """Nested profiles of several tables: one row per dataset.

    ``names`` is the display-name catalogue (``id``, ``name``); a dataset it
    does not list keeps a NULL name.
    """
    entries = column_profiles(dataset_metrics(datasets, **options))
    ordered = F.sort_array(F.collect_list(F.struct("col_id", "profile")))
    nested = entries.groupBy("dataset_id").agg(ordered["profile"].alias("columns"))
    if names is None:
        return nested.select("dataset_id", F.lit(None).cast("string").alias("dataset_name"), "columns")
    from gaugewell.plans.catalogue import with_names

    return with_names(nested, names, "dataset_id").select("dataset_id", "dataset_name", "columns")

"""JSON and CSV writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from gaugewell.session import scratch_path
from gaugewell.sources.tables import FILE_FOLDER, encoded, staged


def append_json(df: DataFrame, path: str) -> None:
    """Append rows as JSON Lines; NULL fields are left out."""
    df.write.mode("append").json(path)


def replace_json(df: DataFrame, path: str, key: str, keep: bool = True) -> None:
    """Write rows as JSON Lines, a folder for each value of ``key``; a key written again replaces itself.

    So a run that broke off between writing and noting what it wrote is repeated without
    doubles.  Keys that ``df`` does not hold stay as they are.  ``keep`` has the key in the
    lines as well as in the folder's name.
    """
    folder = f"of_{key}" if keep else key
    rows = df.withColumn(folder, F.col(key))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).json(path)


def finished(spark: SparkSession, path: str) -> DataFrame:
    """``key`` of everything noted as written to ``path``; empty before the first note."""
    try:
        return spark.read.schema("key string").json(_record(path)).distinct()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string")


def note_finished(df: DataFrame, path: str, key: str) -> None:
    """Note the values of ``key`` as written to ``path``, beside it."""
    append_json(df.select(F.col(key).cast("string").alias("key")), _record(path))


def _record(path: str) -> str:
    return f"{path.rstrip('/')}.finished"


def write_column_files(cells: DataFrame, path: str) -> None:
    """Cells (file_name, value) as one-column files, all in one job, read back by ``read_column_files(escaped=True)``.

    A folder per file name, with a part for each task that holds cells of it.  Any text is a
    line: line ends, tabs and backslashes are escaped, a NULL cell is a blank line.
    """
    lines = cells.select(F.col("file_name").alias(FILE_FOLDER), encoded(F.col("value")).alias("value"))
    lines.write.option("lineSep", "\n").partitionBy(FILE_FOLDER).text(path)


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = False,
    partition_by: str | list[str] | None = None,
    mode: str = "error",
) -> None:
    """Write CSV part files, one folder per value of ``partition_by``."""
    writer = df.write.mode(mode).option("header", header)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write one CSV file with a header, for reports: all rows pass through one task.

    The rows are computed once, in parallel, into the shared folder; only the copy is one
    task's work.  For large results use :func:`write_csv`.
    """
    rows = staged(df, scratch_path(df.sparkSession, "report"))
    rows.coalesce(1).write.mode(mode).option("header", True).csv(path)

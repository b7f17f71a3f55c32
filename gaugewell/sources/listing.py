"""File listings and column manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugewell.sources.tables import staged


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """Files under a path as (path, length).  Contents are pruned, not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path).select("path", "length")


def read_manifest(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """The column files of a manifest: ``pos``, ``file_name``, ``dataset_id``, ``column_name``, ``valid``.

    A manifest is a bracketed list of quoted names of four dotted parts, on any
    number of lines; ``pos`` counts from 0 in each file.  Names of another shape are kept
    with ``valid = false``.  ``first`` keeps the first n entries in manifest order.

    The file is read by quotes, not by lines: every second piece is a name.  So one long
    line is split among tasks, and pieces are numbered by a count per split.
    """
    pieces = spark.read.option("lineSep", "'").text(path).select(
        F.col("_metadata.file_path").alias("of"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("file_name"),
    )
    pieces = staged(pieces)
    # a split's pieces are consecutive; pieces of the splits before it are summed per file
    splits = pieces.groupBy("of", "block").agg(F.min("row").alias("low"), F.count("*").alias("n"))
    earlier = W.partitionBy("of").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("of", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("shift"))
    number = F.col("row") + F.col("shift")
    parts = F.split("file_name", r"\.")
    valid = F.size(parts) == 4
    listed = pieces.join(splits, ["of", "block"]).where(number % 2 == 1).select(
        F.shiftright(number, 1).alias("pos"),
        "file_name",
        F.when(valid, F.get(parts, F.lit(0))).alias("dataset_id"),
        F.when(valid, F.get(parts, F.lit(1))).alias("column_name"),
        valid.alias("valid"),
    )
    return listed if first is None else listed.where(F.col("pos") < first)

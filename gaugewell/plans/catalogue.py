"""Which datasets to profile, under which names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugewell.operators.numbering import numbered

# Fixed value: suffix of dataset files.
DATASET_SUFFIX = ".gz"


def dataset_id(path: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def first_datasets(listing: DataFrame, n: int) -> DataFrame:
    """The ``n`` smallest dataset files of a listing (``path``, ``length``).

    Adds ``dataset_id`` and the ``ordinal`` from 1.  The files are sorted and numbered in
    as many tasks as the sort has, whatever ``n`` is.
    """
    files = listing.where(F.col("path").endswith(DATASET_SUFFIX)).select("path", "length")
    found = numbered(files, "length", "path").where(F.col("ordinal") <= n)
    return found.select("ordinal", "path", "length", dataset_id(F.col("path")).alias("dataset_id"))


def exclude(chosen: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drop listed datasets; the others keep the ordinals they had.

    The list (``dataset_id``) is joined without a hint: Spark broadcasts it when
    its size is under the session's threshold.
    """
    return chosen.join(excluded.select("dataset_id"), "dataset_id", "left_anti")


def with_names(frame: DataFrame, names: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Add ``dataset_name`` from a catalogue (``id``, ``name``).

    Missing ids get NULL; of several names for one id the least is taken.
    """
    single = names.groupBy("id").agg(F.min("name").alias("dataset_name"))
    return frame.join(single.withColumnRenamed("id", key), key, "left")

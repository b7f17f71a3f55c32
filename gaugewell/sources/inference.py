"""Types of text cells: which reading all cells of a group share.

Types form a chain from narrow to wide (int, bigint, decimal, double; date, timestamp;
boolean) above which there is only text.  Whether all cells of a group fit a type is one
``bool_and``, so any number of files or columns is typed by one scan and one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = "string"

# A pattern before each cast: a failing cast raises and catches per cell.
_WHOLE = r"^[+-]?\d{1,38}$"
_REAL = r"^[\x00-\x20]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?[\x00-\x20]*$|^[+-]?(NaN|Infinity)$|^-?Inf$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
_BOOLEAN = r"^(?i:true|false)$"


def _cast(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), text.try_cast(kind))


def _fits(text: Column, whole: Column) -> dict[str, Column]:
    """Whether a cell, and its reading as an integer, fits each type, narrow ones before the wider ones of their chain."""
    return {
        "int": whole.between(F.lit(-(2**31)), F.lit(2**31 - 1)),
        "bigint": whole.between(F.lit(-(2**63)), F.lit(2**63 - 1)),
        "decimal(38,0)": whole.isNotNull(),
        "double": text.rlike(_REAL),
        "date": _cast(text, _DATE, "date").isNotNull(),
        "timestamp": _cast(text, _TIME, "timestamp").isNotNull(),
        "boolean": text.rlike(_BOOLEAN),
    }


def winners(cells: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``kind``: the narrowest type that all non-NULL cells (``value``) of a group fit.

    Text where none does, and where a group has no cells.
    """
    fits = _fits(F.col("value"), F.col("whole"))
    # the integer is read once, in a projection of its own
    whole = cells.select(*keys, "value", _cast(F.col("value"), _WHOLE, "decimal(38,0)").alias("whole"))
    read = whole.select(*keys, *[F.when(F.col("value").isNotNull(), F.coalesce(test, F.lit(False))).alias(kind) for kind, test in fits.items()])
    folded = read.groupBy(*keys).agg(*[F.bool_and(f"`{kind}`").alias(kind) for kind in fits])
    first = F.coalesce(*[F.when(F.col(f"`{kind}`"), F.lit(kind)) for kind in fits], F.lit(WIDEST))
    return folded.select(*keys, first.alias("kind"))


def printed(text: Column, kind: Column) -> Column:
    """A cell read as its group's type and printed again: ``007`` is 7 among integers, 7.0 among reals."""
    whole = _cast(text, _WHOLE, "decimal(38,0)").cast("string")
    real = _cast(text, _REAL, "double").cast("string")
    return (
        F.when(kind.isin("int", "bigint", "decimal(38,0)"), whole)
        .when(kind == "double", real)
        .when(kind == "boolean", F.lower(text))
        .otherwise(text)
    )

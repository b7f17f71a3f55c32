"""Pilot sample of rows, the same on any layout of the data.

``DataFrame.sample`` draws by partition, so its result moves with the layout.  Here a row
is in or out by a digest of what identifies it: one filter, no shuffle, no cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of the rows that a sample takes.
FRACTION = 0.1
_PARTS = 10_000


def digest_part(key: Column) -> Column:
    """0 to 9999 by the first 32 bits of the md5 digest of a row's key; a NULL key counts as empty."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % _PARTS


def pilot_sample(values: DataFrame, key: Column, column: str = "column_name", fraction: float = FRACTION) -> DataFrame:
    """Rows (column, value) whose key falls into the sampled ``fraction``.

    ``key`` must tell rows apart: equal values of different rows are drawn one by one.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("a fraction between 0 and 1")
    return values.where(digest_part(key) < round(fraction * _PARTS)).select(column, "value")

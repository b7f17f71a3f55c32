"""Service-request reports.

Each report is one plan over the whole table, all boroughs together: hits fold
map-side, and a ranking sees the folded groups only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugewell.functions.readings import as_date

# The five boroughs and the channel the reports ask for.
BOROUGHS = ("MANHATTAN", "BROOKLYN", "BRONX", "QUEENS", "STATEN ISLAND")
MOBILE = "MOBILE"

VIEW = "Complaints"


@dataclass(frozen=True)
class RequestColumns:
    """Where a request table keeps what the reports read."""

    # Column names of the published request table.
    borough: str = "Borough"
    complaint: str = "Complaint Type"
    agency: str = "Agency Name"
    created: str = "Created Date"
    closed: str = "Closed Date"
    channel: str = "Open Data Channel Type"


PUBLISHED = RequestColumns()


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _date(requests: DataFrame, name: str) -> Column:
    return as_date(_named(name), dict(requests.dtypes)[name]) if _is_text(requests, name) else _named(name).cast("date")


def _is_text(requests: DataFrame, name: str) -> bool:
    return dict(requests.dtypes)[name] == "string"


def register_view(requests: DataFrame, view: str = VIEW) -> DataFrame:
    """Make the table available to SQL under ``view``."""
    requests.createOrReplaceTempView(view)
    return requests


def _top(requests: DataFrame, what: str, alias: str, k: int, names: RequestColumns) -> DataFrame:
    borough = _named(names.borough)
    counted = (
        requests.where(borough.isin(*BOROUGHS))
        .groupBy(borough.alias("borough"), _named(what).alias(alias))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = W.partitionBy("borough").orderBy(F.desc("n"), alias)
    return counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_complaints(requests: DataFrame, k: int = 3, names: RequestColumns = PUBLISHED) -> DataFrame:
    """Most frequent complaint types of each borough."""
    return _top(requests, names.complaint, "complaint_type", k, names)


def top_agencies(requests: DataFrame, k: int = 1, names: RequestColumns = PUBLISHED) -> DataFrame:
    """Agencies with most requests in each borough."""
    return _top(requests, names.agency, "agency_name", k, names)


def daily_requests(
    requests: DataFrame, channel: str | None = None, names: RequestColumns = PUBLISHED
) -> DataFrame:
    """Requests per created day, of one channel if given; unreadable dates form one NULL day."""
    rows = requests if channel is None else requests.where(_named(names.channel) == channel)
    return rows.groupBy(_date(requests, names.created).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def average_close_days(requests: DataFrame, names: RequestColumns = PUBLISHED) -> DataFrame:
    """Mean days from creation to closing per agency; open requests do not count."""
    days = F.date_diff(_date(requests, names.closed), _date(requests, names.created))
    return requests.groupBy(_named(names.agency).alias("agency_name")).agg(F.avg(days).alias("avg_days"))


def complaints_over_time(requests: DataFrame, names: RequestColumns = PUBLISHED) -> DataFrame:
    """Closing day, type and borough of every request; a projection, no shuffle."""
    return requests.select(
        _date(requests, names.closed).alias("day"),
        _named(names.complaint).alias("complaint_type"),
        _named(names.borough).alias("borough"),
    )


def borough_totals(requests: DataFrame, names: RequestColumns = PUBLISHED, view: str = VIEW) -> DataFrame:
    """Requests per borough, asked in SQL on the registered view."""
    register_view(requests, view)
    listed = ", ".join(f"'{b}'" for b in BOROUGHS)
    column = "`" + names.borough.replace("`", "``") + "`"
    return requests.sparkSession.sql(
        f"SELECT {column} AS borough, count(*) AS n FROM {view} WHERE {column} IN ({listed}) GROUP BY {column}"
    )

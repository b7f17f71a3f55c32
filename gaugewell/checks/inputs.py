"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.plans.reports import RequestColumns
from gaugewell.sources import tables as sources

# Literals that hit or miss the detectors, by detector.
LITERALS = (
    "10001", "11999", "11201-1234", "12000", "1000",
    "+1 (743) 555-3824", "2125551234", "212-555-1234 x99", "555-1234", "phone 212-555-1234",
    "PS 11 School", "Brooklyn Academy of Music", "College",
    "5 AVENUE", "Main St", "Test", "Broadway", "Highland",
    "(40.7128, -74.0060)", "(40.7128,-73.9)", "(41.0, -74.0)", "40.7, -74.0",
    "Hunter College", "New York UNIVERSITY", "Academy",
    "MANHATTAN", "brooklyn", "Staten Island", "BRONX ", "Newark",
    "Prospect Park", "Parking Lot", "Playground",
    "https://www.example.com/x", "see www.foo.com", "http://a.io bar", "http://www.b", "example.com",
    "ACME CORP", "Vincent", "Foo LLC", "Bar",
    "MATH", "Social Studies", "maths", "science ",
    "Astoria", "SOHO", "Randall's Island",
    "Department of Parks", "NYC", "Keyboard", "Agent",
    "K-8 School", "Highway", "Senior", "Adult",
    "R0-CONDOMINIUM", "D4-ELEVATOR", "R0--A", "r0-CONDO", "R0-",
    "Engineering", "Animal Ccience", "ZONED", "Animal Science",
    "A", "B.", "c", "AB",
    "FORD", "BMW  7 SERIES", "ford", "BMW 7 SERIES",
    "STREET", "FAST FOODGROCERY/BODEGA", "street", "FAST FOOD",
    "RED", "NAVY", "red", "PURPLE",
    "40.71", "40", "41.7", "-73.99", "-74.0", "74.0", "-75.1",
    "12 Main St", "350 5th Ave.", "7 East High", "12  Main St",
)

# Names of neighbourhoods among the literals; see :func:`neighbourhoods`.
NEIGHBOURHOODS = ("astoria", "soho", "randall's island", "harlem", "inwood")

RULE_NAMES = (
    "First_Name", "LAST_NAME", "Name", "Vehicle_Body_Type", "VEHICLE_TYPE_CODE",
    "Vehicle_Type_Code_Body", "firstname",
)

BOROUGH_CYCLE = ("MANHATTAN", "BROOKLYN", "BRONX", "QUEENS", "STATEN ISLAND", "Unspecified")
CHANNEL_CYCLE = ("PHONE", "MOBILE", "ONLINE", "UNKNOWN")

REQUEST_COLUMNS = RequestColumns(
    borough="borough",
    complaint="complaint_type",
    agency="agency_name",
    created="created_date",
    closed="closed_date",
    channel="channel",
)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table; ``spread`` for work that outweighs one more shuffle of a small one."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return sources.spread(df) if spread else df


def cycle(values: tuple, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int") + 1)


def mixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table whose column ``mixed`` holds every kind of cell."""
    return table(spark, sf_dir, "orders", spread=True).selectExpr(
        "o_orderkey AS id",
        "concat('Customer ', o_custkey % 97) AS name",
        """CASE o_orderkey % 6 WHEN 0 THEN NULL
             WHEN 1 THEN cast(o_custkey AS string)
             WHEN 2 THEN concat(o_custkey % 50, '.7')
             WHEN 3 THEN date_format(o_orderdate, 'MM/dd/yyyy')
             WHEN 4 THEN o_orderpriority
             ELSE '3000000000' END AS mixed""",
        "o_totalprice AS amount",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as service requests."""
    day = "'MM/dd/yyyy'"
    closed = "date_add(cast(o_orderdate AS date), cast(o_orderkey % 30 AS int))"
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        cycle(BOROUGH_CYCLE, F.col("o_custkey")).alias("borough"),
        F.col("o_orderpriority").alias("complaint_type"),
        F.expr("concat('AGENCY_', o_custkey % 12)").alias("agency_name"),
        F.expr(f"concat(date_format(o_orderdate, {day}), ' 10:00:00 AM')").alias("created_date"),
        F.expr(
            f"CASE WHEN o_orderstatus = 'P' THEN NULL "
            f"ELSE concat(date_format({closed}, {day}), ' 10:00:00 AM') END"
        ).alias("closed_date"),
        cycle(CHANNEL_CYCLE, F.col("o_orderkey")).alias("channel"),
    )


def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of names to look cells up in: a few of the literals, nations, and every name of a part."""
    few = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in NEIGHBOURHOODS])).alias("name"))
    nations = table(spark, sf_dir, "nation").select("n_name")
    return few.unionAll(nations).unionAll(table(spark, sf_dir, "part").select("p_name"))


def literal_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detector literal (or NULL) per customer, as column ``literal``."""
    return table(spark, sf_dir, "customer").select(
        F.lit("literal").alias("column_name"),
        cycle(LITERALS + (None,), F.col("c_custkey")).alias("value"),
    )


def detector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals, and the text of four tables as it stands: (column_name, value)."""

    def column(name: str, source: str, field: str) -> DataFrame:
        return table(spark, sf_dir, source, spread=True).select(
            F.lit(name).alias("column_name"), F.col(field).alias("value")
        )

    parts = [
        literal_cells(spark, sf_dir),
        column("url", "pages", "url"),
        column("html", "pages", "html"),
        column("document", "documents", "text"),
        column("message", "conversations", "text"),
        column("part_name", "part", "p_name"),
    ]
    return reduce(DataFrame.unionAll, parts)


def keyed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of :func:`detector_cells` with what identifies their row: (column_name, row_key, value)."""

    def column(name: str, source: str, field: str, key: str) -> DataFrame:
        return table(spark, sf_dir, source).select(
            F.lit(name).alias("column_name"), F.expr(f"concat('{name} ', {key})").alias("row_key"), F.col(field).alias("value")
        )

    literals = table(spark, sf_dir, "customer").select(
        F.lit("literal").alias("column_name"),
        F.expr("concat('literal ', c_custkey)").alias("row_key"),
        cycle(LITERALS + (None,), F.col("c_custkey")).alias("value"),
    )
    parts = [
        literals,
        column("url", "pages", "url", "page_id"),
        column("html", "pages", "html", "page_id"),
        column("document", "documents", "text", "doc_id"),
        column("message", "conversations", "text", "conv_id, ' ', turn"),
        column("part_name", "part", "p_name", "p_partkey"),
    ]
    return reduce(DataFrame.unionAll, parts)


def rule_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names spread over columns whose names matter; a few are NULL."""
    return table(spark, sf_dir, "customer").select(
        cycle(RULE_NAMES, F.col("c_custkey")).alias("column_name"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("value"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file listing: (path, length)."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('/data/', source, '/d', doc_id, '.tsv', CASE WHEN doc_id % 5 = 0 THEN '' ELSE '.gz' END) AS path",
        "n_chars AS length",
    )


def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of names with gaps and doubles: (id, name)."""
    documents = table(spark, sf_dir, "documents").where("doc_id % 7 > 0")
    first = documents.selectExpr("concat('d', doc_id) AS id", "concat(lang, ' ', source) AS name")
    second = documents.where("doc_id % 3 = 0").selectExpr("concat('d', doc_id) AS id", "source AS name")
    return first.unionAll(second)


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("toxic = 1").selectExpr("concat('d', doc_id) AS dataset_id")


def number_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cells of column files whose numbers are written in several ways: (file_name, value)."""
    orders = table(spark, sf_dir, "orders")
    columns = {
        "d1.padded.1.2": "lpad(o_orderkey, 12, '0')",
        "d1.large.1.2": "concat('+', 3000000000 + o_orderkey)",
        "d1.mixed.1.2": "CASE o_orderkey % 4 WHEN 0 THEN '007' WHEN 1 THEN '40.710' WHEN 2 THEN '12' END",
        "d1.flag.1.2": "CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'False' END",
        "d1.day.1.2": "date_format(o_orderdate, 'yyyy-MM-dd')",
        "d1.almost.1.2": "CASE WHEN o_orderkey % 97 = 1 THEN 'none' ELSE concat('0', o_custkey) END",
    }
    parts = [orders.select(F.lit(name).alias("file_name"), F.expr(cell).alias("value")) for name, cell in columns.items()]
    return reduce(DataFrame.unionAll, parts)

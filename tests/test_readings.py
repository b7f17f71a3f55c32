"""Readings against Spark's own casts outside ANSI mode, and by hand."""

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugewell.functions.readings import as_date, as_real, as_whole, in_range

CELLS = [
    "3", "3.7", "-3.7", "+4", " 12 ", "\t5\n", "5.", ".5", "-.5", ".", "-.", "+", "-", "", " ", "1e3", "1E-2",
    "abc", "12abc", "1d", "1f", "1D", "NaN", "nan", "inf", "-Infinity", "+INF", "0x10", "0x1p3", "2147483647",
    "2147483648", "-2147483648", "-2147483649", "3000000000", "99999999999999999999", "00000000000000000000012",
    "1.2.3", "1,000", "007", "-0", "--1", "1 2", "１２", "3.x", "٣", "9223372036854775807", "1_000", "12 Main St",
]


def readings(spark, cells, int_type="int"):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    read = df.select("c", as_whole(F.col("c"), "string").alias("w"), as_real(F.col("c"), "string").alias("r"))
    return read.select("c", in_range(F.col("w"), int_type).alias("i"), "r").collect()


def plain_casts(spark, cells, int_type="int"):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return df.select("c", F.col("c").cast(int_type).alias("i"), F.col("c").cast("double").alias("r")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("int_type", ["int", "bigint"])
def test_text_reads_as_the_plain_cast(spark, int_type):
    ours, theirs = readings(spark, CELLS, int_type), plain_casts(spark, CELLS, int_type)
    assert [str(r) for r in ours] == [str(r) for r in theirs]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-. eEdfxXnaNif\t", max_size=12), min_size=200, max_size=300))
def test_random_text_reads_as_the_plain_cast(spark, cells):
    assert [str(r) for r in readings(spark, cells)] == [str(r) for r in plain_casts(spark, cells)]


def test_numbers(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (3.7D, 3000000000L, true, 3.7BD), (-3.7D, -5L, false, -2.5BD),
           (double('NaN'), 7L, null, 1.0BD), (1e20D, null, null, null), (2147483647.5D, 1L, true, 2.0BD)
           AS t(d, l, b, m)"""
    )
    types = dict(df.dtypes)
    whole = df.select(*[as_whole(F.col(c), types[c]).alias(c) for c in df.columns])
    rows = whole.select(*[in_range(F.col(c)).alias(c) for c in df.columns]).collect()
    assert [r.d for r in rows] == [3, -3, None, None, 2147483647]
    assert [r.l for r in rows] == [None, -5, 7, None, 1]
    assert [r.b for r in rows] == [1, 0, None, None, 1]
    assert [r.m for r in rows] == [3, -2, 1, None, 2]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT TIMESTAMP_NTZ'1970-01-02 00:00:01.5' AS n, TIMESTAMP'1970-01-02 00:00:01.5Z' AS t, "
            "TIMESTAMP_NTZ'1969-12-31 23:59:58.5' AS p, DATE'2020-01-01' AS d"
        )
        types = dict(df.dtypes)
        row = df.select(
            *[as_whole(F.col(c), types[c]).alias(f"{c}w") for c in df.columns],
            *[as_real(F.col(c), types[c]).alias(f"{c}r") for c in df.columns],
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.nw, row.nr, row.tw, row.tr) == (86401, 86401.5, 86401, 86401.5)
    assert (row.pw, row.pr, row.dw, row.dr) == (-2, -1.5, None, None)


def test_dates(spark):
    cells = {
        "10/12/2019": date(2019, 10, 12),
        "10/12/2019 10:00:00 AM": date(2019, 10, 12),
        " 1/5/2019": date(2019, 1, 5),
        "13/45/2019": None,
        "02/30/2019": None,
        "2019-10-12": None,
        "https://a.b/c": None,
        "1/2/19": None,
        "": None,
        "x 10/12/2019": None,
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert [r[0] for r in df.select(as_date(F.col("c"))).collect()] == list(cells.values())


def test_unknown_integer_type():
    with pytest.raises(ValueError):
        in_range(None, "smallint")

"""Pilot sample and semantic profile against brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gaugewell.functions.detectors import detectors
from gaugewell.operators.sample import pilot_sample
from gaugewell.plans import semantic

SCHEMA = "column_name string, value string"


def cells():
    """A column that holds most of the data, half of it one value, and small ones."""
    rows = [("big", "BRONX" if i % 2 else f"{i} Main St") for i in range(30_000)]
    rows += [("mid", str(10000 + i)) for i in range(1500)]
    rows += [("few", v) for v in ("RED", "NAVY", "school", None, "x")]
    rows += [("first_name", v) for v in ("Ann", None, "Bob")]
    rows += [("void", None)] * 3
    return rows


def brute_sample(rows, parts=1000):
    return sorted(
        ((c, v) for k, c, v in rows if int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % 10_000 < parts), key=repr
    )


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_sample_on_any_layout(spark, parts):
    rows = [(k, c, v) for k, (c, v) in enumerate(cells())]
    df = spark.createDataFrame(rows, "k long, column_name string, value string").repartition(parts)
    got = sorted(((r.column_name, r.value) for r in pilot_sample(df, F.col("k")).collect()), key=repr)
    assert got == brute_sample(rows)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_columns_of_few_values_are_seen(spark, parts):
    boroughs = F.element_at(F.array(*map(F.lit, ("Manhattan", "Brooklyn", "Bronx", "Queens", "Staten Island"))), (F.col("id") % 5 + 1).cast("int"))
    colours = F.element_at(F.array(*map(F.lit, ("RED", "BLUE", "GREEN"))), (F.col("id") % 3 + 1).cast("int"))
    ids = spark.range(5000).repartition(parts)
    df = ids.select(F.lit("b").alias("column_name"), boroughs.alias("value"), "id").unionAll(ids.select(F.lit("c"), colours, "id"))
    got = {(r.column_name, r.label) for r in semantic.candidates(df, F.col("id")).collect()}
    assert ("b", "borough") in got and ("c", "color") in got
    assert 400 < pilot_sample(df.where("column_name = 'b'"), F.col("id")).count() < 600


def types_of(frame):
    return {
        r.column_name: [(t.semantic_type, t.label, t["count"]) for t in r.semantic_types] for r in frame.collect()
    }


def test_profile(spark):
    df = spark.createDataFrame(cells(), SCHEMA)
    got = types_of(semantic.semantic_profile(df))
    assert got["big"] == [("street_name", None, 15000), ("borough", None, 15000)]
    assert got["mid"] == [("zip_code", None, 1500)]
    assert got["few"] == [("school_name", None, 1), ("color", None, 2)]
    assert got["first_name"] == [("person_name", None, 2)]
    assert got["void"] == [("other", "void", 0)]


def test_counted_values_count_alike(spark):
    df = spark.sql("SELECT id % 7 AS k, IF(id % 3 = 0, NULL, 'RED') AS colour, CAST(NULL AS INT) AS void FROM range(1000)")
    found = detectors()
    plain = types_of(semantic.semantic_profile(semantic.column_values(df), found))
    counted = types_of(semantic.semantic_profile(semantic.counted_column_values(df), found))
    assert plain == counted and plain["void"] == [("other", "void", 0)]
    with pytest.raises(ValueError):
        semantic.candidates(semantic.counted_column_values(df), F.col("value"))


def test_columns_without_cells_have_rows(spark):
    values = spark.createDataFrame([("a", "BRONX")], "column_name string, value string")
    rows = {r.column_name: r.semantic_types for r in semantic.semantic_profile(values, names=["a", "none"]).collect()}
    assert (rows["none"][0]["semantic_type"], rows["none"][0]["count"]) == ("other", 0)
    assert rows["a"][0]["count"] == 1

"""Truth table, and each detector against the pattern or list it stands for."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugewell.checks.inputs import NEIGHBOURHOODS
from gaugewell.functions import detectors as D
from gaugewell.functions import vocab as V
from gaugewell.plans import semantic

TRUTH = {
    "zip_code": (["10001", "11999"], ["11201-1234", "12000", "1000"]),
    "phone_number": (["+1 (743) 555-3824", "2125551234", "212-555-1234 x99"], ["555-1234", "phone 212-555-1234"]),
    "school_name": (["PS 11 School", "Brooklyn Academy of Music"], ["College"]),
    "street_name": (["5 AVENUE", "Main St", "Test", "Broadway"], ["Highland"]),
    "lat_lon_cord": (["(40.7128, -74.0060)", "(40.7128,-73.9)"], ["(41.0, -74.0)", "40.7, -74.0"]),
    "college_name": (["Hunter College", "New York UNIVERSITY"], ["Academy"]),
    "borough": (["MANHATTAN", "brooklyn", "Staten Island"], ["BRONX ", "Newark"]),
    "park_playground": (["Prospect Park", "Parking Lot"], ["Playground"]),
    "website": (["https://www.example.com/x", "see www.foo.com", "http://a.io bar"], ["http://www.b", "example.com"]),
    "business_name": (["ACME CORP", "Vincent", "Foo LLC"], ["Bar"]),
    "subject_in_school": (["MATH", "Social Studies"], ["maths", "science "]),
    "neighbourhood": (["Astoria", "SOHO", "Randall's Island"], ["Newark"]),
    "city_agency": (["Department of Parks", "NYC", "Keyboard"], ["Agent"]),
    "school_level": (["K-8 School", "Highway", "Senior"], ["Adult"]),
    "building_classification": (["R0-CONDOMINIUM", "D4-ELEVATOR", "R0--A"], ["r0-CONDO", "R0-"]),
    "area_of_study": (["Engineering", "Animal Ccience", "ZONED"], ["Animal Science"]),
    "MiddleInitial": (["A", "B."], ["c", "AB"]),
    "car_make": (["FORD", "BMW  7 SERIES"], ["ford", "BMW 7 SERIES"]),
    "location_type": (["STREET", "FAST FOODGROCERY/BODEGA"], ["street", "FAST FOOD"]),
    "color": (["RED", "NAVY"], ["red", "PURPLE"]),
    "Latitude": (["40.71"], ["40", "41.7"]),
    "Longitude": (["-73.99", "-74.0"], ["74.0", "-75.1"]),
    "address": (["12 Main St", "350 5th Ave.", "7 East High"], ["Main St", "12  Main St"]),
}
EVERY = D.detectors(neighbourhoods=NEIGHBOURHOODS, opt_in=True)


def hits(spark, cells, found):
    df = spark.createDataFrame([(c,) for c in cells], "value string")
    return df.select("value", *[d.hits().alias(d.name) for d in found]).collect()


def test_truth_table(spark):
    cells = sorted({c for hit, miss in TRUTH.values() for c in hit + miss})
    rows = {r["value"]: r for r in hits(spark, cells, EVERY)}
    for name, (hit, miss) in TRUTH.items():
        assert [c for c in hit if not rows[c][name]] == [], name
        assert [c for c in miss if rows[c][name]] == [], name


def test_null_is_no_hit(spark):
    assert not any(hits(spark, [None], EVERY)[0][1:])


def _words(words):
    return lambda c: re.search("|".join(map(re.escape, words)), c.lower())


PLAIN = {
    "zip_code": lambda c: re.search(D.ZIP_CODE, c.lower()),
    "phone_number": lambda c: re.search(D.PHONE_NUMBER, c.lower()),
    "school_name": _words(V.SCHOOL_NAME_WORDS),
    "street_name": _words(V.STREET_NAME_WORDS),
    "lat_lon_cord": lambda c: re.search(D.LAT_LON_CORD, c.lower()),
    "college_name": _words(V.COLLEGE_NAME_WORDS),
    "borough": lambda c: re.search(D.BOROUGH, c.lower()),
    "park_playground": _words(V.PARK_WORDS),
    "website": lambda c: re.search(D.WEBSITE, c.lower()),
    "business_name": _words(V.BUSINESS_NAME_WORDS),
    "city_agency": _words(V.CITY_AGENCY_WORDS),
    "school_level": _words(V.SCHOOL_LEVEL_WORDS),
    "building_classification": lambda c: re.search(D.BUILDING_CLASSIFICATION, c, re.A),
    "MiddleInitial": lambda c: re.search(D.MIDDLE_INITIAL, c),
    "Latitude": lambda c: re.search(D.LATITUDE, c.lower()),
    "Longitude": lambda c: re.search(D.LONGITUDE, c.lower()),
    "address": lambda c: re.search(r"\d+[ ](?:[A-Za-z0-9.-]+[ ]?)+(?:ave|dr|rd|blvd|ln|st|av)\.?", c.lower()),
}
PIECES = [
    "1", "10", "4", "555", "1234", "0", ".", "-", " ", "  ", ",", "(", ")", "+", "x", "(40.", "-73.", "-74", "www.",
    "http://", "https://", "www", "a", "foo", ".com", "/x", "A", "B", "R0-", "D4-", "main", "st", "ave", "av", "dr",
    "Rd", "k-8", "high", "school", "park", "corp", "bronx", "Queens", "staten island", "\n",
]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=7).map("".join), min_size=300, max_size=400))
def test_detectors_against_plain_patterns(spark, cells):
    for row in hits(spark, cells, [d for d in EVERY if d.name in PLAIN]):
        for name, plain in PLAIN.items():
            assert row[name] == bool(plain(row["value"])), (name, row["value"])


def test_lists(spark):
    lists = {
        "subject_in_school": V.SUBJECTS,
        "area_of_study": V.AREAS_OF_STUDY,
        "car_make": V.CAR_MAKES,
        "location_type": V.LOCATION_TYPES,
        "color": V.COLORS,
    }
    cells = sorted({c for names in lists.values() for c in names})
    for row in hits(spark, cells, [d for d in EVERY if d.name in lists]):
        for name, names in lists.items():
            assert row[name] == (row["value"] in names or row["value"].lower() in names and name in ("subject_in_school", "area_of_study"))


def test_fixed_vocabulary_only_adds(spark):
    fixed = [d for d in D.detectors(fix_vocab=True) if d.name in ("area_of_study", "location_type")]
    cells = ["animal science", "animal ccience", "FAST FOOD", "GROCERY/BODEGA", "FAST FOODGROCERY/BODEGA"]
    rows = hits(spark, cells, fixed)
    assert [r["area_of_study"] for r in rows] == [True, True, False, False, False]
    assert [r["location_type"] for r in rows] == [False, False, True, True, True]


def test_own_detectors(spark):
    own = [
        D.Detector("sql", lambda cell, low: f"{low} = 'it''s'"),
        D.Detector("column", lambda cell, low: F.length(cell) > 3),
    ]
    assert [tuple(r) for r in hits(spark, ["It's", "a"], own)] == [("It's", True, True), ("a", False, False)]
    odd = D.Detector("listed", D._listed(["a\\b", "it's", '"q"'], lower=False))
    assert [r["listed"] for r in hits(spark, ["a\\b", "it's", '"q"', "ab"], [odd])] == [True, True, True, False]


def test_address_in_a_long_text(spark):
    text = "pile " * 200_000 + "12 " + "pile " * 200_000
    found = [d for d in EVERY if d.name == "address"]
    assert [r["address"] for r in hits(spark, [text, text + "st"], found)] == [False, True]


def test_catalogue_of_detectors():
    standard = [d.name for d in D.detectors()]
    assert len(standard) == 19 and "neighbourhood" not in standard
    with_names = [d.name for d in D.detectors(neighbourhoods=["soho"])]
    assert with_names.index("neighbourhood") == with_names.index("subject_in_school") + 1
    assert [d.name for d in D.detectors(opt_in=True)][-3:] == ["Latitude", "Longitude", "address"]


def test_name_list_from_a_file(spark, tmp_path, monkeypatch):
    (tmp_path / "names.txt").write_text("Astoria\n\n SoHo \nastoria\n")
    assert V.load_names(spark, str(tmp_path / "names.txt")) == ("astoria", "soho")
    assert {r.name for r in V.names_table(spark, str(tmp_path / "names.txt")).collect()} == {"astoria", "soho"}
    monkeypatch.setattr(V, "MAX_NAMES", 1)
    with pytest.raises(ValueError):
        V.load_names(spark, str(tmp_path / "names.txt"))


def test_six_thousand_names(spark, tmp_path):
    names = [f"place {i}" for i in range(6000)] + ["İstanbul", "randall's island", "back\\slash"]
    (tmp_path / "names.txt").write_text("\n".join(names))
    rows = [("a", n.upper()) for n in names[::10]] + [("a", "PLACE"), ("a", None), ("b", "place 7 "), ("c", "Place 5999")] * 2
    rows += [("a", "İstanbul"), ("a", "x" * 100_000), ("d", "Randall's Island"), ("d", "BACK\\slash")]
    cells = spark.createDataFrame(rows, "column_name string, value string").repartition(5)
    want = {"a": len(names[::10]) + 1, "b": 0, "c": 2, "d": 2}
    for given in (names, V.names_table(spark, str(tmp_path / "names.txt"))):
        found = [d for d in D.detectors(neighbourhoods=given) if d.name == "neighbourhood"]
        assert found[0].names is not None
        got = {r.column_name: r.neighbourhood for r in semantic.detector_counts(cells, found).collect()}
        assert got == want
    with pytest.raises(ValueError):
        found[0].hits()
    # no names, no hits
    none = D.Detector("nothing", names=spark.createDataFrame([], "name string"))
    assert {r["nothing"] for r in semantic.detector_counts(cells, [none]).collect()} == {0}


def test_patterns_do_not_depend_on_how_literals_are_read(spark):
    name = "spark.sql.parser.escapedStringLiterals"
    cells = sorted({c for hit, _ in TRUTH.values() for c in hit})
    plain = hits(spark, cells, EVERY)
    spark.conf.set(name, "true")
    try:
        assert hits(spark, cells, D.detectors(neighbourhoods=NEIGHBOURHOODS, opt_in=True)) == plain
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize(
    "name,types",
    [
        ("First_Name", ["person_name"]),
        ("LAST_NAME", ["person_name"]),
        ("last_first_name", ["person_name"]),
        ("Name", []),
        ("Vehicle_Body_Type", ["vehicle_body_type"]),
        ("VEHICLE_TYPE_CODE", ["vehicle_type_code"]),
        ("Vehicle_Type_Code_Body", ["vehicle_body_type", "vehicle_type_code"]),
        ("firstname", []),
    ],
)
def test_name_rules(spark, name, types):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(D.named_types(F.col("name"))).first()[0] == types

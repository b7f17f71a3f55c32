"""The generic profile: cells, metrics, rankings, nesting."""

import json
import math
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugewell.checks import inputs as I
from gaugewell.operators.cells import to_cells
from gaugewell.operators.ranks import distinct_counts, ranked_lists, ranked_values
from gaugewell.operators.scalars import scalar_metrics
from gaugewell.plans import profile


def by_column(metrics):
    return {r["column_name"]: r.asDict() for r in metrics.collect()}


def brute_rankings(values):
    seen = Counter(v for v in values if v is not None)
    frequent = sorted(seen, key=lambda v: (-seen[v], v))[:5]
    return frequent, sorted(seen, key=lambda v: (len(v), v))[:5], sorted(seen, key=lambda v: (-len(v), v))[:5]


def skewed_texts(rows):
    """A third of the rows share one value, the rest vary."""
    return [
        None if i % 11 == 0 else "hot" if i % 3 == 0 else f"{'v' * (i % 7)}{i % 4001}" for i in range(rows)
    ]


@pytest.mark.parametrize("rows", [99_999, 100_003])
def test_rankings_on_both_sides_of_100k(spark, rows):
    values = skewed_texts(rows)
    df = spark.createDataFrame([(v,) for v in values], "t string")
    frequent, shortest, longest = brute_rankings(values)
    row = profile.column_metrics(df).first()
    assert (row.frequent_values, row.shortest_values, row.longest_values) == (frequent, shortest, longest)
    assert row.number_distinct_values == len({v for v in values if v is not None})
    assert row.number_empty_cells == values.count(None)
    assert row.number_non_empty_cells == rows - values.count(None)


def test_statistics_by_hand(spark):
    cells = ["3", "3.7", "-12", "abc", None, "3000000000", "01/05/2019", "12/31/2018 x"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    m = by_column(profile.column_metrics(df))["c"]
    whole, real = [3, 3, -12], [3.0, 3.7, -12.0, 3e9]
    assert (m["integer_count"], m["integer_max_value"], m["integer_min_value"]) == (3, 3, -12)
    assert m["integer_mean"] == pytest.approx(-2) and m["integer_stddev"] == pytest.approx(statistics.stdev(whole))
    assert (m["real_count"], m["real_max_value"], m["real_min_value"]) == (4, 3e9, -12.0)
    assert m["real_stddev"] == pytest.approx(statistics.stdev(real))
    assert (m["date_count"], str(m["date_max_value"]), str(m["date_min_value"])) == (2, "2019-01-05", "2018-12-31")
    assert m["string_count"] == 7
    assert m["string_average_length"] == pytest.approx(sum(len(c) for c in cells if c) / 7)
    wide = by_column(profile.column_metrics(df, int_type="bigint"))["c"]
    assert (wide["integer_count"], wide["integer_max_value"]) == (4, 3_000_000_000)


def test_every_type_has_cells(spark):
    df = spark.sql(
        """SELECT 1Y AS b, 2S AS s, 3 AS i, 4L AS l, 1.5F AS f, 2.5D AS d, 1.25BD AS m, true AS o, 'x' AS t,
           DATE'2020-01-02' AS dd, TIMESTAMP'2020-01-02 03:04:05Z' AS ts, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS tn,
           array(1, 2) AS a, named_struct('k', 1) AS st, map('k', 1) AS mp, X'41' AS bin, CAST(NULL AS INT) AS n"""
    )
    m = by_column(profile.column_metrics(df))
    assert len(m) == len(df.columns)
    assert all(m[c]["number_non_empty_cells"] == (c != "n") for c in df.columns)
    assert m["a"]["frequent_values"] == ["[1, 2]"] and m["m"]["frequent_values"] == ["1.25"]
    assert m["tn"]["integer_max_value"] == m["ts"]["integer_max_value"] == 1577934245
    assert [c for c in df.columns if m[c]["integer_count"] is None] == ["t", "dd", "a", "st", "mp", "bin", "n"]
    assert [c for c in df.columns if m[c]["is_text"]] == ["t"]
    assert m["n"]["frequent_values"] is None


def test_edges(spark):
    one = by_column(profile.column_metrics(spark.sql("SELECT '5' AS `a b`, CAST(NULL AS STRING) AS `c.d`")))
    assert one["a b"]["integer_stddev"] is None and one["a b"]["integer_mean"] == 5
    assert one["c.d"]["number_empty_cells"] == 1 and one["c.d"]["longest_values"] is None
    assert one["c.d"]["number_distinct_values"] == 0 and one["c.d"]["string_count"] == 0
    empty = spark.createDataFrame([], "a string, b int")
    nothing = by_column(profile.column_metrics(empty))
    assert sorted(nothing) == ["a", "b"] and nothing["a"]["string_count"] == 0
    for distinct in ("exact", "approx"):
        for m in by_column(profile.column_metrics(empty, distinct=distinct)).values():
            assert m["number_non_empty_cells"] == m["number_empty_cells"] == m["number_distinct_values"] == 0
            assert m["integer_count"] is m["real_count"] is m["date_count"] is m["frequent_values"] is None
    columns = profile.profile(empty, "e").first().columns
    assert [(c.column_name, [t.type for t in c.data_types]) for c in columns] == [("a", ["TEXT"]), ("b", [])]
    both = profile.dataset_profiles({"empty": empty, "full": spark.sql("SELECT 1 AS x")})
    assert {r.dataset_id: len(r.columns) for r in both.collect()} == {"empty": 2, "full": 1}
    dotted = by_column(profile.column_metrics(spark.sql("SELECT 1 AS `a.b`, 2 AS c"), skip_dotted=True))
    assert list(dotted) == ["c"]
    with pytest.raises(ValueError):
        to_cells(spark.sql("SELECT 1 AS a, 2 AS a"))
    with pytest.raises(ValueError):
        profile.column_metrics(empty, distinct="some")
    quoted = by_column(profile.column_metrics(spark.sql("SELECT 1 AS `it's ``x```")))
    assert list(quoted) == ["it's `x`"]


def test_wide_tables_batch_alike(spark):
    df = spark.range(200).select(
        *[(F.col("id") % (i + 2)).cast("string" if i % 3 else "double").alias(f"c{i}") for i in range(120)]
    )
    narrow, wide = to_cells(df, batch=7), to_cells(df, batch=500)

    def rows(cells):
        scalars = {r.col_id: r for r in scalar_metrics(cells).collect()}
        lists = {r.col_id: r for r in ranked_lists(cells).collect()}
        return scalars, lists

    assert rows(narrow) == rows(wide)
    assert len(rows(narrow)[0]) == 120


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_layout_does_not_matter(spark, sf, parts):
    df = I.mixed_orders(spark, sf)

    def shown(frame):
        rows = by_column(profile.column_metrics(frame))
        return {
            c: {k: f"{v:.9g}" if isinstance(v, float) else v for k, v in m.items()} for c, m in rows.items()
        }

    assert shown(df.repartition(parts)) == shown(df)


def test_properties(spark, sf):
    for name in ("lineitem", "customer", "events", "documents"):
        df = I.table(spark, sf, name)
        rows = df.count()
        for m in by_column(profile.column_metrics(df)).values():
            assert m["number_non_empty_cells"] + m["number_empty_cells"] == rows
            assert (m["integer_count"] or 0) <= (m["real_count"] or 0)
            if m["real_count"] and not math.isnan(m["real_mean"]):
                slack = 1e-9 * max(1.0, abs(m["real_mean"]))
                assert m["real_min_value"] - slack <= m["real_mean"] <= m["real_max_value"] + slack
            assert m["number_distinct_values"] <= m["number_non_empty_cells"]
            assert len(m["frequent_values"] or []) == min(5, m["number_distinct_values"])


def test_approximate_distinct(spark, sf):
    df = I.table(spark, sf, "lineitem")
    exact = by_column(profile.column_metrics(df))
    approx = by_column(profile.column_metrics(df, distinct="approx"))
    plain = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns]).first()
    for c in df.columns:
        e, a = exact[c]["number_distinct_values"], approx[c]["number_distinct_values"]
        assert abs(a - e) <= 3 * 0.05 * e
        assert a == plain[c]
        assert exact[c]["number_non_empty_cells"] == approx[c]["number_non_empty_cells"]


def test_nested_profile(spark, sf):
    df = I.mixed_orders(spark, sf)
    row = profile.profile(df, "orders").first()
    assert row.dataset_name == "orders"
    assert [c.column_name for c in row.columns] == ["id", "name", "mixed", "amount"]
    types = [[t.type for t in c.data_types] for c in row.columns]
    assert types == [["INTEGER (LONG)", "REAL"], ["TEXT"], ["INTEGER (LONG)", "REAL", "DATE/TIME", "TEXT"], ["INTEGER (LONG)", "REAL"]]
    text = json.loads(profile.profile(df, "orders").toJSON().first())
    assert "date_count" not in text["columns"][0] and "max_value" not in text["columns"][1]["data_types"][0]


def test_native_dates(spark):
    df = spark.sql(
        "SELECT DATE'2020-01-02' AS d, TIMESTAMP'2020-01-02 23:30:00' AS t, TIMESTAMP_NTZ'2019-05-06 01:00:00' AS z, '1/2/2021' AS s, 5 AS n "
        "UNION ALL SELECT NULL, TIMESTAMP'2018-03-04 00:00:00', NULL, 'x', 6"
    )
    plain = by_column(profile.column_metrics(df))
    assert [c for c, m in plain.items() if m["date_count"]] == ["s"]
    found = by_column(profile.column_metrics(df, native_dates=True))
    shown = {c: (m["date_count"], str(m["date_min_value"]), str(m["date_max_value"])) for c, m in found.items() if m["date_count"]}
    assert shown == {
        "d": (1, "2020-01-02", "2020-01-02"), "t": (2, "2018-03-04", "2020-01-02"),
        "z": (1, "2019-05-06", "2019-05-06"), "s": (1, "2021-01-02", "2021-01-02"),
    }
    types = {c.column_name: [t.type for t in c.data_types] for c in profile.profile(df, native_dates=True).first().columns}
    assert "DATE/TIME" in types["d"] and "DATE/TIME" not in types["n"]


def test_long_values_rank_by_lead_length_and_digest(spark):
    import hashlib
    import random

    rng = random.Random(8)
    lead = "same lead " * 8
    texts = [lead + "".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(400)]
    texts += [lead[:64], lead[:63], lead[:65]] * 2 + ["é" * 70, "x" * 300_000, "x" * 299_999 + "y", None, ""]
    df = spark.createDataFrame([(t, None if t is None else len(t), [t]) for t in texts], "t string, n int, a array<string>").repartition(4)

    def brute(values, key):
        counts = Counter(v for v in values if v is not None)
        md5 = {v: hashlib.md5(v.encode()).hexdigest() for v in counts}
        order = sorted(counts, key=lambda v: (key(v, counts[v]), v[:64], len(v), md5[v]))
        return [(i + 1, v, counts[v]) for i, v in enumerate(order[:5])]

    keys = {"frequent": lambda v, n: -n, "shortest": lambda v, n: len(v), "longest": lambda v, n: -len(v)}
    got = {}
    for r in ranked_values(to_cells(df)).collect():
        got.setdefault((r.col_id, r.ranking), []).append((r["rank"], r.value, r.n))
    for ranking, key in keys.items():
        assert sorted(got[0, ranking]) == brute(texts, key)
    printed = [None if t is None else f"[{t}]" for t in texts]
    assert sorted(got[2, "frequent"]) == brute([p or "[NULL]" for p in printed], keys["frequent"])


def test_profiles_of_several_tables(spark, sf):
    tables = {"c": I.table(spark, sf, "customer"), "p": I.table(spark, sf, "part")}
    names = spark.createDataFrame([("c", "Customers"), ("c", "Buyers")], "id string, name string")
    rows = {r.dataset_id: r for r in profile.dataset_profiles(tables, names).collect()}
    assert (rows["c"].dataset_name, rows["p"].dataset_name) == ("Buyers", None)
    for key, df in tables.items():
        assert rows[key].columns == profile.profile(df).first().columns


def test_distinct_counts_and_weights(spark):
    df = spark.createDataFrame([(v,) for v in skewed_texts(5000)], "t string")
    row = distinct_counts(to_cells(df)).first()
    assert row.counted_cells == df.where("t IS NOT NULL").count()


@pytest.mark.parametrize("rankings", [("shortest",), ("longest",), ("longest", "shortest")])
def test_bounded_lengths_rank_alike(spark, sf, rankings):
    texts = skewed_texts(20_000)
    frames = [
        spark.createDataFrame([(v, v and v[:2], "same", "") for v in texts], "a string, b string, c string, d string"),
        spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "a string"),
        I.table(spark, sf, "documents").select("text", "lang", "n_chars"),
    ]
    for df in frames:
        cells = to_cells(df)
        every = ranked_values(cells).where(F.col("ranking").isin(*rankings))
        assert sorted(ranked_values(cells, rankings).collect()) == sorted(every.collect())

"""What the plans may and may not contain."""

import re

from pyspark.sql import functions as F

from gaugewell.checks import inputs as I
from gaugewell.checks import registry
from gaugewell.functions.detectors import detectors
from gaugewell.operators.cells import to_cells
from gaugewell.operators.ranks import ranked_values
from gaugewell.operators.sample import pilot_sample
from gaugewell.operators.scalars import scalar_metrics
from gaugewell.plans import catalogue, profile, reports, semantic
from gaugewell.sources import tables
from gaugewell.sources.listing import read_manifest

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_python_and_no_cross_join_in_any_query(spark, sf, plan):
    for key, query in registry.queries().items():
        text = plan(query(spark, sf))
        assert not [f for f in FORBIDDEN if f in text], key


def test_scalars_are_one_expand_and_one_small_shuffle(spark, sf, plan):
    text = plan(scalar_metrics(to_cells(I.table(spark, sf, "lineitem"))))
    assert text.count("+- Expand") == 1 and text.count("Exchange") == 1
    assert "Exchange hashpartitioning(col_id" in text


def test_cells_read_only_their_columns(spark, sf, plan):
    text = plan(scalar_metrics(to_cells(I.table(spark, sf, "lineitem").select("l_tax", "l_returnflag"))))
    assert re.search(r"ReadSchema: struct<l_tax:double,l_returnflag:string>", text)


def test_rankings_count_before_the_shuffle_and_cut_before_the_window(spark, sf, plan):
    text = plan(ranked_values(to_cells(I.table(spark, sf, "lineitem"))), run=True).split("Initial Plan")[0]
    assert len(re.findall(r"\bExpand \[", text)) == 2 and text.count("FileScan") == 1
    assert "Generate" not in text and "partial_count" in text and text.count("WindowGroupLimit") == 2
    # The value shuffle is spread by value, not by column alone.
    assert re.search(r"Exchange hashpartitioning\(col_id#\d+, lane_0", text)


def test_distinct_and_rankings_share_the_value_shuffle(spark, sf, plan):
    text = plan(profile.column_metrics(I.table(spark, sf, "lineitem")), run=True)
    final = text.split("Initial Plan")[0]
    assert "ReusedExchange [col_id" in final
    assert len(re.findall(r"FileScan", final)) == 2


def test_a_spread_source_is_read_once(spark, sf, plan, monkeypatch):
    monkeypatch.setattr(tables, "SPREAD_BYTES", 1 << 10)
    df = I.table(spark, sf, "lineitem", spread=True)
    final = plan(profile.column_metrics(df), run=True).split("Initial Plan")[0]
    assert final.count("FileScan") == 1


def test_file_names_are_not_matched_by_a_pattern(spark, sf, plan):
    for key in ("src_column_files", "src_column_files_inferred", "sw_profile_files"):
        text = plan(registry.queries()[key](spark, sf))
        assert "FileScan text" in text and "regexp_extract" not in text, key


def test_semantic_profile_is_one_scan_with_partial_counts(spark, sf, plan):
    values = I.table(spark, sf, "pages").select(F.lit("url").alias("column_name"), F.col("url").alias("value"))
    text = plan(semantic.semantic_profile(values))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1
    assert "partial_count" in text and "INSET" in text


def test_sample_is_a_filter(spark, sf, plan):
    text = plan(pilot_sample(I.keyed_cells(spark, sf), F.col("row_key")))
    assert "Exchange" not in text and "Window" not in text


def test_reports_aggregate_first(spark, sf, plan):
    requests = I.requests(spark, sf)
    top = plan(reports.top_complaints(requests, names=I.REQUEST_COLUMNS))
    assert "partial_count" in top and top.count("WindowGroupLimit") == 2
    assert "Exchange" not in plan(reports.complaints_over_time(requests, names=I.REQUEST_COLUMNS))


def test_borough_filter_reaches_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "requests")
    spark.sql("SELECT 'BRONX' AS Borough, 'Noise' AS `Complaint Type`, 1 AS other").write.parquet(path)
    text = plan(reports.top_complaints(spark.read.parquet(path)))
    assert "PushedFilters: [In(Borough" in text and "other" not in text.split("ReadSchema")[1]


def test_weighted_and_plain_counts_agree(spark):
    rows = [("a", "10001", 2), ("b", "10001", 1), ("a", None, 3), ("b", "RED", 4)]
    weighted = spark.createDataFrame(rows, "column_name string, value string, n long")
    plain = spark.createDataFrame([r[:2] for r in rows for _ in range(r[2])], "column_name string, value string")
    names = spark.createDataFrame([("Red",)], "name string")
    found = detectors(neighbourhoods=names)
    counts = [{r.column_name: r for r in semantic.detector_counts(v, found).collect()} for v in (weighted, plain)]
    assert counts[0] == counts[1]
    a, b = counts[0]["a"], counts[0]["b"]
    assert (a.zip_code, b.zip_code, b.color, b.neighbourhood, a.neighbourhood) == (2, 1, 4, 4, 0)
    assert (a[semantic.NON_EMPTY], b[semantic.NON_EMPTY]) == (2, 5)


def exchanges(text):
    return len(re.findall(r"\bExchange ", text))


def test_many_datasets_take_the_shuffles_of_one(spark, sf, plan):
    some = [I.table(spark, sf, name) for name in ("customer", "part", "orders")]
    counts = []
    for n in (3, 20):
        text = plan(profile.dataset_profiles({f"d{i}": some[i % 3] for i in range(n)}))
        counts.append(exchanges(text))
        assert text.count("FileScan") % n == 0
    assert counts[0] == counts[1] <= exchanges(plan(profile.profile(some[0]))) + 1


def test_long_texts_do_not_cross_the_value_exchange(spark, plan):
    docs = spark.range(50).selectExpr("repeat(concat('long text ', id % 7), 100) AS text")
    text = plan(ranked_values(to_cells(docs), ("frequent",)), run=True).split("Initial Plan")[0]
    # what is counted and shuffled is the lead, its length and a digest
    assert re.search(r"Exchange hashpartitioning\(col_id#\d+, lane_0#\d+, tail#\d+", text)
    assert re.search(r"CASE WHEN \(length\(lane_0#\d+\) > 64\) THEN substring\(lane_0#\d+, 1, 64\)", text)
    # whole texts are grouped only where they met a winner, and digests are no key of that join
    (join,) = [j for j in re.findall(r"BroadcastHashJoin \[(.*?)\], \[", text) if "lead" in j]
    assert join.startswith("col_id") and "tail" not in join and "md5" not in join


def test_short_columns_are_not_read_again(spark, sf, plan):
    df = I.table(spark, sf, "lineitem")
    final = plan(profile.column_metrics(df), run=True).split("Initial Plan")[0]
    assert len(re.findall(r"FileScan", final)) == 2


def test_numbers_need_no_single_task(spark, tmp_path, plan):
    listing = spark.range(1000).selectExpr("concat('/d/', id, '.gz') AS path", "id % 10 AS length")
    assert "Window" not in plan(catalogue.first_datasets(listing, 900))
    (tmp_path / "m.txt").write_text("['a.b.c.d']")
    text = plan(read_manifest(spark, str(tmp_path / "m.txt")))
    assert "wholetext" not in text and "SinglePartition" not in text

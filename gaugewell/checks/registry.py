"""The registered queries: each operator on whole test tables, flat and comparable.

Doubles are rounded and arrays joined with ``|`` so that another engine can be
compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.checks import inputs as I
from gaugewell.functions import detectors as D
from gaugewell.operators.cells import to_cells, union_cells
from gaugewell.operators.ranks import FREQUENT, LONGEST, SHORTEST, distinct_counts, ranked_values
from gaugewell.operators.sample import pilot_sample
from gaugewell.operators.scalars import SECTIONS, scalar_metrics
from gaugewell.plans import catalogue, profile, reports, semantic
from gaugewell.session import scratch_path
from gaugewell.sinks import files as sinks
from gaugewell.sources import listing as listings
from gaugewell.sources import tables as sources

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 4


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(n, DIGITS).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes]
    )


# --- generic profile -------------------------------------------------------


def _scalars(df: DataFrame, sections: tuple[str, ...], **options) -> DataFrame:
    cells = to_cells(df, **options)
    metrics = scalar_metrics(cells, sections)
    return _rounded(metrics.withColumn("column_name", cells.name_of(F.col("col_id"))).drop("col_id"))


def _fill(metric: str) -> Query:
    return lambda spark, sf: _scalars(I.mixed_orders(spark, sf), ("fill",)).select("column_name", metric)


def _section(section: str) -> Query:
    return lambda spark, sf: _scalars(I.mixed_orders(spark, sf), (section,))


def _text_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _scalars(I.mixed_orders(spark, sf), ("text",)).where("string_count > 0")


def _ranked(ranking: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        cells = to_cells(I.mixed_orders(spark, sf))
        ranked = ranked_values(cells, (ranking,))
        return ranked.select(
            cells.name_of(F.col("col_id")).alias("column_name"), F.col("rank").cast("bigint").alias("rank"), "value", "n"
        )

    return run


def _ranked_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Rankings over whole texts, shown by digest."""
    cells = to_cells(I.table(spark, sf, "documents", spread=True))
    return ranked_values(cells).select(
        cells.name_of(F.col("col_id")).alias("column_name"),
        "ranking",
        F.col("rank").cast("bigint").alias("rank"),
        F.md5("value").alias("digest"),
        F.length("value").cast("bigint").alias("chars"),
        "n",
    )


def _distinct_exact(spark: SparkSession, sf: str) -> DataFrame:
    cells = to_cells(I.table(spark, sf, "lineitem", spread=True))
    return distinct_counts(cells).select(
        cells.name_of(F.col("col_id")).alias("column_name"), "number_distinct_values"
    )


def _distinct_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The estimate beside the exact count: within three standard errors or not."""
    rsd = 0.05
    cells = to_cells(I.table(spark, sf, "lineitem", spread=True))
    estimate = scalar_metrics(cells, (), approx_distinct=True, rsd=rsd).withColumnRenamed(
        "number_distinct_values", "estimate"
    )
    exact = F.col("number_distinct_values")
    error = F.abs(F.col("estimate") - exact)
    return estimate.join(distinct_counts(cells), "col_id").select(
        cells.name_of(F.col("col_id")).alias("column_name"),
        exact.alias("exact"),
        (error <= 3 * rsd * exact).alias("within_three_errors"),
    )


def flat_profile(metrics: DataFrame) -> DataFrame:
    """Profile structs as one row per column and section, of each dataset where there are several."""
    lead = [c for c in ("dataset_id",) if c in metrics.columns]
    return flat_columns(profile.column_profiles(metrics).select(*lead, "profile.*"), *lead)


def flat_columns(entry: DataFrame, *lead: str) -> DataFrame:
    """Column profiles as one row per column and section."""
    rows = entry.select(
        *lead,
        "column_name",
        "number_non_empty_cells",
        "number_empty_cells",
        "number_distinct_values",
        F.array_join("frequent_values", "|").alias("frequent_values"),
        F.inline("data_types"),
    )
    real = F.col("type") == profile.REAL_TYPE

    def shown(name: str) -> list[Column]:
        return [
            F.when(~real, F.col(name)).alias(name),
            F.when(real, F.col(name).cast("double")).alias(f"real_{name}"),
        ]

    return _rounded(
        rows.select(
            *lead,
            "column_name",
            "number_non_empty_cells",
            "number_empty_cells",
            "number_distinct_values",
            "frequent_values",
            "type",
            "count",
            *shown("max_value"),
            *shown("min_value"),
            "mean",
            "stddev",
            F.array_join("shortest_values", "|").alias("shortest_values"),
            F.array_join("longest_values", "|").alias("longest_values"),
            "average_length",
        )
    )


def _dotted(spark: SparkSession, sf: str) -> DataFrame:
    return I.mixed_orders(spark, sf).withColumnRenamed("name", "na.me")


def _union_profiles(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "mixed": I.mixed_orders(spark, sf),
        "customer": I.table(spark, sf, "customer"),
        "empty": I.table(spark, sf, "customer").where("false"),
        "part": I.table(spark, sf, "part"),
    }
    return flat_profile(profile.dataset_metrics(tables))


def _native_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The date section of tables whose dates are dates."""
    tables = {name: I.table(spark, sf, name) for name in ("lineitem", "orders")}
    cells = union_cells(tables)
    metrics = scalar_metrics(cells, ("date",), native_dates=True).where("date_count IS NOT NULL")
    column = F.col("col_id")
    return metrics.select(
        cells.dataset_of(column).alias("dataset_id"), cells.name_of(column).alias("column_name"), "date_count", "date_max_value", "date_min_value"
    )


# --- sources and sinks -----------------------------------------------------


def _written_tsv(df: DataFrame, label: str, header: bool) -> str:
    path = scratch_path(df.sparkSession, label)
    writer = df.write.option("sep", sources.TAB).option("header", header).option("compression", "gzip")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def _tsv_header(spark: SparkSession, sf: str) -> DataFrame:
    path = _written_tsv(I.requests(spark, sf), "requests.tsv.gz", True)
    return sources.read_table(spark, path).withColumn("request_id", F.col("request_id").cast("bigint"))


def _tsv_headerless(spark: SparkSession, sf: str) -> DataFrame:
    names = I.table(spark, sf, "part").selectExpr("concat('p', p_partkey) AS id", "p_name AS name")
    return sources.read_catalogue(spark, _written_tsv(names, "datasets.tsv", False))


def _column_file_cells(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of detector cells written as column files and read back together."""
    path = scratch_path(spark, "columns")
    cells = I.detector_cells(spark, sf)
    sinks.write_column_files(cells.select(F.format_string("d1.%s.1.2", "column_name").alias("file_name"), "value"), path)
    return sources.read_column_files(spark, path, escaped=True)


def _inferred_files(spark: SparkSession, sf: str) -> DataFrame:
    """Column files typed first, so that their cells are printed anew."""
    path = scratch_path(spark, "numbers")
    sinks.write_column_files(I.number_files(spark, sf), path)
    return sources.read_column_files(spark, path, infer=True)


def _staged_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables written as gzip files with a header, staged and typed together, then profiled."""
    base = scratch_path(spark, "tables")
    tables = {"mixed": I.mixed_orders(spark, sf), "customer": I.table(spark, sf, "customer"), "part": I.table(spark, sf, "part")}
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base}/{name}.tsv.gz"
        writer = df.write.option("sep", sources.TAB).option("header", True).option("compression", "gzip")
        writer.csv(paths[name])
    return flat_profile(profile.dataset_metrics(sources.staged_tables(spark, paths)))


def _column_files(spark: SparkSession, sf: str) -> DataFrame:
    return _column_file_cells(spark, sf).select(
        "file_name", sources.column_of_file(F.col("file_name")).alias("column_name"), "value"
    )


def _file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of the files of a table written as lines, a folder for each status."""
    base = scratch_path(spark, "listing")
    lines = I.table(spark, sf, "orders").selectExpr("o_orderstatus", "concat_ws(',', o_orderkey, o_orderpriority) AS line")
    lines.write.partitionBy("o_orderstatus").text(base)
    found = listings.list_files(spark, base, glob="*.txt", recursive=True)
    status = F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("status")
    return found.groupBy(status).agg(F.sum("length").alias("bytes"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    names = I.table(spark, sf, "part").selectExpr(
        "concat_ws('.', concat('ds', p_size), replace(p_brand, '#', '_'), '1', CASE WHEN p_size > 1 THEN '2' END) AS name"
    )
    quoted = names.distinct().selectExpr(
        "concat('[', listagg(concat('''', name, ''''), ', ') WITHIN GROUP (ORDER BY name), ']') AS value"
    )
    quoted.coalesce(1).write.text(path)
    return listings.read_manifest(spark, path)


def _profile_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "profile.json")
    nested = profile.profile(I.mixed_orders(spark, sf), "orders")
    sinks.append_json(nested, path)
    columns = spark.read.schema(nested.schema).json(path).select("dataset_name", F.inline("columns"))
    return flat_columns(columns, "dataset_name")


def _profiles_written_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles written twice, as by a run that broke off: each is there once."""
    path = scratch_path(spark, "profiles.json")
    tables = {"customer": I.table(spark, sf, "customer"), "part": I.table(spark, sf, "part")}
    nested = sources.staged(profile.dataset_profiles(tables))
    sinks.replace_json(nested.where("dataset_id = 'part'"), path, "dataset_id")
    sinks.replace_json(nested, path, "dataset_id")
    columns = spark.read.schema(nested.schema).json(path).select("dataset_id", F.inline("columns"))
    return flat_columns(columns, "dataset_id")


def _semantic_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "semantic.json")
    nested = semantic.semantic_profile(I.rule_cells(spark, sf), _all_detectors(spark, sf))
    sinks.append_json(nested, path)
    return _flat_types(spark.read.schema(nested.schema).json(path))


def _csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report.csv")
    top = reports.top_complaints(I.requests(spark, sf), names=I.REQUEST_COLUMNS)
    sinks.write_csv(top.select("borough", "complaint_type", "n"), path, partition_by="borough")
    return spark.read.schema("complaint_type string, n bigint, borough string").csv(path)


def _csv_single(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "daily.csv")
    sinks.write_single_csv(reports.daily_requests(I.requests(spark, sf), names=I.REQUEST_COLUMNS), path)
    return spark.read.option("header", True).schema("day date, n bigint").csv(path)


# --- catalogue -------------------------------------------------------------


def _first_n(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.first_datasets(I.listing(spark, sf), 300)


def _excluded(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.exclude(_first_n(spark, sf), I.excluded(spark, sf)).select("dataset_id", "ordinal")


def _name_lookup(spark: SparkSession, sf: str) -> DataFrame:
    files = I.listing(spark, sf).select(catalogue.dataset_id(F.col("path")).alias("dataset_id"), "length")
    return catalogue.with_names(files, I.display_names(spark, sf)).select("dataset_id", "length", "dataset_name")


# --- detectors and semantic profile ---------------------------------------


def _all_detectors(spark: SparkSession, sf: str, **options) -> list[D.Detector]:
    return D.detectors(neighbourhoods=I.neighbourhoods(spark, sf), **options)


def _detector(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        (found,) = [d for d in _all_detectors(spark, sf, opt_in=True) if d.name == name]
        counts = semantic.detector_counts(I.detector_cells(spark, sf), [found])
        return counts.select("column_name", F.col(name).alias("n"))

    return run


def _non_empty(spark: SparkSession, sf: str) -> DataFrame:
    counts = semantic.detector_counts(I.detector_cells(spark, sf), [])
    return counts.select("column_name", F.col(semantic.NON_EMPTY).alias("n"))


def _fixed_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    found = [d for d in _all_detectors(spark, sf, fix_vocab=True) if d.name in ("area_of_study", "location_type")]
    return semantic.long_counts(
        semantic.detector_counts(I.detector_cells(spark, sf), found), found
    )


def _flat_types(nested: DataFrame) -> DataFrame:
    return nested.select("column_name", F.inline("semantic_types"))


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    drawn = pilot_sample(I.keyed_cells(spark, sf), F.col("row_key"))
    return drawn.select("column_name", F.md5("value").alias("digest"))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return semantic.candidates(I.keyed_cells(spark, sf), F.col("row_key"), _all_detectors(spark, sf))


def _full_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = _all_detectors(spark, sf)
    return semantic.long_counts(semantic.detector_counts(I.detector_cells(spark, sf), found), found)


def _semantic_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_types(semantic.semantic_profile(I.detector_cells(spark, sf), _all_detectors(spark, sf)))


def _semantic_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of a table, numbers included, read as text."""
    values = semantic.counted_column_values(I.table(spark, sf, "lineitem", spread=True))
    return _flat_types(semantic.semantic_profile(values, _all_detectors(spark, sf, opt_in=True)))


def _semantic_files(spark: SparkSession, sf: str) -> DataFrame:
    """Column files under their file names, profiled in one job."""
    nested = semantic.semantic_profile(
        _column_file_cells(spark, sf),
        _all_detectors(spark, sf),
        column="file_name",
        name=sources.column_of_file(F.col("file_name")),
    )
    return nested.select("file_name", "column_name", F.inline("semantic_types"))


def _name_rules(spark: SparkSession, sf: str) -> DataFrame:
    types = _flat_types(semantic.semantic_profile(I.rule_cells(spark, sf), []))
    return types.where("semantic_type <> 'other'").select("column_name", "semantic_type", "count")


def _other(spark: SparkSession, sf: str) -> DataFrame:
    types = _flat_types(semantic.semantic_profile(I.rule_cells(spark, sf), []))
    return types.where("semantic_type = 'other'")


# --- reports ---------------------------------------------------------------


def _report(report: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf: report(I.requests(spark, sf), names=I.REQUEST_COLUMNS, **options)


def _ranked_report(report: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = report(I.requests(spark, sf), names=I.REQUEST_COLUMNS)
        return found.withColumn("rank", F.col("rank").cast("bigint"))

    return run


DETECTOR_KEYS = {
    f"sd_{key}": name
    for key, name in {
        "middle_initial": "MiddleInitial",
        "latitude": "Latitude",
        "longitude": "Longitude",
        **{
            n: n
            for n in (
                "zip_code", "phone_number", "school_name", "street_name", "lat_lon_cord", "college_name",
                "borough", "park_playground", "website", "business_name", "subject_in_school",
                "neighbourhood", "city_agency", "school_level", "building_classification",
                "area_of_study", "car_make", "location_type", "color", "address",
            )
        },
    }.items()
}


def queries() -> dict[str, Query]:
    return {
        "gp_non_empty": _fill("number_non_empty_cells"),
        "gp_empty": _fill("number_empty_cells"),
        "gp_distinct_exact": _distinct_exact,
        "gp_distinct_approx": _distinct_approx,
        "gp_frequent_values": _ranked(FREQUENT),
        "gp_shortest_values": _ranked(SHORTEST),
        "gp_longest_values": _ranked(LONGEST),
        "gp_ranked_documents": _ranked_documents,
        "gp_integer_stats": _section("integer"),
        "gp_real_stats": _section("real"),
        "gp_date_stats": _section("date"),
        "gp_text_stats": _text_stats,
        "gp_text_only_strings": lambda spark, sf: _scalars(I.table(spark, sf, "orders"), ("text",)).where(
            "string_count > 0"
        ),
        "gp_scalar_all": lambda spark, sf: _scalars(I.table(spark, sf, "lineitem", spread=True), SECTIONS),
        "gp_dotted_column": lambda spark, sf: flat_profile(profile.column_metrics(_dotted(spark, sf))),
        "gp_profile": lambda spark, sf: flat_profile(profile.column_metrics(I.mixed_orders(spark, sf))),
        "gp_profile_lineitem": lambda spark, sf: flat_profile(
            profile.column_metrics(I.table(spark, sf, "lineitem", spread=True))
        ),
        "gp_native_dates": _native_dates,
        "so_union_profiles": _union_profiles,
        "src_tsv_header": _tsv_header,
        "src_tsv_headerless": _tsv_headerless,
        "src_column_files": _column_files,
        "src_column_files_inferred": _inferred_files,
        "src_staged_tables": _staged_tables,
        "src_file_listing": _file_listing,
        "src_manifest": _manifest,
        "snk_profile_json": _profile_json,
        "snk_profiles_written_twice": _profiles_written_twice,
        "snk_semantic_json": _semantic_json,
        "snk_csv": _csv,
        "snk_csv_single": _csv_single,
        "cat_first_n": _first_n,
        "cat_exclude": _excluded,
        "cat_name_lookup": _name_lookup,
        **{key: _detector(name) for key, name in DETECTOR_KEYS.items()},
        "sd_non_empty": _non_empty,
        "sd_fixed_vocabulary": _fixed_vocabulary,
        "sw_sample": _sample,
        "sw_candidates": _candidates,
        "sw_full_counts": _full_counts,
        "sw_name_rules": _name_rules,
        "sw_other": _other,
        "sw_profile": _semantic_profile,
        "sw_profile_table": _semantic_table,
        "sw_profile_files": _semantic_files,
        "rq_top3_complaints": _ranked_report(reports.top_complaints),
        "rq_top_agency": _ranked_report(reports.top_agencies),
        "rq_daily": _report(reports.daily_requests),
        "rq_daily_mobile": _report(reports.daily_requests, channel=reports.MOBILE),
        "rq_avg_close_days": lambda spark, sf: _rounded(
            reports.average_close_days(I.requests(spark, sf), names=I.REQUEST_COLUMNS)
        ),
        "rq_complaints_over_time": _report(reports.complaints_over_time),
        "rq_borough_totals": _report(reports.borough_totals),
    }

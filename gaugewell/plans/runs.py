"""Whole runs: a folder of datasets, a manifest of columns, a request table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.functions.detectors import Detector, detectors
from gaugewell.plans import catalogue, profile, reports, semantic
from gaugewell.sinks.files import finished, note_finished, replace_json, write_csv, write_single_csv
from gaugewell.sources import listing, tables

# Name of the catalogue within a dataset folder.
CATALOGUE_FILE = "datasets.tsv"


def profile_folder(
    spark: SparkSession,
    folder: str,
    n: int,
    out: str,
    excluded: DataFrame | None = None,
    batch: int = 20,
    done: Iterable[str] = (),
    **options,
) -> list[str]:
    """Profile the ``n`` smallest datasets of a folder into ``out``, a folder per dataset.

    ``batch`` datasets are staged, typed and profiled together, in as many jobs as one would
    take.  A batch is noted beside ``out`` when it is written; a run that broke off is taken
    up again by calling it again: what is noted is left out, and a batch that was written
    but not noted replaces itself.  Ids in ``done`` are left out as well.  Returns the ids
    profiled; a file without a header line has no profile.
    """
    files = listing.list_files(spark, folder)
    chosen = catalogue.first_datasets(files, n)
    if excluded is not None:
        chosen = catalogue.exclude(chosen, excluded)
    chosen = chosen.join(finished(spark, out).withColumnRenamed("key", "dataset_id"), "dataset_id", "left_anti")
    names = tables.read_catalogue(spark, f"{folder.rstrip('/')}/{CATALOGUE_FILE}")
    # n paths, smallest first: the plan of the run, not its data.
    listed = set(done)
    todo = [
        (r["dataset_id"], r["path"])
        for r in chosen.orderBy("ordinal").collect()
        if r["dataset_id"] not in listed
    ]
    for start in range(0, len(todo), batch):
        part = dict(todo[start : start + batch])
        frames = tables.staged_tables(spark, part)
        if frames:
            replace_json(profile.dataset_profiles(frames, names, **options), out, "dataset_id")
        note_finished(spark.createDataFrame([(key,) for key in part], "dataset_id string"), out, "dataset_id")
    return [key for key, _ in todo]


def semantic_run(
    spark: SparkSession,
    folder: str,
    manifest: str,
    out: str,
    n: int | None = None,
    found: list[Detector] | None = None,
) -> DataFrame:
    """Semantic profile of the first ``n`` columns of a manifest, in one job.

    Every valid column of the manifest has a row, one without cells too.  The
    profile is written to ``out``, a folder per column file, so a run that is repeated
    replaces itself; the manifest's rejected names are returned.
    """
    found = detectors() if found is None else found
    entries = listing.read_manifest(spark, manifest, n)
    wanted = entries.where("valid").select("file_name", F.col("column_name").alias("name")).distinct()
    base = folder.rstrip("/")
    paths = [f"{base}/{r['file_name']}" for r in wanted.select("file_name").collect()]
    values = tables.read_column_files(spark, paths)
    counts = semantic.detector_counts(values, found, "file_name")
    counts = wanted.join(counts, "file_name", "left").fillna(0)
    replace_json(semantic.semantic_types(counts, found, "file_name", F.col("name")), out, "file_name", keep=False)
    return entries.where("NOT valid").select("pos", "file_name")


def report_run(
    spark: SparkSession, path: str, out: str, names: reports.RequestColumns = reports.PUBLISHED
) -> None:
    """All reports of a request table, each in its own folder under ``out``.

    The table is staged once, so the text is parsed once for all of them.
    """
    requests = reports.register_view(tables.staged(tables.spread(tables.read_table(spark, path))))
    base = out.rstrip("/")
    write_csv(reports.top_complaints(requests, names=names), f"{base}/top_complaints", partition_by="borough")
    write_csv(reports.top_agencies(requests, names=names), f"{base}/top_agencies", partition_by="borough")
    write_csv(reports.complaints_over_time(requests, names=names), f"{base}/complaints_over_time", header=True)
    for name, report in {
        "daily": reports.daily_requests(requests, names=names),
        "daily_mobile": reports.daily_requests(requests, reports.MOBILE, names=names),
        "close_days": reports.average_close_days(requests, names=names),
        "borough_totals": reports.borough_totals(requests, names=names),
    }.items():
        write_single_csv(report, f"{base}/{name}")

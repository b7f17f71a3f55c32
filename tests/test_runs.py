"""Whole runs on small folders."""

import gzip
import json

import pytest

from gaugewell.plans import runs
from gaugewell.sources import listing

from test_files import REQUESTS


def lines(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_profile_folder(spark, tmp_path):
    folder, out = tmp_path / "data", str(tmp_path / "out")
    folder.mkdir()
    for name, rows in {"bb-1": 40, "aa-2": 10, "cc-3": 4000, "dd-4": 90_000}.items():
        with gzip.open(folder / f"{name}.tsv.gz", "wt") as f:
            f.write("k\tsome col\n" + "".join(f"{i}\tv{i % 3}\n" for i in range(rows)))
    (folder / "datasets.tsv").write_text("aa-2\tAlpha\ncc-3\tGamma\n")
    skipped = spark.createDataFrame([("bb-1",)], "dataset_id string")
    done = runs.profile_folder(spark, str(folder), 3, out, excluded=skipped, batch=1)
    assert done == ["aa-2", "cc-3"]
    got = {row["dataset_id"]: row for row in lines(spark, out)}
    assert {k: v["dataset_name"] for k, v in got.items()} == {"aa-2": "Alpha", "cc-3": "Gamma"}
    key, text = got["cc-3"]["columns"]
    assert key["number_distinct_values"] == 4000 and text["frequent_values"] == ["v0", "v1", "v2"]
    again = runs.profile_folder(spark, str(folder), 4, out, excluded=skipped)
    assert again == ["dd-4"] and len(lines(spark, out)) == 3
    assert runs.profile_folder(spark, str(folder), 4, out, excluded=skipped) == []


def test_a_run_that_breaks_off_is_repeated_without_doubles(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "data", str(tmp_path / "out")
    folder.mkdir()
    for name in ("aa", "bb", "cc"):
        with gzip.open(folder / f"{name}.tsv.gz", "wt") as f:
            f.write("k\n" + "1\n" * 9)
    (folder / "datasets.tsv").write_text("aa\tAlpha\n")

    def broken(*_):
        raise RuntimeError("between writing and noting")

    monkeypatch.setattr(runs, "note_finished", broken)
    with pytest.raises(RuntimeError):
        runs.profile_folder(spark, str(folder), 3, out, batch=2)
    assert len(lines(spark, out)) == 2
    monkeypatch.undo()
    assert runs.profile_folder(spark, str(folder), 3, out, batch=2) == ["aa", "bb", "cc"]
    assert sorted(row["dataset_id"] for row in lines(spark, out)) == ["aa", "bb", "cc"]


def test_a_batch_takes_as_many_jobs_as_one_dataset(spark, tmp_path):
    def jobs(folder, n, batch):
        group = f"{folder.name}-{batch}"
        spark.sparkContext.setJobGroup(group, group)
        runs.profile_folder(spark, str(folder), n, str(folder / f"out{batch}"), batch=batch)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    counts = []
    for n in (1, 6):
        folder = tmp_path / f"of{n}"
        folder.mkdir()
        for i in range(n):
            with gzip.open(folder / f"d{i}.tsv.gz", "wt") as f:
                f.write("k\tv\n" + f"1\tx{i}\n" * 9)
        (folder / "datasets.tsv").write_text("d0\tAlpha\n")
        counts.append(jobs(folder, n, 20))
    assert counts[1] <= counts[0] + 2


def test_semantic_run(spark, tmp_path):
    folder = tmp_path / "columns"
    folder.mkdir()
    (folder / "d1.Colour.a.b").write_text("RED\nNAVY\nsky\n")
    (folder / "d2.First_Name.a.b").write_text("Ann\nBob\n")
    (folder / "d3.Empty.a.b").write_text("")
    (folder / "d4.Late.a.b").write_text("RED\n")
    manifest = tmp_path / "manifest.txt"
    manifest.write_text("['d1.Colour.a.b', 'd2.First_Name.a.b', 'odd', 'd3.Empty.a.b', 'd4.Late.a.b']\n")
    out = str(tmp_path / "out")
    rejected = runs.semantic_run(spark, str(folder), str(manifest), out, n=4)
    assert [(r.pos, r.file_name) for r in rejected.collect()] == [(2, "odd")]
    got = {row["column_name"]: row["semantic_types"] for row in lines(spark, out)}
    assert got["First_Name"] == [{"semantic_type": "person_name", "count": 2}]
    assert got["Empty"] == [{"semantic_type": "other", "label": "Empty", "count": 0}]
    assert {"semantic_type": "color", "count": 2} in got["Colour"] and "Late" not in got
    runs.semantic_run(spark, str(folder), str(manifest), out, n=4)
    assert len(lines(spark, out)) == 3


def test_manifest_of_several_lines(spark, tmp_path):
    path = tmp_path / "manifest.txt"
    path.write_text("['a.A.x.y',\n 'b.B.x.y',\n 'c.C.x.y']\n")
    rows = listing.read_manifest(spark, str(path)).orderBy("pos").collect()
    assert [(r.pos, r.column_name) for r in rows] == [(0, "A"), (1, "B"), (2, "C")]


def test_report_run(spark, tmp_path):
    with gzip.open(tmp_path / "erm.tsv.gz", "wt") as f:
        f.write(REQUESTS)
    out = tmp_path / "reports"
    runs.report_run(spark, str(tmp_path / "erm.tsv.gz"), str(out))
    names = {p.name for p in out.iterdir()}
    assert names == {
        "top_complaints", "top_agencies", "complaints_over_time", "daily", "daily_mobile", "close_days",
        "borough_totals",
    }
    assert (out / "top_complaints" / "borough=BRONX").is_dir()
    daily = spark.read.option("header", True).csv(str(out / "daily"))
    assert daily.columns == ["day", "n"] and daily.count() == 3

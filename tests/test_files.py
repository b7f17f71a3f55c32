"""Sources, sinks, catalogue and reports on small files."""

import gzip
import random
from collections import Counter
from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gaugewell.operators.numbering import numbered
from gaugewell.plans import catalogue, profile, reports
from gaugewell.session import byte_size, scratch_path
from gaugewell.sinks import files as sinks
from gaugewell.sources import listing, tables

REQUESTS = """Unique Key\tCreated Date\tClosed Date\tAgency Name\tComplaint Type\tBorough\tOpen Data Channel Type
1\t10/12/2019 10:00:00 AM\t10/14/2019 10:00:00 AM\tA\tNoise\tBRONX\tMOBILE
2\t10/12/2019 11:00:00 AM\t\tA\tNoise\tBRONX\tPHONE
3\t10/13/2019 10:00:00 AM\t10/14/2019 10:00:00 AM\tB\tHeat\tBRONX\tMOBILE
4\tunknown\t10/14/2019 10:00:00 AM\tC\tHeat\tQUEENS\tONLINE
5\t10/13/2019\t10/13/2019\tA\tDirt\tUnspecified\tPHONE
"""


@pytest.fixture()
def requests_file(tmp_path):
    path = tmp_path / "erm.tsv.gz"
    with gzip.open(path, "wt") as f:
        f.write(REQUESTS)
    return str(path)


def test_table_with_header(spark, requests_file, monkeypatch):
    df = tables.read_table(spark, requests_file)
    assert dict(df.dtypes)["Unique Key"] == "int" and df.count() == 5
    assert df.where("`Closed Date` IS NULL").count() == 1
    assert tables.spread(df) is df
    monkeypatch.setattr(tables, "SPREAD_BYTES", 16)
    spread = tables.spread(df)
    assert spread.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(map(str, spread.collect())) == sorted(map(str, df.collect()))
    staged = tables.staged(df)
    assert staged.schema == df.schema and sorted(map(str, staged.collect())) == sorted(map(str, df.collect()))
    named = tables.read_table(spark, requests_file, schema="k string, created string")
    assert named.columns == ["k", "created"]


def test_spread_counts_the_tasks_of_the_scan(spark, requests_file, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SPREAD_BYTES", 16)
    plain = tmp_path / "erm.tsv"
    plain.write_text(REQUESTS)
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "16b")
    try:
        split = tables.read_table(spark, str(plain), "k string")
        assert tables.spread(split) is split
        # a gzip file is one task, however large it is
        one = tables.read_table(spark, requests_file, "k string")
        assert one.rdd.getNumPartitions() == 1
        assert tables.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


def test_reports(spark, requests_file):
    df = tables.read_table(spark, requests_file)
    top = {(r.borough, r.complaint_type, r.n, r["rank"]) for r in reports.top_complaints(df).collect()}
    assert top == {("BRONX", "Noise", 2, 1), ("BRONX", "Heat", 1, 2), ("QUEENS", "Heat", 1, 1)}
    agencies = {(r.borough, r.agency_name, r.n) for r in reports.top_agencies(df).collect()}
    assert agencies == {("BRONX", "A", 2), ("QUEENS", "C", 1)}
    daily = {r.day: r.n for r in reports.daily_requests(df).collect()}
    assert daily == {date(2019, 10, 12): 2, date(2019, 10, 13): 2, None: 1}
    mobile = {r.day: r.n for r in reports.daily_requests(df, reports.MOBILE).collect()}
    assert mobile == {date(2019, 10, 12): 1, date(2019, 10, 13): 1}
    days = {r.agency_name: r.avg_days for r in reports.average_close_days(df).collect()}
    assert days == {"A": 1.0, "B": 1.0, "C": None}
    assert reports.complaints_over_time(df).where("day IS NULL").count() == 1
    totals = {r.borough: r.n for r in reports.borough_totals(df).collect()}
    assert totals == {"BRONX": 3, "QUEENS": 1}
    assert spark.sql("SELECT count(*) FROM Complaints").first()[0] == 5


def test_column_files_keep_cells_as_written(spark, tmp_path):
    files = {"d1.Zip.a.b": ["007", "40.710", "12"], "d 2.Col+x.a.b": ["x\ty", "", '"z, \'w"', " a "]}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = sorted(map(repr, ((r.file_name, r.value) for r in tables.read_column_files(spark, str(tmp_path)).collect())))
    # a blank line is a NULL cell; a line is tab-separated, its first field the cell
    assert rows == sorted(map(repr, [
        ("d1.Zip.a.b", "007"), ("d1.Zip.a.b", "40.710"), ("d1.Zip.a.b", "12"),
        ("d 2.Col+x.a.b", "x"), ("d 2.Col+x.a.b", None), ("d 2.Col+x.a.b", "z, 'w"), ("d 2.Col+x.a.b", " a "),
    ]))
    typed = tables.read_column_files(spark, [str(tmp_path / "d1.Zip.a.b")], infer=True)
    assert {r.value for r in typed.collect()} == {"7.0", "40.71", "12.0"}
    name = spark.range(1).select(tables.column_of_file(F.lit("d1.Zip.a.b"))).first()[0]
    assert name == "Zip"


def test_any_cell_survives_a_column_file(spark, tmp_path):
    cells = ["a\nb", "\\n", "\\", "", None, None, "x\ty", "r\rz", "\\\\n\n\\", "\\e", "é\u2028", " ", "\r\n"]
    rng = random.Random(1)
    cells += ["".join(rng.choice("\\nrte\n\r\t ") for _ in range(rng.randint(0, 9))) for _ in range(500)]
    rows = [(f"d{i % 3}.a b%:=+{i % 2}.x.y", c) for i, c in enumerate(cells)]
    sinks.write_column_files(spark.createDataFrame(rows, "file_name string, value string").repartition(4), str(tmp_path / "c"))
    got = tables.read_column_files(spark, str(tmp_path / "c"), escaped=True).collect()
    assert Counter(map(tuple, got)) == Counter(rows)


KINDS = {
    "int": ["1", "-7", "+8", "007", None],
    "bigint": ["1", "3000000000"],
    "decimal": ["1", "12345678901234567890"],
    "double": ["1", "2.50", "1e3", "-.5", "NaN"],
    "mixed": ["007", "40.710", "12"],
    "boolean": ["true", "FALSE"],
    "day": ["2020-01-02", "1999-12-31"],
    "text": ["1", "x"],
    "flag": ["true", "1"],
    "almost": ["1", "2.5", "2020-01-02"],
    "none": [None],
}


def test_names_of_column_files_are_cut_from_the_path_once(spark, tmp_path, plan):
    names = ["d1.plain.1.2", "d1.a+b c.1.2", "d1.50%25.1.2", "file_name=d1.own.1.2"]
    for name in names:
        (tmp_path / name).write_text("007\n1\n")
    folders = ["d1.x/y.1.2", "d1.50% +.1.2", "part-of.it.1.2"]
    written = spark.createDataFrame([(n, "1") for n in folders], "file_name string, value string")
    sinks.write_column_files(written, f"{tmp_path}/written")
    one = tmp_path / "alone" / "d1.folder.1.2"
    one.mkdir(parents=True)
    (one / "part-00000").write_text("x\n")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reads = [[str(tmp_path / n) for n in names], f"{tmp_path}/written", str(one)]
        cells = [tables.read_column_files(spark, paths, infer=True) for paths in reads]
        found = {(r["file_name"], r["value"]) for c in cells for r in c.collect()}
        text = plan(cells[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    plain = {(n.removeprefix("file_name="), v) for n in names for v in ("7", "1")}
    of_folders = {(n, "1") for n in folders} | {("d1.folder.1.2", "x")}
    assert found == plain | of_folders
    # no pattern is tried along the path, no cell is shuffled by its file, and no name computed twice
    assert "regexp_extract" not in text and "SortMergeJoin" not in text and "isnotnull(CASE" not in text


def test_inference_is_that_of_the_reader_in_one_scan(spark, tmp_path, plan):
    for name, cells in KINDS.items():
        (tmp_path / f"d.{name}.a.b").write_text("\n".join(c or "" for c in cells) + "\n")
    found = tables.read_column_files(spark, str(tmp_path), infer=True)
    got = Counter((r.file_name, r.value) for r in found.collect())
    want = Counter()
    for name in KINDS:
        one = spark.read.option("sep", "\t").option("inferSchema", True).csv(str(tmp_path / f"d.{name}.a.b"))
        if one.columns:
            want.update((f"d.{name}.a.b", r.v) for r in one.select(F.col("_c0").cast("string").alias("v")).collect())
    blanks = Counter((f"d.{name}.a.b", None) for name, cells in KINDS.items() if None in cells)
    assert got == want + blanks
    assert plan(found).split("Initial Plan")[0].count("FileScan") == 2


def gzipped(folder, name, text):
    with gzip.open(folder / f"{name}.tsv.gz", "wt") as f:
        f.write(text)
    return str(folder / f"{name}.tsv.gz")


def test_staged_tables_are_those_of_the_reader(spark, tmp_path):
    texts = {
        "requests": REQUESTS,
        "typed": "i\tl\tr\tb\td\tt\tdot.ted\n1\t3000000000\t1.5\ttrue\t2020-01-02\t2020-01-02 03:04:05\tx\n2\t1\t2\tFALSE\t2020-01-03\t2020-01-02\t\n",
        "odd": 'a\ta\t\t"q u"\n1\t2\t3\t"x, y"\n\n  \t \n4\n5\t6\t7\t8\t9\n',
        "head": "only\theader\n",
        "many": "k\tv\n" + "".join(f"{i}\tv{i % 3}\n" for i in range(20_000)),
    }
    paths = {key: gzipped(tmp_path, key, text) for key, text in texts.items()}
    paths["none"] = gzipped(tmp_path, "none", "")
    frames = tables.staged_tables(spark, paths)
    assert set(frames) == set(texts)
    for key, df in frames.items():
        plain = tables.read_table(spark, paths[key])
        assert df.dtypes == plain.dtypes, key
        assert Counter(map(str, df.collect())) == Counter(map(str, plain.collect())), key
    assert frames["many"].rdd.getNumPartitions() > 1
    assert tables.staged_tables(spark, {"none": paths["none"]}) == {}


def test_staged_tables_of_many_parts_have_a_header_in_each(spark, tmp_path):
    rows = spark.range(0, 900, 1, 3).selectExpr("id", "concat('v', id % 7) AS name", "id / 4 AS share")
    empty = rows.where("id < 0")
    paths = {key: f"{tmp_path}/{key}.tsv.gz" for key in ("parts", "empty")}
    for key, df in {"parts": rows, "empty": empty}.items():
        df.write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(paths[key])
    paths["single"] = gzipped(tmp_path, "single", "id\tname\n1\tx\n")
    frames = tables.staged_tables(spark, paths)
    assert set(frames) == set(paths)
    for key, df in frames.items():
        plain = tables.read_table(spark, paths[key])
        assert df.dtypes == plain.dtypes, key
        assert Counter(map(str, df.collect())) == Counter(map(str, plain.collect())), key
    assert frames["parts"].count() == 900


def test_catalogue_and_listing(spark, tmp_path):
    for name, size in {"b.tsv.gz": 30, "a.tsv.gz": 10, "c.tsv": 1, "z.tsv.gz": 10, "d.tsv.gz": 99}.items():
        (tmp_path / name).write_bytes(b"x" * size)
    (tmp_path / "datasets.tsv").write_text("a\tAlpha\nb\tBeta\nb\tAbeta\n")
    files = listing.list_files(spark, str(tmp_path))
    assert files.count() == 6
    first = catalogue.first_datasets(files, 3).orderBy("ordinal").collect()
    assert [(r.ordinal, r.dataset_id, r.length) for r in first] == [(1, "a", 10), (2, "z", 10), (3, "b", 30)]
    skipped = spark.createDataFrame([("a",)], "dataset_id string")
    kept = catalogue.exclude(catalogue.first_datasets(files, 3), skipped)
    names = tables.read_catalogue(spark, str(tmp_path / "datasets.tsv"))
    named = {(r.ordinal, r.dataset_name) for r in catalogue.with_names(kept, names).collect()}
    assert named == {(2, None), (3, "Abeta")}


def test_manifest(spark, tmp_path):
    (tmp_path / "m.txt").write_text("['d1.Zip.a.b', 'd2.Some Col.a.b', 'broken.name']\n['later.x.y.z']\n")
    rows = listing.read_manifest(spark, str(tmp_path / "m.txt")).orderBy("pos").collect()
    assert [(r.pos, r.dataset_id, r.column_name, r.valid) for r in rows] == [
        (0, "d1", "Zip", True), (1, "d2", "Some Col", True), (2, None, None, False), (3, "later", "x", True),
    ]
    assert listing.read_manifest(spark, str(tmp_path / "m.txt"), first=1).count() == 1


def test_a_manifest_of_a_million_names_is_many_tasks(spark, tmp_path):
    n = 1_000_000
    (tmp_path / "m.txt").write_text("[" + ", ".join(f"'d{i}.c.x.y'" for i in range(n)) + "]")
    found = listing.read_manifest(spark, str(tmp_path / "m.txt"))
    total = found.agg(F.count("*"), F.countDistinct("pos"), F.min("pos"), F.max("pos"), F.count_if(F.expr("dataset_id = concat('d', pos)"))).first()
    assert tuple(total) == (n, n, 0, n - 1, n)
    pieces = spark.read.option("lineSep", "'").text(str(tmp_path / "m.txt"))
    assert pieces.rdd.getNumPartitions() > 1


def test_numbers_follow_the_order(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 50), f"p{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "length long, path string").repartition(7)
    got = [(r.length, r.path) for r in numbered(df, "length", "path").orderBy("ordinal").collect()]
    assert got == sorted(rows)
    assert sorted(r.ordinal for r in numbered(df, F.desc("length")).collect()) == list(range(1, 3001))
    assert numbered(df.where("false"), "path").collect() == []


def test_json_sink_appends_and_drops_nulls(spark, tmp_path, sf):
    path = str(tmp_path / "p.json")
    nested = profile.profile(spark.sql("SELECT 'a' AS t, 1 AS n"), "one")
    sinks.append_json(nested, path)
    sinks.append_json(nested, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 2 and "label" not in lines[0] and '"type":"TEXT"' in lines[0] and '"mean":null' not in lines[0]
    assert spark.read.schema(nested.schema).json(path).distinct().collect() == nested.collect()


def test_csv_sinks(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 3 AS `Group No`", "id AS v").repartition(5)
    sinks.write_csv(df, str(tmp_path / "parts"), partition_by="Group No")
    assert len([p for p in (tmp_path / "parts").iterdir() if p.is_dir()]) == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_csv(df, str(tmp_path / "parts"))
    sinks.write_single_csv(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    back = spark.read.option("header", True).csv(str(tmp_path / "one"))
    assert back.columns == ["Group No", "v"] and back.count() == 1000


def session_with(folder, master):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_lies_in_the_sessions_folder(spark):
    cluster = session_with("hdfs:///shared/", "yarn")
    a, b = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert a.startswith("hdfs:///shared/x-") and a != b
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or scratch_path(spark, "x").startswith(configured)
    assert scratch_path(session_with(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch_path(session_with(None, "yarn"), "x")


@pytest.mark.parametrize("text,size", [("134217728b", 1 << 27), ("128m", 1 << 27), ("1GB", 1 << 30), ("77", 77)])
def test_byte_sizes(text, size):
    assert byte_size(text) == size

"""Tab-separated tables and column files."""

from __future__ import annotations

import csv
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugewell.session import scratch_path
from gaugewell.sources import inference

# Fixed value: field separator of every text source.
TAB = "\t"

CATALOGUE_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]
)
VALUE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


# Least bytes worth a task of their own when a source is spread.
SPREAD_BYTES = 256 << 10


def _scan_tasks(df: DataFrame) -> int:
    """Tasks that read a source, as planned: splits of its files, one for each gzip file."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def _source_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Redistribute the rows of a source that is read by fewer tasks than there are cores.

    A small table, one row group or one gzip file is read by one or a few tasks, and all that
    follows stays in them.  Such rows are dealt once to as many tasks as there are cores, or
    bytes for; a gzip file of any size is, as nothing splits it.  A source read by tasks
    enough is left alone.  ``df`` is a source as read, before any join or aggregate.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = _scan_tasks(df)
    parts = min(cores, -(-_source_bytes(df) // SPREAD_BYTES))
    if tasks >= cores or parts <= tasks:
        return df
    return _dealt(df, parts)


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    # By row number, not round robin: that sorts every row first, so as to be
    # repeatable when a task is run again; a number is repeatable as it is.
    row = "_row_number_"
    return df.withColumn(row, F.monotonically_increasing_id()).repartition(parts, row).drop(row)


def read_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """A table with a header row; types are inferred unless a schema is given.

    A gzip file is read by one task: see :func:`spread` for one pass over it,
    :func:`staged` for several and :func:`staged_tables` for many files.
    """
    reader = spark.read.option("sep", TAB).option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The headerless catalogue of display names: ``id``, ``name``."""
    return spark.read.option("sep", TAB).option("header", False).schema(CATALOGUE_SCHEMA).csv(path)


#: Folder that a writer of column files makes for each of them.
FILE_FOLDER = "file_name"


def _unescaped(name: Column) -> Column:
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _with_file_name(df: DataFrame, **columns: Column) -> DataFrame:
    """``file_name``, the file a row comes from or its folder if Spark wrote it, and ``columns`` of a read of files.

    Computed for every row, so the last two segments of the path are cut off from the right: a
    pattern that is not anchored tries every start of the path (50 microseconds a row).  Each
    step is a projection, as what is used twice is computed twice inside a conditional.
    """
    path, kept = F.col("_metadata.file_path"), list(columns)
    cut = df.select(F.substring_index(path, "/", -2).alias("_end_"), *[c.alias(n) for n, c in columns.items()])
    cut = cut.select(F.substring_index("_end_", "/", 1).alias("_folder_"), F.substring_index("_end_", "/", -1).alias("_last_"), *kept)
    written = F.startswith("_last_", F.lit("part-")) & (F.col("_folder_") != "")
    named = cut.select(F.when(written, F.col("_folder_")).otherwise(F.col("_last_")).alias("_name_"), *kept)
    lead = f"{FILE_FOLDER}="
    name = F.col("_name_")
    # names of folders are escaped once more; no escape of a path stands for a letter of the lead
    own = F.startswith(name, F.lit(lead))
    plain = F.when(own, F.substr(name, F.lit(len(lead) + 1))).otherwise(name)
    escaped = F.when(own, F.substr(_unescaped(_unescaped(name)), F.lit(len(lead) + 1))).otherwise(_unescaped(name))
    found = F.when(F.contains(name, F.lit("%")), escaped).otherwise(plain)
    # never NULL, and said so: joins would test it for NULL at the scan, by computing it once more
    return named.select(F.coalesce(found, F.lit("")).alias("file_name"), *kept)


def encoded(cell: Column) -> Column:
    """A cell as one line: line ends, tabs and backslashes escaped, NULL a blank line, the empty text ``\\e``."""
    text = cell
    for plain, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escape))
    return F.when(cell == "", F.lit("\\e")).otherwise(F.coalesce(text, F.lit("")))


def decoded(line: Column) -> Column:
    """The cell that :func:`encoded` made a line of."""

    def plain(part: Column) -> Column:
        for escape, text in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\e", "")):
            part = F.replace(part, F.lit(escape), F.lit(text))
        return part

    # between two escaped backslashes every backslash starts an escape
    whole = F.array_join(F.transform(F.split(line, r"\\\\", -1), plain), "\\")
    return F.when(line != "", F.when(F.contains(line, F.lit("\\")), whole).otherwise(line))


def read_column_files(
    spark: SparkSession, paths: str | list[str], infer: bool = False, escaped: bool = False
) -> DataFrame:
    """Headerless one-column files as (file_name, value), all in one read, a row a line.

    A blank line is a NULL cell, other cells stay as written.  ``escaped`` reads what
    ``sinks.files.write_column_files`` wrote, cells with line ends among them; otherwise a
    line is read as tab-separated with quotes, and its first field is the cell.  ``infer=True``
    types each file first and prints the typed cell, which rewrites cells of mixed number
    formats: one more scan, whatever the number of files.
    """
    if escaped:
        lines = spark.read.option("lineSep", "\n").text(paths)
        cells = _with_file_name(lines, value=decoded(F.col("value")))
    else:
        cell = F.from_csv("value", "cell string", {"sep": TAB})["cell"]
        cells = _with_file_name(spark.read.text(paths), value=F.when(F.col("value") != "", cell))
    if not infer:
        return cells
    # one row per file, where a shuffle by file would put each of them into one task
    kinds = F.broadcast(inference.winners(cells, "file_name"))
    typed = cells.join(kinds, "file_name")
    return typed.select("file_name", inference.printed(F.col("value"), F.col("kind")).alias("value"))


def column_of_file(file_name: Column) -> Column:
    """Column name in a file name ``<id>.<column>.<x>.<y>``."""
    return F.get(F.split(file_name, r"\."), F.lit(1))


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    Text sources are parsed for every pass over them, and gzip files by one task
    each; a staged copy is split, columnar and pruned.  The copy lies in the
    cluster's shared folder, so it also outlives lost executors.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "staged")
    # Headers hold blanks and dots; inside the file columns go by position.
    names = df.columns
    df.toDF(*[f"c{i}" for i in range(len(names))]).write.parquet(path)
    return spark.read.parquet(path).toDF(*names)


# --- many tables at once -------------------------------------------------------------------

LINES = "file_name string, part string, block long, row long, line string"


def _staged_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of all files, written once as parquet: LINES, a folder per file.

    One read over all paths.  Where fewer tasks read them than there are cores, as with a few
    gzip files, the lines are dealt anew before they are written; a folder's parts are then
    split like any parquet, whatever the file was.
    """
    lines = spark.read.text(paths)
    # a line's place: blocks of a file in order, rows as they are read; no two lines have one row
    part = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    placed = _with_file_name(
        lines, part=part, block=F.col("_metadata.file_block_start"), row=F.monotonically_increasing_id(), line=F.col("value")
    )
    cores = spark.sparkContext.defaultParallelism
    if _scan_tasks(lines) < cores:
        placed = placed.repartition(cores, "row")
    path = scratch_path(spark, "lines")
    placed.write.partitionBy("file_name").parquet(path)
    return spark.read.schema(LINES).parquet(path)


def _header(line: str) -> list[str]:
    """Column names of a header line; blank and repeated ones as Spark's reader names them."""
    names = next(csv.reader([line], delimiter=TAB), [])
    times = Counter(n.lower() for n in names)
    return [f"_c{i}" if not n else f"{n}{i}" if times[n.lower()] > 1 else n for i, n in enumerate(names)]


def staged_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Tables with a header row as typed frames, all staged and typed together.

    ``paths``: a file by the key of its frame, or a folder of parts that each have the header, as
    Spark writes them; file names must differ.  Lines are read and written once; one job finds
    the headers, one types all columns of all files (as the narrowest type that all cells of a
    column fit).  What goes through the driver is the header lines of the parts and the types.
    A file without a line has no frame.
    """
    files = {path.rstrip("/").rsplit("/", 1)[-1]: key for key, path in paths.items()}
    if len(files) != len(paths):
        raise ValueError("file names must differ")
    lines = _staged_lines(spark, list(paths.values()))
    # the first line of a part is in its first block; one row per part is broadcast, so that no line is shuffled
    firsts = lines.where("block = 0").groupBy("file_name", "part").agg(F.min("row").alias("row"))
    first = lines.where("block = 0").join(F.broadcast(firsts), ["file_name", "part", "row"])
    headings = sorted(first.select("file_name", "part", "row", "line").collect())
    if not headings:
        return {}
    # the header of a table is that of its first part, as it is to Spark's reader
    heads = {r["file_name"]: _header(r["line"]) for r in reversed(headings)}
    name, heading = F.col("file_name"), F.col("row").isin([r["row"] for r in headings])
    # lines of blanks alone are no rows
    body = lines.where(~heading & F.col("line").rlike(r"[^\x00-\x20]"))
    width = max(len(names) for names in heads.values())
    cells = [f"c{i}" for i in range(width)]
    parsed = body.select("file_name", F.from_csv("line", ", ".join(f"{c} string" for c in cells), {"sep": TAB}).alias("r"))
    long = parsed.select("file_name", F.posexplode(F.array(*[F.col(f"r.{c}") for c in cells])).alias("place", "value"))
    kinds = {(r["file_name"], r["place"]): r["kind"] for r in inference.winners(long, "file_name", "place").collect()}
    frames = {}
    for file_name, names in heads.items():
        ddl = ", ".join(f"c{i} {kinds.get((file_name, i), inference.WIDEST)}" for i in range(len(names)))
        row = F.from_csv("line", ddl, {"sep": TAB}).alias("r")
        frames[files[file_name]] = body.where(name == file_name).select(row).select("r.*").toDF(*names)
    return frames

"""A training-data pipeline over ``documents``: five operators, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.llm import decontaminate, near_minhash, packing, quality, suffix_dedup
from gaugewell.llm.common import stored, table
from gaugewell.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: hashed models, signatures, suffix arrays and tokenizers have none; tests hold the stages against brute force.
ORACLE_SQL = None
#: Words of the shortest passage that the repeats stage takes out: over 50.
PASSAGE = 51


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that importance resampling towards the rows labelled good draws."""
    target = quality.labelled_target(docs, table(spark, sf_dir, "labels"))
    return quality.resample(docs, target, carry=COLUMNS).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates; rows of equal id and text are one.  Rows without an id stay.

    The ids that go are written first: Spark's own size check then sees them and moves no text where they are few.
    """
    found = near_minhash.near_duplicates(docs).where("doc_id is not null")
    ids = stored(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "near-ids")
    gone = stored(ids.where("not kept").select("doc_id"), "near-gone")
    out = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    repeated = ids.where("n > 1").limit(1).count() or docs.where("doc_id is null").limit(2).count() > 1
    return out.dropDuplicates(["doc_id", "text"]) if repeated else out


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of ``PASSAGE`` words or more that recur; a text with nothing left goes."""
    keyed = docs.withColumn("doc_id", F.struct(*[c for c in COLUMNS if c != "text"]))
    left = stored(suffix_dedup.drop_repeated_words(keyed, PASSAGE), "repeats-left").where("not cut or length(trim(text)) > 0")
    return left.select("doc_id.doc_id", "text", "doc_id.lang", "doc_id.source", F.length("text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    keyed = docs.withColumn("doc_id", F.struct(*COLUMNS))
    found = decontaminate.matches(keyed, table(spark, sf_dir, "benchmark"))
    return found.where("size(hits) = 0").select("doc_id.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("repeats", repeat_removal),
    ("decontamination", decontamination),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; between them tables in the shared folder."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

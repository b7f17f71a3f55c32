"""The registered queries of the operators, with production parameters, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.llm import (
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_extract,
    licenses,
    near_embeddings,
    near_minhash,
    packing,
    quality,
    spelling,
    suffix_dedup,
    toxicity,
)
from gaugewell.llm.common import table
from gaugewell.llm.sql import oracle_sql  # noqa: F401

TOXIC_FROM = 0.7


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        F.size("hits").cast("long").alias("n_hits"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    formatted = chat.format_conversations(given.unionAll(spark.createDataFrame(rows, given.schema)), tokenizer_path())
    return chat.read_back(formatted).drop("n_tokens", "n_loss_tokens")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(removed, 0L, (n, r) -> n + r.hi - r.lo)").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_near_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.size("hits").cast("long").alias("n_items"),
        F.col("hits.item_id").alias("item_ids"),
        F.array_min("hits.distance").alias("least_distance"),
    )


def op10_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.resample(docs, quality.labelled_target(docs, table(spark, sf_dir, "labels")))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_packing, op2_toxicity, op3_chat_format, op4_suffix_dedup, op5_near_embeddings,
        op6_near_minhash, op7_html_extract, op8_license_scan, op9_decontaminate, op10_quality_resample, op11_exact_dedup,
        op12_hard_negatives, op13_spelling_groups, pipeline,
    )
    return {f.__name__: f for f in found}

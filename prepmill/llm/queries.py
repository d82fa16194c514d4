"""The registered queries of this subpackage, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepmill.llm import (
    attribution,
    bpe,
    cells,
    chat,
    decontaminate,
    jaccard,
    quality,
    repair,
    resampling,
    suffixes,
    toxicity,
    voronoi,
    warc,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """The fold of an id by the CRC of its decimal text."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(folds))


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.report(chat.windows(conversations))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.report(warc.read_records(warc.write_archives(table(spark, folder, "pages"))))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    scanned = decontaminate.scan_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.report(scanned)


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit(documents, table(spark, folder, "labels"), fold("doc_id", 5) != 0)
    return toxicity.score(documents, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    network = quality.fit(documents, table(spark, folder, "labels"), fold("doc_id", 4) != 2)
    return quality.score(documents, network).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return voronoi.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(suffixes.cut_repeats(table(spark, folder, "documents").select("doc_id", "text")))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = attribution.token_counts(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.select(
        "doc_id",
        F.size("starts").cast("long").alias("n_sections"),
        "n_tokens",
        F.col("crossing").alias("n_crossing"),
        F.array_max("tokens").alias("largest_section"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("sections_sha256"),
    )


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.report(conversations, repair.repair(repair.damaged(conversations)))


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cells.near_duplicates(table(spark, folder, "embeddings"))


QUERIES = {
    name: run
    for name, run in list(globals().items())
    if name.startswith("op") and name[2].isdigit() and callable(run)
}

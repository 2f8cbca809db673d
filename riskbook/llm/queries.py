"""The registered queries of the dealt operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.llm import centroids, decontaminate, fingerprint, importance, jaccard_join, langid, line_dedup, mixing, packing, pii, token_files, toxicity, warc
from riskbook.llm.sql import CLUSTERING, MIXING, RESAMPLING

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(parts: int, part: int) -> Column:
    """Documents kept from learning, by the checksum of their identifier."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == part, F.lit(False))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out(3, 1))
    models = langid.fit(docs.where("NOT held_out"), F.col("doc_id"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), models)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("key").distinct()


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", held_out(4, 2))
    labels = table(spark, folder, "labels").where(~held_out(4, 2))
    model = toxicity.fit(docs.where("NOT held_out"), labels, F.col("doc_id"))
    return toxicity.score(docs.select("doc_id", "held_out", "text"), model)


def word_tokenizer() -> str:
    """Path of the public word-level tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), word_tokenizer())


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("lines").alias("n_lines"), F.col("lines_removed").alias("n_removed"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similarity_join(table(spark, folder, "documents"))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(mixing.takes(table(spark, folder, "documents")))


def byte_tokenizer() -> str:
    """Path of the public byte-level tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digests(packing.packed(table(spark, folder, "documents"), byte_tokenizer()))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.report(*centroids.cluster(table(spark, folder, "embeddings"))).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_pii": op6_pii,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_source_mix": op10_source_mix,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_centroid_clustering": op13_centroid_clustering,
}

SQL: dict[str, str] = {
    "op10_source_mix": MIXING,
    "op12_importance_resampling": RESAMPLING,
    "op13_centroid_clustering": CLUSTERING,
}

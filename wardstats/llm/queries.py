"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

import hashlib
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, clusters, decontamination, jaccard, language, licenses, packing, repeats, resampling, scoring, secrets, substrings, token_files
from .common import shared_folder, ship_package
from .windows import per_document

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return decontamination.contamination_report(docs, items)


def pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(_table(spark, folder, "documents"), TOKENIZER).drop("ids")


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicate_components(_table(spark, folder, "documents"))


def suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    # The digest of each distinct text, before its documents meet it.
    texts = repeats.kept_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return per_document(docs, texts, "doc_id", "text")


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(1))
    model = language.learn_languages(docs.where(fold != 0))
    rows = docs.select("doc_id", "text", (fold == 0).alias("held_out"))
    return language.predict_languages(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def score_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return scoring.score_documents(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def scan_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(_table(spark, folder, "documents"))


def token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_tokens(_table(spark, folder, "documents"), TOKENIZER, path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    texts = substrings.kept_texts(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return substrings.for_documents(docs, texts, kept="kept_sha256", none=hashlib.sha256(b"").hexdigest())


def scan_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(_table(spark, folder, "documents"))


def cluster_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_report(*clusters.clusters(_table(spark, folder, "embeddings")))


def resample(spark: SparkSession, folder: str) -> DataFrame:
    scores = resampling.importance_scores(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return resampling.ranked(scores).drop("n_words")


QUERIES = {
    "op1_decontamination": decontaminate,
    "op2_packing": pack,
    "op3_jaccard_join": jaccard_join,
    "op4_suffix_repeats": suffix_repeats,
    "op5_language_id": language_id,
    "op6_nearest_vectors": nearest,
    "op7_lm_scoring": score_texts,
    "op8_secrets": scan_secrets,
    "op9_token_files": token_output,
    "op10_substring_dedup": substring_dedup,
    "op11_license_scan": scan_licenses,
    "op12_centroid_clusters": cluster_vectors,
    "op13_importance_resampling": resample,
}

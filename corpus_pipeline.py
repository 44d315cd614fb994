"""A training corpus in five stages: language, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; all but the last return the columns of ``documents``. Every stage's rows
are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstats.llm import decontamination, jaccard, language, packing, secrets
from wardstats.llm.common import column, intermediate, ship_package, unused
from wardstats.llm.queries import TOKENIZER


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a text in some language: the others go.

    Those are null, have no letter, or have n-grams but none in any learned
    language after the correction for false positives.
    The filters learn from all of ``docs`` that have a language; without any,
    nothing can be told and every document goes.
    """
    model = language.learn_languages(docs)
    found, score = unused(docs.columns, "found_lang"), unused(docs.columns, "found_score")
    told = language.predict_languages(docs, model, lang=found, score=score, reject=True)
    return told.where(column(found) != language.UNKNOWN).select(*map(column, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of the smallest id."""
    return jaccard.first_of_components(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ``benchmark``; the contaminated ones go whole."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size).alias("n_chars")
    return clean.select(*[counted if c == "n_chars" else column(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 2048."""
    return packing.packed_sequences(docs, TOKENIZER)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secret_spans),
    ("packing", packed),
]

# Tokenizer ids and learned filters can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; what the stages write goes, but for the last one's table."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with intermediate() as keep:
        for name, stage in STAGES[:-1]:
            with intermediate() as keep_stage:
                docs = keep_stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        name, stage = STAGES[-1]
        return keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))

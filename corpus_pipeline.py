"""The training-data pipeline: raw documents to packed token sequences.

Every stage takes all rows that the one before it kept; stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationhour.llm import decontamination, jaccard_join, language_id, packing, suffix_dedup
from stationhour.llm.staging import free_name
from stationhour.session import write_shared


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified. Null and empty texts and texts without letters have none and go; repeated rows have one answer and stay or go together;
    columns of any name come back as they were; an empty table stays empty."""
    made = ("predicted_lang", "confidence", "accepted")
    aside = {}
    for c in docs.columns:
        if c.lower() in made:
            aside[c] = free_name([*docs.columns, *made, *aside.values()], f"own_{c}")
    found = language_id.identify(docs.withColumnsRenamed(aside), declared=F.col("lang"), host=F.col("source"))
    return found.filter("accepted").select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: of the smallest id, of equal ids the first read, one without id only if no other is
    there. Null, empty and wordless texts are nobody's duplicates and stay, repeated rows with text do not; very long texts are compared whole."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a document of a smaller id has too (a null id comes last); n_chars follows. All rows stay, also those
    that lose their whole text; null texts become empty, shorter ones stay as they are."""
    return suffix_dedup.cut_repeats(docs, length=50).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Null and empty texts hold none and stay; repeated rows stay or go together."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens, with their ids. A null or empty text is its end-of-document id alone; repeated rows are
    packed each; further columns are not read."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_near_duplicates),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

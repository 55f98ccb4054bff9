"""Corpus pipeline over ``documents``, each stage one operator of ``incentiva.llm``.

1. language: documents without a letter, or without a predominant language, go.
2. line-dedup: later copies of passages of 50 words or more are cut out; a document of which nothing is left goes.
3. near-duplicates: of each class of near duplicates the document with the least id stays.
4. decontamination: documents that hold ten consecutive words of a benchmark item go.
5. pieces: what is left is segmented, as sampled ids of pieces; texts are decoded again and held against the input.

Each stage's result is written as Parquet in the folder that executors share, and read again by the next.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incentiva.llm import decontaminate, language, line_dedup, near_dup, pieces
from incentiva.llm.common import Stage


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.fit(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and sampled segmentation."""
    keep = ["doc_id", "lang", "source"]
    found = pieces.encode(docs, pieces.load_pieces(), keep)
    return found.select(*keep, F.posexplode("samples").alias("sample", "s")).select(
        *keep, "sample", "s.ids", F.size("s.ids").cast("long").alias("n_pieces"), "s.log_prob", "s.log_inclusion", "s.round_trip")


STAGES = [
    ("language", language_stage),
    ("line-dedup", line_dedup_stage),
    ("near-duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("pieces", pieces_stage),
]

#: Learned scores, components and sampled segmentations are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table ``documents`` in ``sf_dir``."""
    stage = Stage(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = stage.put(step(spark, docs, sf_dir), f"{k}-{name}")
    return docs

"""From raw documents to packed training sequences: five stages, each one operator of ``ridemart.llm``.

Each stage takes the documents that the one before kept and returns documents
(all columns, changed only where its decision says so); the last returns the
packed pieces.  Between stages the rows are a Parquet table.

quality        rejects documents by the base measures and the likelihood ratio (operator 7)
near_copies    keeps the smallest document of every group of near copies (operator 5)
repeats        cuts byte strings that an earlier document has, and sets n_chars anew (operator 9)
benchmark      rejects documents with a benchmark window (operator 6)
packing        packs the rest into sequences of at most 1024 tokens (operator 4)

Null, empty and repeated rows, ties and empty tables behave as each operator
documents; an empty table goes through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm import decontamination, ngram_jaccard, packing, quality_llr, suffix_dedup
from ridemart.llm.cluster import drop_folder, shared_folder, written
from ridemart.llm.queries import END_ID
from ridemart.llm.tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_llr.keep_documents(docs, quality_llr.fit(docs, _table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_documents(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary(), END_ID).drop("row")


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeats", repeats), ("benchmark", benchmark), ("packing", packed)]

#: The likelihood ratio and the encoder are beyond SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; a stage's table goes when the next one's is written."""
    folder = shared_folder(spark, "pipeline")
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), folder, name)
        if before:
            drop_folder(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)

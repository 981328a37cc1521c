"""Corpus cleaning from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.llm import decontaminate, exact_dedup, minhash, packing, toxicity
from autostrata.staging import staging_path


# Rows of texts that a Python task is handed at once. Spark's default of 10,000 rows keeps tens of
# megabytes of whole texts in memory on both sides of each task, beside the heap.
BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    """Bound the batches of the session, unless it has its own bound below that."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold, by a model from the labels of the training rows."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(toxicity.crc_remainder("doc_id") != 2))
    name = "score" + "_" * max(map(len, docs.columns))  # longer than any column's name
    scored = toxicity.score(docs, model, name=name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked, directly or over others, the one with the smallest doc_id."""
    _small_batches(spark)
    return minhash.keep_one(docs, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row from a benchmark item."""
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of a document in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained scores, hashed signatures and greedy packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again for the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

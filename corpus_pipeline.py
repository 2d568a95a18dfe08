"""The training-data pipeline: five operators, each on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that go on (the last one their shards).  ``run`` writes
every stage's result as Parquet in the shared checkpoint folder and reads it
back, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm.kd_shards import kd_shards
from kpiloom.llm.lsh_forest import without_near_duplicates
from kpiloom.llm.pareto_mix import mixed_documents
from kpiloom.llm.simhash_leaks import without_leaks
from kpiloom.llm.tables import stored
from kpiloom.llm.toxicity import without_toxic

SHINGLE, PERCENT, SHARDS = 5, 80, 8


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (7) rejects go; it learns from the labels of documents still there."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (8) stays: five-word shingles, similarity 0.8."""
    return without_near_duplicates(docs, shingle=SHINGLE, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (4) go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources (3): each document as often as the mix takes it.

    Documents of a source have the same chance: chances that grow with the size
    gather the few very long texts, which the shards (9) cannot part evenly."""
    return mixed_documents(docs, power=0)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix (9)."""
    return kd_shards(docs, shards=SHARDS) \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

# Signatures, a fitted classifier and seeded hashes have no SQL form; tests/llm/test_pipeline.py
# checks every stage against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

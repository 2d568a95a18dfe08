"""The registered queries of the numbered operators: name -> callable(spark, sf_dir).

Every query applies its operator with production parameters to its whole
table and returns the full result.  ``oracle_sql`` holds the DuckDB SQL where
SQL can express the result within reason; the others are tested against a
brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import oracle

TOKENIZER = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 50-byte strings removed from every document."""
    from kpiloom.llm.suffix_dedup import suffix_dedup
    out = suffix_dedup(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op2_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20."""
    from kpiloom.llm.bm25_search import top_k
    return top_k(documents(spark, sf_dir)).select("query_id", "rank", "doc_id", "score")


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix of the sources with weights 1, 2, 3 takes."""
    from kpiloom.llm.pareto_mix import pareto_mix
    return pareto_mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best window of each pair."""
    from kpiloom.llm.simhash_leaks import leaks
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 50-word windows removed from every document."""
    from kpiloom.llm.substring_dedup import substring_dedup
    out = substring_dedup(documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document; learns from the folds 0 and 2 of 3."""
    from kpiloom.llm.quality import quality_scores
    return quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document; learns from the folds 1 to 4 of 5."""
    from kpiloom.llm.toxicity import toxicity_scores
    return toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are at least 80 % similar."""
    from kpiloom.llm.lsh_forest import near_duplicates
    return near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    from kpiloom.llm.kd_shards import kd_shards
    return kd_shards(documents(spark, sf_dir), shards=8) \
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"))


def op10_token_counts(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Tokens of every document under the vocabulary file (``model_path``)."""
    from kpiloom.llm.token_counts import token_counts
    if model_path is None:
        import public_tokenizers
        model_path = public_tokenizers.path(TOKENIZER)
    with open(model_path, encoding="utf-8") as f:
        return token_counts(documents(spark, sf_dir), f.read())


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with turns dropped, emptied, cut, repeated or given to the user, by a hash of their place."""
    space = F.lit(" ")
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    kept = conversations.withColumn("harm", F.crc32(place) % 20).where("harm <> 0")
    return kept.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("harm") == 1, F.lit("")).when(F.col("harm") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired turns of every conversation, after damage."""
    from kpiloom.llm.role_repair import COUNTS, digests, repaired
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    report, turns = repaired(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    for k, found in enumerate((report, digests(turns))):
        found = found.withColumnRenamed("conv_id", f"conv_{k}")
        every = every.join(found, every["conv_id"].eqNullSafe(found[f"conv_{k}"]), "left").drop(f"conv_{k}")
    return every.select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the known forms, all spans with those found by context."""
    from kpiloom.llm.private_spans import KINDS, count_of, personal_spans, written
    out = personal_spans(documents(spark, sf_dir))
    return out.select("doc_id", *[count_of(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
                      F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
                      (F.size("spans") - F.size("base")).cast("long").alias("n_found"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, and the proof tried on rows some of which were tampered with."""
    from kpiloom.llm.merkle_manifest import folded, leaf_hash, merkle_manifest, proof_text
    docs = documents(spark, sf_dir)
    changed = leaf_hash(docs["doc_id"], docs["source"], docs["lang"], docs["n_chars"] + 1, docs["text"])
    hit = F.crc32(docs["doc_id"].cast("string")) % 7 == 0
    out = merkle_manifest(docs, carried={"tampered": F.when(hit, changed)}) \
        .withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_bm25_search": op2_bm25_search,
    "op3_pareto_mix": op3_pareto_mix,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_kd_tree_shards": op9_kd_tree_shards,
    "op10_token_counts": op10_token_counts,
    "op11_role_repair": op11_role_repair,
    "op12_private_spans": op12_private_spans,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL

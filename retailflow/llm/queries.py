"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import (
    conversation_repair,
    decontamination,
    jaccard_join,
    mixing,
    periodic_runs,
    permutation_index,
    secret_scan,
    simhash,
    substring_trees,
    suffix_arrays,
    token_counts,
    toxicity,
    url_reputation,
)
from retailflow.llm.common import stored, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of ``documents`` under the word BPE vocabulary."""
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_substring_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 35-word windows removed from ``documents``."""
    return substring_trees.dedup_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op3_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 400-byte strings removed from ``documents``."""
    return suffix_arrays.dedup_bytes(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` mixed to source weights 1, 2, 3 in turn."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in ``documents``: counts, digest of the base spans, all spans."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), ["doc_id"])
    base = secret_scan.span_text(F.col("spans"), secret_scan.BASE_KINDS)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of ``documents``, learnt from ``labels`` outside the held-out fold."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every url of ``pages``."""
    return url_reputation.filter_urls(table(spark, sf_dir, "pages"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth row of ``embeddings``."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(100)) == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of ``documents`` (4-word shingles, at most 4 bits apart)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` that contain 0.8 or more of the 5-word shingles of a ``benchmark`` item."""
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.concat_ws(",", F.transform("item_ids", lambda i: i.cast("string")))
    return found.withColumn("item_ids", items)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults planted in ``conversations``, counted and repaired; every original conversation has its row."""
    rows = table(spark, sf_dir, "conversations")
    fixed = stored(conversation_repair.repair(conversation_repair.damage(rows)), "conversations-repaired")
    names = [*conversation_repair.TOTALS, "audit", "sha256"]
    parts = [rows.select("conv_id"), fixed.where("audit is not null").select("conv_id", *names[:-1]),
             conversation_repair.digests(fixed)]
    every = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    found = every.groupBy("conv_id").agg(*[F.max(n).alias(n) for n in names])
    nothing = F.sha2(F.lit(""), 256)
    return found.select("conv_id", *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in conversation_repair.TOTALS],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", nothing).alias("repaired_sha256"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of ``documents`` whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard_join.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of ``documents``, a tenth of which get a repeating tail first."""
    runs = periodic_runs.find_runs(periodic_runs.with_cycles(table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    found = runs.select("doc_id", "runs", "collapsed", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic_runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over ``documents``, all stages."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_trees": op2_substring_trees,
    "op3_suffix_arrays": op3_suffix_arrays,
    "op4_mixing": op4_mixing,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_url_reputation": op7_url_reputation,
    "op8_permutation_index": op8_permutation_index,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": pipeline,
}

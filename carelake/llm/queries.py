"""The registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import (bpe, importance, langid, license_scan, mixing, periodic, quality_rules, sharding, simhash,
                          token_counts, token_output, topk, toxicity)
from carelake.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), best=True)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, max_copies=2, importance=mixing.length_class()).report()


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=512, keep=["doc_id"])


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), keep=["doc_id"], ids=False)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=2)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_output.write_token_ids(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-ids"))
    return token_output.digests(spark, folder)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit_on_rest(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on_rest(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic.digests(periodic.periodic_runs(periodic.with_repeated_tails(docs), shortest=24, repeats=3))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), grams=1, buckets=10_000,
                               percent=10, min_words=20, seed=2024).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_mixing": op2_mixing,
    "op3_token_counts": op3_token_counts,
    "op4_sharding": op4_sharding,
    "op5_bpe": op5_bpe,
    "op6_simhash": op6_simhash,
    "op7_topk": op7_topk,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_output": op9_token_output,
    "op10_langid": op10_langid,
    "op11_toxicity": op11_toxicity,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_importance": op13_importance,
}

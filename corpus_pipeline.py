"""The corpus pipeline: stages over ``documents``.

Each stage works on all rows its predecessor kept. Its result is written as
Parquet in the session's shared folder and read again as the next one's input, so
a lost executor costs one stage's tasks and nothing before it. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import bpe, langid, mixing, quality_rules, simhash
from carelake.session import scratch_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the language models reject go (no letters, or unlike every known language).

    A null or empty text goes; a null id trains no model and is judged like any other; texts of any length
    are read whole; repeated rows stay or go together; no rows give no rows; other columns pass through.
    """
    return langid.keep_known(docs, langid.fit_on_rest(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or the learned decision list go.

    A null or empty text goes (fewer than ten words); a null id has no label and is judged like any other; texts
    of any length count whole; repeated rows stay or go together; no rows give no rows; other columns pass through.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Texts without words are near-duplicates of each other; of repeated rows one stays; a group without any id
    keeps one row; ties go to the smallest text digest (``simhash.keep_one``); texts of any length count
    whole; no rows give no rows; other columns pass through.
    """
    return simhash.keep_one(docs, width=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (not at all, once or twice).

    A text without words takes no part of its source's words; a null source is one of its own; rows equal in id,
    source and text are taken or left together; texts of any length count whole; no rows give no rows; other
    columns pass through.
    """
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, max_copies=2, importance=mixing.length_class()).apply(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (repeats included), with digests of ids and decoded text.

    A null or empty text has no ids; texts of any length are encoded whole; repeated rows give repeated
    results; no rows give no rows; other columns pass through, but for those of the new names.
    """
    return bpe.encode_decode(docs)


STAGES = [
    ("language ID", known_language),
    ("quality rules", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("mixing", mixed),
    ("BPE", token_ids),
]

#: SQL has no Kneser-Ney models, learned lists, graph components or BPE: the
#: pipeline is tested against brute force instead (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, "pipeline-" + name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs

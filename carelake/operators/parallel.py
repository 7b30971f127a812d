"""Parallelism for CPU-heavy stages.

A large table arrives in thousands of splits and needs nothing here. A small
input (one file, one row group) arrives as a handful of splits, and a
CPU-heavy stage over it (tokenising whole texts, model scoring, tree training)
would run on as many cores. ``spread`` repartitions only in that case, so the
extra shuffle is paid only where it is tiny.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


MAX_SPREAD = 1024  # enough tasks for a small input on any cluster


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` over at least ``min_partitions`` tasks (default: the cores), if it is a
    plain scan with fewer splits. Anything with a shuffle below is left as it is:
    counting its partitions would run it, and adaptive execution sizes it. Results
    of per-row work do not depend on this."""
    if df.isStreaming:  # micro-batches are split by the source; nothing to widen up front
        return df
    plan = df._jdf.queryExecution().sparkPlan().toString()
    if "Exchange" in plan or "Join" in plan or "Aggregate" in plan or "Window" in plan or "Sort" in plan:
        return df
    target = min_partitions or min(df.sparkSession.sparkContext.defaultParallelism, MAX_SPREAD)
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df

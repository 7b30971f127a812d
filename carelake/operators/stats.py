"""Aggregates and statistics.

Every statistic here is a declarative aggregate: Spark computes partial results
per task (map-side) and merges them after one small shuffle, so a hot key adds
no skew and no column of any size is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from carelake.functions.columns import pearson
from carelake.operators.places import with_running_sum
from carelake.session import ship_package


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def value_range(df: DataFrame, col: str, lo: str = "first_value", hi: str = "last_value") -> DataFrame:
    return df.agg(F.min(col).alias(lo), F.max(col).alias(hi))


def mean_min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(col).alias(f"mean_{col}"), F.min(col).alias(f"min_{col}"),
                  F.max(col).alias(f"max_{col}"))


def grouped(df: DataFrame, keys: list[str | Column], aggs: dict[str, Column],
            where: Column | None = None) -> DataFrame:
    """``SELECT keys, aggs FROM df [WHERE …] GROUP BY keys``."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(*[c.alias(a) for a, c in aggs.items()])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def describe_table(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``describe()`` as in the notebooks: rows count, mean, stddev, min, max;
    one string column per input column (text columns get count, min, max)."""
    return df.describe(*(cols or []))


def describe_long(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Summary statistics as a long table ``(column, stat, value)``.

    stat is count, mean, stddev (sample), min, max — the rows of ``describe()``,
    but typed as double and computed for all columns in one aggregation pass.
    """
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).cast("double").alias(f"c{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    entries = []
    for i, c in enumerate(cols):
        for stat, k in (("count", "c"), ("mean", "m"), ("stddev", "s"), ("min", "lo"), ("max", "hi")):
            entries.append(F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"),
                                    r(F.col(f"{k}{i}")).alias("value")))
    return wide.select(F.inline(F.array(*entries)))


WIDE = 24  # columns from which a matrix is made by one vector aggregate instead of an expression per pair


def corr_matrix(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6, wide: bool | None = None) -> DataFrame:
    """Pearson r of every ordered pair of columns ``(feature_a, feature_b, r)``, over the rows where both
    are present.

    Constant columns give NULL. The diagonal is 1 for non-constant columns. Without ``cols``, the
    numeric columns of the schema are used (text columns are left out). One pass either way: few columns by an
    aggregate expression per pair, more than ``WIDE`` (or ``wide=True``) by one Gram matrix (``_pair_sums``).
    """
    cols = cols or numeric_columns(df)
    if wide if wide is not None else len(cols) > WIDE:
        return _corr_wide(df, cols, digits)
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            name = f"r{i}_{j}"
            aggs.append(pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(name))
            pairs.append((a, b, name))
    sums = df.agg(*aggs)
    entries = []
    for a, b, name in pairs:
        v = F.round(F.col(name), digits) if digits is not None else F.col(name)
        entries.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), v.alias("r")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), v.alias("r")))
    return sums.select(F.inline(F.array(*entries)))


def _pair_sums(df: DataFrame, cols: list[str], shift: list[float]) -> DataFrame:
    """``(i, j, n, si, sj, qi, qj, c)`` per pair of columns: rows where both are present, sums, sums of squares and
    of products of the shifted values. A task adds up whole batches as matrix products and sends one
    row per column; the sums of all tasks are added per pair."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cols)
        n, s, q, c = (np.zeros((k, k)) for _ in range(4))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(k)])
            there = np.column_stack([np.asarray(b.column(i).is_valid()) for i in range(k)]).astype(float)
            x = np.where(there > 0, x - shift, 0.0)
            n += there.T @ there
            s += x.T @ there
            q += (x * x).T @ there
            c += x.T @ x
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *[pa.array(list(m), kind) for m in (n, s, s.T, q, q.T, c)]],
                                         names=["i", "n", "si", "sj", "qi", "qj", "c"])

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(
        run, "i int, " + ", ".join(f"{x} array<double>" for x in ("n", "si", "sj", "qi", "qj", "c")))
    pairs = parts.select("i", F.posexplode(F.arrays_zip("n", "si", "sj", "qi", "qj", "c")).alias("j", "x"))
    return pairs.groupBy("i", "j").agg(*[F.sum(f"x.{x}").alias(x) for x in ("n", "si", "sj", "qi", "qj", "c")])


def _corr_wide(df: DataFrame, cols: list[str], digits: int | None) -> DataFrame:
    # Sums of squares lose digits far from zero: shift every column by one of its values.
    some = df.limit(1000).agg(*[F.first(F.col(f"`{c}`").cast("double"), ignorenulls=True).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    sums = _pair_sums(df, cols, [0.0 if x is None or x != x else x for x in some])

    def spread_of(q: str, s: str) -> Column:  # n times the variance; what is left of rounding counts as none
        v = F.col(q) - F.col(s) * F.col(s) / F.col("n")
        return F.when((F.col("n") > 1) & (v > 1e-13 * F.col(q)), v)

    r = (F.col("c") - F.col("si") * F.col("sj") / F.col("n")) / F.sqrt(spread_of("qi", "si") * spread_of("qj", "sj"))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.when(F.col("n") > 1, r)))
    r = F.when(spread_of("qi", "si").isNotNull() & spread_of("qj", "sj").isNotNull(), r)
    name = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(name, F.col("i") + 1).alias("feature_a"), F.element_at(name, F.col("j") + 1).alias("feature_b"),
                       (F.round(r, digits) if digits is not None else r).alias("r"))


def corr_with_target(df: DataFrame, cols: list[str], target: str, digits: int | None = 6) -> DataFrame:
    """Pearson r of each column with ``target`` (target itself included),
    sorted by r descending: ``(feature, r)``."""
    cols = list(cols) if target in cols else list(cols) + [target]
    y = F.col(target).cast("double")
    wide = df.agg(*[pearson(F.col(c).cast("double"), y).alias(f"r{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("feature"),
                        (F.round(F.col(f"r{i}"), digits) if digits is not None else F.col(f"r{i}")).alias("r"))
               for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*entries))).orderBy(F.desc_nulls_last("r"), "feature")


def auc_rank_sum(df: DataFrame, score: str, label: str, by: str | None = None, weight: str | None = None) -> DataFrame:
    """The exact area under ROC by the rank sum: ``[by,] positives, negatives, auc``.

    The area is the share of (positive, negative) pairs in which the positive has the higher score, ties
    counting half. Rows are first counted per score (map-side), the counts sorted by score over range
    partitions, and each score's positives meet the negatives below it (a running sum): all
    in integers, one division at the end. Rows with a NULL label or score are left out (NaN is the
    highest score); ``label`` over 0 is positive. A part without both labels has a NULL area. A row stands
    for ``weight`` rows, a whole number (default: itself).
    """
    keys = [by] if by else []
    y = F.when(F.col(label) > 0, 1).otherwise(0)
    n = F.col(weight) if weight else F.lit(1)
    counts = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
              .groupBy(*keys, F.col(score).alias("__score"))
              .agg(F.sum(y * n).alias("__pos"), F.sum((1 - y) * n).alias("__neg")))
    up_to = with_running_sum(counts, [*keys, "__score"], {"__upto": "__neg"})
    # In one order over all parts, a part's own negatives start where the ones before end: its
    # positives times that many are taken off again.
    twice = F.col("__pos") * (2 * F.col("__upto") - F.col("__neg"))
    sums = (up_to.groupBy(*keys).agg(F.sum("__pos").alias("positives"), F.sum("__neg").alias("negatives"),
                                     F.sum(twice.cast("decimal(38,0)")).alias("__twice"),
                                     F.min(F.col("__upto") - F.col("__neg")).alias("__before")))
    own = F.col("__twice") - 2 * F.col("__before") * F.col("positives")
    return sums.select(*keys, "positives", "negatives", F.try_divide(
        own.cast("double"), (2 * F.col("positives") * F.col("negatives")).cast("double")).alias("auc"))

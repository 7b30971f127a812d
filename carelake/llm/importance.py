"""Importance resampling towards the distribution of a target table.

Weights: words (or runs of up to ``grams`` words) are hashed into buckets; one pass counts
the documents' buckets, one the target's; the logarithm of the ratio of both
distributions is an array with one integer per bucket, and a document's weight is the sum of its
features' entries. The array has ``buckets`` entries whatever the corpus (80 KB at 10,000).

Draw: weight plus a Gumbel variate per document; the largest are an exact draw
without replacement in proportion to the weights' exponentials. The k-th largest is found by
distributed quickselect: each round takes random pivot keys from the range that still
holds it, counts the rows below, at and above every pivot exactly, and goes on between
the two pivots around it. The keys (score, id, text hash, row) are composite and all different, so the
line is one row. Only the winners are sorted, by range partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.pretokens import unused
from carelake.llm.wordarrays import LETTERS_DIGITS, ids, mapped, owners, slices, words
from carelake.operators.places import with_place
from carelake.session import checkpoint_root, ship_package

PIVOTS = 15  # per round: the range shrinks 16-fold on average
MAX_BUCKETS = 1 << 22  # entries of the weight array


def features(column: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, text of each feature, bucket of each feature).

    Words: ASCII capitals made small, runs of small letters, digits and characters beyond
    ASCII. Features: all runs of 1 to ``grams`` consecutive words joined by one space;
    bucket: crc32 of the UTF-8 bytes modulo ``buckets``.
    """
    offsets, flat = words(mapped(column, LETTERS_DIGITS).cast(pa.string()))
    owner = owners(offsets)
    texts, codes, run = [], [], flat
    for k in range(grams):
        if k:
            if len(flat) <= k:
                break
            run = pc.binary_join_element_wise(run.slice(0, len(flat) - k), flat.slice(k), " ")
        at, distinct = ids(run)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in distinct.cast(pa.binary()).to_pylist()), np.int64, len(distinct))
        inside = owner[:len(run)] == owner[k:]
        texts.append(owner[:len(run)][inside])
        codes.append(bucket[at][inside] if len(distinct) else np.zeros(0, np.int64))
    empty = np.zeros(0, np.int64)
    return np.diff(offsets), np.concatenate(texts or [empty]), np.concatenate(codes or [empty])


def bucket_counts(rows: DataFrame, text: str = "text", grams: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features per bucket over all rows (counted per task, then summed: at most ``buckets``
    rows reach the driver)."""
    ship_package(rows.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in parts:
            for i, j in slices(batch.column(0)):
                total += np.bincount(features(batch.column(0).slice(i, j - i), grams, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = rows.select(F.col(text).cast("string")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the target's to the source's smoothed shares) per bucket."""
    n = len(source)
    ratio = ((target + 1.0) * (float(source.sum()) + n)) / ((source + 1.0) * (float(target.sum()) + n))
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def gumbel(key: str, seed: int) -> Column:
    """floor(1000 * a Gumbel variate) from the first 32 bits of sha256 of ``<seed>:<key>`` (a null key: empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def weighted(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", grams: int = 1, seed: int = 2024) -> DataFrame:
    """``<key>, n_words, n_features, weight, score, text_hash``."""
    spark, buckets = docs.sparkSession, len(gain)
    ship_package(spark)
    data = spark.sparkContext.broadcast(gain)  # one entry per bucket
    kind = docs.schema[key].dataType.simpleString()
    new = ["n_words", "n_features", "weight"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = data.value
        for batch in parts:
            for i, j in slices(batch.column(2)):
                n, owner, code = features(batch.column(2).slice(i, j - i), grams, buckets)
                total = np.bincount(owner, array[code], j - i).astype(np.int64)  # sums of integers: exact
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n),
                     pa.array(np.bincount(owner, minlength=j - i).astype(np.int64)), pa.array(total)], names=["k", "text_hash", *new])

    content = F.col(text).cast("string")
    rows = (docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(content).alias("text_hash"), content.alias(unused(docs)))
            .mapInArrow(run, f"k {kind}, text_hash bigint, n_words bigint, n_features bigint, weight bigint"))
    return rows.withColumn("score", F.col("weight") + gumbel("k", seed)).select(F.col("k").alias(key), *new, "score", "text_hash")


def kth_key(rows: DataFrame, key: Column, k: int, pivots: int = PIVOTS):
    """The k-th smallest value (from 1) of ``key``, a struct that is different in every row.

    Distributed quickselect: the driver holds ``pivots`` keys and one count per part.
    """
    rows = rows.select(key.alias("key"))
    low = high = None  # open bounds of the range that still holds the key
    before, round_ = 0, 0  # rows at or below low

    def literal(x):
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(x, rows.schema["key"].dataType.fields)])

    while True:
        live = rows
        if low is not None:
            live = live.where(F.col("key") > literal(low))
        if high is not None:
            live = live.where(F.col("key") < literal(high))
        # Random rows of the range: those whose hash is smallest in this round.
        drawn = [tuple(r["key"]) for r in live.select("key", F.xxhash64("key", F.lit(round_)).alias("u")).orderBy("u").limit(pivots)
                 .orderBy("key").collect()]
        if not drawn:
            raise ValueError(f"fewer than {k} rows")
        # Part 2 i: below the i-th pivot (and above the one before); 2 i + 1: the i-th pivot itself.
        part = sum(((F.col("key") >= literal(p)).cast("int") + (F.col("key") > literal(p)).cast("int") for p in drawn), F.lit(0))
        counts = {r["part"]: r["n"] for r in live.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for i in range(2 * len(drawn) + 1):
            n = counts.get(i, 0)
            if before + n >= k:
                if i % 2:
                    return drawn[i // 2]
                low, high = (drawn[i // 2 - 1] if i else low), (drawn[i // 2] if i // 2 < len(drawn) else high)
                break
            before += n
        else:
            raise ValueError(f"fewer than {k} rows")
        round_ += 1


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", grams: int = 1,
             buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """Every document's ``<key>, n_words, n_features, weight, score, rank``: of the N
    documents with at least ``min_words`` words the floor(percent * N / 100) highest scores
    are drawn, ties to the smaller key (null first), then to the text's hash; rank 1, 2, 3, ... in
    this order, null if not drawn.

    A null or empty text has no features and weight 0 and is not drawn (unless ``min_words`` is
    0). Repeated rows are rows of their own, with equal scores and successive ranks.
    An empty target gives the documents' own smoothed distribution against a uniform one;
    no documents give no rows. Other columns are not read, so their names cannot clash. Texts of
    any length count whole. The scored rows (a few numbers each) are checkpointed.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    checkpoint_root(spark)
    rows = weighted(docs, gain, key, text, grams, seed).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    out = [key, "n_words", "n_features", "weight", "score"]
    enough = F.col("n_words") >= min_words
    k = percent * rows.where(enough).count() // 100
    if not k:
        return rows.select(*out, F.lit(None).cast("bigint").alias("rank"))
    composite = F.struct((-F.col("score")).alias("score"), F.col(key).alias("id"), "text_hash", "row")
    line = kth_key(rows.where(enough), composite, k)
    fields = rows.select(composite.alias("key")).schema["key"].dataType.fields
    last = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(line, fields)])
    won = enough & (composite <= last)
    ranked = with_place(rows.where(won), [F.col("score").desc(), F.col(key).asc_nulls_first(), "text_hash", "row"], "rank")
    return ranked.select(*out, "rank").unionAll(rows.where(~won).select(*out, F.lit(None).cast("bigint").alias("rank")))

"""Exact top-k by inner product: columnar branch-and-bound.

Components become integers floor(scale * x); the score is their inner product.
Candidates are cut into blocks by a hash of the row, queries into blocks by rows;
every pair of blocks is one group (a stated query set against all rows). Inside a
group the candidates lie dimension by dimension; per query the score is
accumulated over blocks of dimensions, the mass that remains bounds what can still come
(Cauchy-Schwarz), and candidates whose upper bound is below the k-th best
lower bound are dropped, the rest compacted. Each group sends k rows per query; the
best k of those are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import checkpoint_root, ship_package

BLOCK_ROWS = 16_384  # candidates in a group
QUERY_ROWS = 1024  # queries in a group
DIMENSIONS = 16  # accumulated between two compactions


def best_of_block(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray,
                  k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query (positions, scores) of its k best candidates, without its own row;
    ties to the smaller id (a missing id last: callers pass a large one)."""
    n, d = vectors.shape
    reach = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(d, 1)
    # Sums below 2**53 are exact in doubles; larger ones go in 64 bits or Python integers.
    kind = np.float64 if reach < 1 << 53 else np.int64 if reach < 1 << 62 else object
    down = np.ascontiguousarray(vectors.T.astype(kind))  # vertical: one row per dimension
    cuts = list(range(0, d, DIMENSIONS)) + [d]
    square = vectors.T.astype(np.float64) ** 2
    rest = [np.sqrt(square[c:].sum(0)) for c in cuts]  # candidates' mass from each cut on
    out = []
    for q, own in zip(queries, query_rows):
        live = np.flatnonzero(rows != own)
        score = np.zeros(len(live), kind)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = down[a:b] if len(live) == n else down[a:b][:, live]
            score = score + q[a:b].astype(kind) @ part
            mass = float(np.sqrt((q[b:].astype(np.float64) ** 2).sum()))
            if b < d and len(live) > k:
                s, slack = score.astype(np.float64), mass * rest[i + 1][live] * (1 + 1e-9) + 1e-6
                low = s - slack - np.abs(s) * 1e-12
                keep = s + slack + np.abs(s) * 1e-12 >= np.partition(low, len(low) - k)[len(low) - k]
                if keep.sum() < 0.8 * len(live):
                    live, score = live[keep], score[keep]
        if len(live) > k:  # everything that ties with the k-th stays for the order by id
            bound = np.partition(score, len(score) - k)[len(score) - k] if kind is not object else sorted(score)[-k]
            keep = score >= bound
            live, score = live[keep], score[keep]
        by = np.lexsort((rows[live], ids[live], -score if kind is not object else np.array([-x for x in score], object)))[:k] \
            if kind is not object else np.array(sorted(range(len(live)), key=lambda j: (-score[j], ids[live[j]], rows[live[j]]))[:k], int)
        out.append((live[by], score[by]))
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    c = column.combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    flat = c.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(c), -1).astype(np.int64)


def top_k(table: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding",
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, <key>, score)``: for each row whose key is divisible by ``every``,
    the k largest inner products with the other rows (all, if fewer); ties to the
    smaller key.

    Vectors that are null or hold a null or non-finite component take no part; a
    vector meets those of its own length only (an empty one scores 0). A null key is never a
    query and comes last among ties. Repeated rows are rows of their own: each
    may be found, and each asks. Other columns are not read.
    """
    spark = table.sparkSession
    checkpoint_root(spark)
    ship_package(spark)
    whole = F.transform(F.col("v"), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = (table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("v").isNotNull() & finite)
            .select("id", whole.alias("v"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")).checkpoint())
    asks = rows.where(F.col("id") % every == 0)
    n, m = rows.count(), asks.count()
    blocks, groups = -(-n // block_rows) or 1, -(-m // query_rows) or 1
    spread = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("row")), F.lit(c)).cast("int")
    every_of = lambda c: F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
    left = rows.withColumn("b", spread(blocks, 1)).withColumn("g", every_of(groups))
    right = asks.withColumn("g", spread(groups, 2)).withColumn("b", every_of(blocks))

    def run(cand: pa.Table, ask: pa.Table) -> pa.Table:
        schema = pa.schema([("ask", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
        if not cand.num_rows or not ask.num_rows:
            return schema.empty_table()
        ids = cand["id"].to_numpy()
        known = cand["id"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        order = np.where(known, np.nan_to_num(ids), np.iinfo(np.int64).max).astype(np.int64)
        got = best_of_block(_matrix(cand["v"]), order, cand["row"].to_numpy(), _matrix(ask["v"]), ask["row"].to_numpy(), k)
        size = [len(p) for p, _ in got]
        at = np.concatenate([p for p, _ in got]).astype(int)
        return pa.table([np.repeat(ask["row"].to_numpy(), size), np.repeat(ask["id"].to_numpy(), size), cand["id"].take(pa.array(at)),
                         pa.array([int(x) for _, s in got for x in s], pa.int64())], schema=schema)

    found = (left.groupBy("dim", "g", "b").cogroup(right.groupBy("dim", "g", "b"))
             .applyInArrow(run, "ask bigint, query_id bigint, id bigint, score bigint"))
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))

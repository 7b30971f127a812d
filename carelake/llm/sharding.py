"""Shards of near-equal bytes by sampled splitters.

Records are ordered by a key (here a hash of the text, so equal texts lie together;
ties by document id). A size-weighted sample of keys gives quantile boundaries; records
are range-partitioned by them. A range with more than its share of bytes or rows is subdivided
by a hash of the document id, and a part that is still overfull (rows equal in id and key, which such a
hash cannot tell apart) by the rows' numbers. Exact bytes and rows of every cell (range, part) then give
each cell its offset, by running sums over range partitions of the cells; a running sum inside the cell
gives each record its own, and the offset decides the shard: no shard is off by more
than a document at either end. All steps sort one cell at a time; cells are bounded
in rows by a factor of ``ROWS_PER_CELL``, whatever the keys' distribution.

What reaches the driver is bounded by parameters: the sample (``SAMPLES_PER_RANGE`` keys for
each of at most ``MAX_RANGES`` ranges, twice that at most), the overfull ranges, and one row per shard.
Cells, one per ``ROWS_PER_CELL`` records, stay a table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.operators.places import with_running_sum
from carelake.session import checkpoint_root, ship_package

ROWS_PER_CELL = 200_000
RANGES_PER_SHARD = 8  # at least
MAX_RANGES = 8192  # what is more is left to subdividing
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0
OVERHEAD = 16  # bytes a record takes besides its text


def splitters(keys: np.ndarray, weights: np.ndarray, ranges: int) -> np.ndarray:
    """Distinct boundaries at the weighted quantiles of a sample."""
    if not len(keys):
        return np.zeros(0, np.int64)
    by = np.argsort(keys, kind="stable")
    upto = np.cumsum(weights[by])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges)
    return np.unique(keys[by][np.minimum(at, len(keys) - 1)])


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", order: Column | None = None,
          seed: int = 11) -> DataFrame:
    """``<key>, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``order`` is the sort key (a bigint expression; default: a hash of the text).
    ``size`` is the text's UTF-8 bytes plus 16 (null text: 16, crc32 of no bytes; texts of any length); ``slot``
    counts from 0 within a shard, in the order of the sort key; law ``bytes``: shards
    near equal in size. Rows with equal keys and texts are interchangeable, each with a slot of its own; null
    keys come first among equal texts; other columns are not read; an empty table gives no rows.
    """
    return _placed(docs, shards, key, text, order, seed).select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _placed(docs: DataFrame, shards: int, key: str, text: str, order: Column | None, seed: int, whole: bool = False) -> DataFrame:
    """``id, size, crc, shard, slot`` of every row and, with ``whole``, the row itself as a struct ``doc``."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    ship_package(spark)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []
    rows = docs.select(F.col(key).alias("id"), (F.octet_length(t) + OVERHEAD).cast("bigint").alias("size"), F.crc32(t.cast("binary")).alias("crc"),
                       (F.xxhash64(t) if order is None else order).cast("bigint").alias("k"), *doc,
                       F.monotonically_increasing_id().alias("row")).checkpoint()
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, -(-n // ROWS_PER_CELL)))
    # Each record is sampled with a probability in proportion to its size; a record
    # above the step is certain and weighs as much as it holds.
    step = max(1.0, total / (ranges * SAMPLES_PER_RANGE))
    sample = (rows.where(_uniform(F.lit(seed), F.col("id"), F.col("k"), F.col("row")) * step < F.col("size"))
              .select("k", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("w")).toPandas())
    cut = spark.sparkContext.broadcast(splitters(sample["k"].to_numpy(np.int64), sample["w"].to_numpy(float), ranges))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cut.value, k.to_numpy(), side="right").astype(np.int32))

    rows = rows.withColumn("range", range_of("k"))
    share = total / ranges

    def parts_of(cells: DataFrame) -> DataFrame:
        """Cells over their share of bytes or rows, with the number of parts they are to have."""
        b, m = F.col("b") / F.lit(share or 1.0), F.col("n") / F.lit(float(ROWS_PER_CELL))
        return cells.where((b > OVERFULL) | (m > OVERFULL)).withColumn("parts", F.ceil(F.greatest(b, m)).cast("int")).drop("b", "n")

    def measured(by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))

    def divided(by: list[str], name: str, *hashed: Column) -> DataFrame:
        """``rows`` with ``name``: the part within an overfull cell, by a hash; 0 elsewhere. The cells that are
        divided hold over twice their share: at most ``ranges`` / 2 plus one per 2 * ROWS_PER_CELL rows."""
        full = parts_of(measured(by)).checkpoint()
        if not full.limit(1).count():
            return rows.withColumn(name, F.lit(0))
        part = F.floor(_uniform(F.lit(seed + 1), F.lit(name), *hashed) * F.coalesce("parts", F.lit(1))).cast("int")
        return rows.join(full.hint("broadcast") if len(by) == 1 else full, by, "left").withColumn(name, part).drop("parts")

    rows = divided(["range"], "part", F.col("id"), F.col("k")).checkpoint()
    rows = divided(["range", "part"], "sub", F.col("row"))
    cell = ["range", "part", "sub"]
    begin = with_running_sum(measured(cell), cell, {"b_upto": "b", "n_upto": "n"}).select(
        *cell, (F.col("b_upto") - F.col("b")).cast("bigint").alias("at"), (F.col("n_upto") - F.col("n")).cast("bigint").alias("rank"))
    order_in = Window.partitionBy(*cell).orderBy("k", "id", "size", "crc", "row")
    placed = (rows.withColumns({"upto": F.sum("size").over(order_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                                "no": F.row_number().over(order_in)})
              .join(begin, cell)
              .withColumn("middle", F.col("at") + F.col("upto") - F.col("size") / 2.0)
              .select("id", "size", "crc", *(["doc"] if whole else []), (F.col("rank") + F.col("no") - 1).alias("rank"),
                      F.least(F.lit(shards - 1), F.floor(F.col("middle") * shards / F.lit(float(max(total, 1)))).cast("int")).alias("shard"))
              .checkpoint())
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    first = spark.createDataFrame([tuple(r) for r in first.collect()], "shard int, first bigint")  # one row per shard
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("rank") - F.col("first")).drop("rank", "first")


def write_shards(docs: DataFrame, folder: str, shards: int = 40, key: str = "doc_id", text: str = "text") -> str:
    """Write ``docs`` under ``folder/shard=<n>/`` in slot order (several files for a large shard), each row with its
    ``slot``; repeated rows have slots of their own. A column of ``docs`` called ``shard`` or ``slot`` is
    written with an underscore in front."""
    placed = _placed(docs, shards, key, text, None, 11, whole=True)
    taken = {"shard", "slot"} | {c.lower() for c in docs.columns}
    names = []
    for c in docs.columns:
        name = c
        while c.lower() in ("shard", "slot") and name.lower() in taken:
            name = "_" + name
        names.append(name)
    out = placed.select(*[F.col(f"doc.`{c}`").alias(n) for c, n in zip(docs.columns, names)], "slot", "shard")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return folder

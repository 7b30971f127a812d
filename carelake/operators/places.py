"""Places and running sums in a global order without a window over all rows.

Rows are range-partitioned and sorted by the order's columns; a row's place is its index
within its partition plus the rows of all partitions before, one count per partition. Running sums
are made the same way from one total per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import checkpoint_root

_INDEX_BITS = 33  # monotonically_increasing_id: partition above, index within it below


def with_place(df: DataFrame, order: list[Column | str], name: str = "place", partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: 1, 2, 3, ... in the given order (rows equal in it: any order).

    Equal rows of the order lie in one partition: let the order end with a key. An empty table
    stays empty; a column called ``name`` is replaced. The sorted rows are checkpointed, so that their
    partitions and their counts cannot drift apart when a task runs again.
    """
    checkpoint_root(df.sparkSession)
    part, index = "__part", "__index"
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    at = F.monotonically_increasing_id()
    rows = (ranged.sortWithinPartitions(*order)
            .withColumns({part: F.shiftright(at, _INDEX_BITS), index: at.bitwiseAND((1 << _INDEX_BITS) - 1)}).checkpoint())
    # One row per partition: as many as the range partitioning has, whatever the rows.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return (rows.join(F.broadcast(starts), part)
            .withColumn(name, F.col("__start") + F.col(index) + 1).drop(part, index, "__start"))


def with_running_sum(df: DataFrame, order: list[Column | str], sums: dict[str, str], partitions: int | None = None) -> DataFrame:
    """``df`` with a column per entry of ``sums`` (``{name: column}``): the exact sum of an integer or decimal
    column over the row and all rows before it in ``order`` (which must end with a key)."""
    checkpoint_root(df.sparkSession)
    part = "__part"
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = (ranged.sortWithinPartitions(*order)
            .withColumn(part, F.shiftright(F.monotonically_increasing_id(), _INDEX_BITS)).checkpoint())
    wide = {c: F.col(c).cast("decimal(38,0)") if not str(rows.schema[c].dataType.simpleString()).startswith("decimal") else F.col(c)
            for c in sums.values()}
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    totals = rows.groupBy(part).agg(*[F.sum(wide[c]).alias(n) for n, c in sums.items()])
    starts = totals.select(part, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.select("*", *[F.sum(wide[c]).over(inside).alias(n) for n, c in sums.items()]).join(F.broadcast(starts), part)
    return out.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop(part, *[f"__{n}" for n in sums])

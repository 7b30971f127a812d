"""Joins of a large table with a side that is usually small.

``join_small`` broadcasts the small side only after proving its size.

* ``check="count"``: the small side is evaluated once into the shared
  checkpoint folder; its stored rows are counted and their bytes summed (partial
  sums per task), and the join reads the stored rows (nothing is computed
  twice). Within both bounds it is broadcast. Beyond them the join is a shuffle
  join whose skewed partitions (a hot key with, say, a third of all rows) the
  adaptive skew-join rule splits over several tasks.
* ``check="stored"``: the same for a small side that is stored already (``stored``), so that a caller
  can look at it first.
* ``check="runtime"``: for small sides that are expensive to evaluate (an
  aggregate over a large table): the join is planned as a shuffle join, and
  adaptive execution turns it into a broadcast join only after measuring the side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import checkpoint_root

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32  # bytes a row takes besides its values, about


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: values by the length of their text, plus an overhead a row."""
    width = sum((F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in df.columns), F.lit(0))
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n, size + n * ROW_OVERHEAD


def stored(small: DataFrame) -> DataFrame:
    """``small``, evaluated once into the shared checkpoint folder."""
    checkpoint_root(small.sparkSession)
    return small.checkpoint(eager=True)


def join_small(big: DataFrame, small: DataFrame, on: list[str] | str, how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
               check: str = "count") -> DataFrame:
    """Equi-join ``big`` with ``small`` on column names ``on``.

    ``how`` is one of inner, left, left_semi, left_anti (the small side is never
    the preserved side).
    """
    on = [on] if isinstance(on, str) else list(on)
    if check == "runtime":
        return big.join(small, on, how)
    if check == "count":
        small = stored(small)
    rows, size = measured(small)
    if rows <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("merge"), on, how)

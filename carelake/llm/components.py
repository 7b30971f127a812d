"""Connected components of a large edge list, by alternating star rounds.

Every round is two aggregations and two joins on the node; no node's neighbours
are ever gathered in one task's memory. A hub (a node with more than its part of all edges) is not
shuffled to one task either: hubs are few by definition (at most 2 * ``HUBS`` of them), so their rows
go to the edges as a broadcast. Edges are cut off from their lineage by ``checkpoint()`` in the shared
folder each round. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import checkpoint_root

HUBS = 50_000  # a node with more than this part of all edges is a hub
HUB_EDGES = 256  # and more than these


def _beside(edges: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """``edges(u, v)`` joined to ``low(u, m, n)`` on u; n: edges of u, of ``total`` in all."""
    low = low.checkpoint()
    hub = F.col("n") > max(HUB_EDGES, total // HUBS)
    hubs = F.broadcast(low.where(hub).select("u", "m"))  # as both ends count, at most 2 * HUBS rows
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(low.where(~hub).select("u", "m"), "u")
    return edges.join(hubs, "u").select("u", "v", "m").unionAll(rest.select("u", "v", "m"))


def _large_star(e: DataFrame, total: int) -> DataFrame:
    """Larger neighbours of u are linked to the smallest of u and its neighbours."""
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return (_beside(both.where(F.col("v") > F.col("u")), low, total)
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))


def _small_star(e: DataFrame, total: int) -> DataFrame:
    """u (always the larger end here) and its smaller neighbours are linked to the smallest."""
    low = e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return (_beside(e, low, total)
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").where("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one orderable type -> ``(u, root)`` for every node that is
    not itself the smallest of its component. Loops and repeated edges are harmless;
    no edges give no rows."""
    checkpoint_root(edges.sparkSession)
    e = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .distinct().checkpoint())
    seen = None
    while True:
        sign = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign[0] == 0 or sign == seen:
            return e.select("u", F.col("v").alias("root"))
        seen = sign
        e = _small_star(_large_star(e, sign[0]).checkpoint(), sign[0]).checkpoint()

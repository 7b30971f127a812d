"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources share a budget of words by weight; a target stops at
``max_copies`` times its source's size and the excess is shared again by weight. In closed form:
with the sources sorted by cap / weight, a prefix is capped and the others share what it leaves; running
sums over that order find the prefix.

A document's expected copies e are proportional to its importance (a number per document, rounded
down to a quarter power of two, its level), capped at ``max_copies``; the factor follows from the
source's target by the same running sums over the levels. The whole part of e is certain. What is left
is drawn as a sample of fixed size (in words) with unequal probabilities p: documents are ranked by
their random odds u / (1 - u) divided by the odds of p, and taken in this order until the source's
remaining words are used up. A document larger than what is left is passed over.

The order is never made by sorting a source. Ranks are cut into cells of about ``ROWS_PER_CELL``
documents; the cells' words are summed (map-side first, so a source with a third of all rows is no
larger than another), all cells before the one in which the words run out are taken whole, and only
that one cell of each source is ordered and gone through document by document. One more document
closes the gap, if it brings the words nearer to the target. A fixed number of jobs, whatever the data.

Per source there is one row per level in the plan, and it stays a table: joined to the documents as a
broadcast if its size is proven small, else by a shuffle join with skewed keys split.
Ranks come from a hash of key, source and text and from exact sums: no state, the same on every run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.operators.joins import join_small
from carelake.operators.places import with_place, with_running_sum
from carelake.session import checkpoint_root, ship_package

ROWS_PER_CELL = 10_000
RANK_BITS = 48  # ranks as integers
LEVELS = 256  # of importance, at most: a quarter power of two each
WORD = r"[^\x20\x09-\x0D]+"
KEEP = "decimal(38,6)"  # weights as exact numbers


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def length_class(text: str = "text") -> Column:
    """An importance: the square root of a text's words, so that longer documents have better odds."""
    return F.sqrt(n_words(F.col(text)))


def targets(sources: DataFrame, weights: Sequence[float], share: float, max_copies: int) -> DataFrame:
    """``sources(s, size)`` with ``target``: the words of each source's share.

    Sources in the order of their names (code points, null last) weigh ``weights``, repeating.
    """
    w = F.element_at(F.array(*[F.lit(x).cast(KEEP) for x in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    placed = with_place(sources, [F.col("s").asc_nulls_last()]).withColumn("w", w)
    placed = placed.withColumns({"cap": F.col("size") * max_copies, "ratio": F.col("size") * max_copies / F.col("w").cast("double")})
    placed = with_running_sum(placed, ["ratio", "place"], {"caps": "cap", "ws": "w"})
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("w"), F.lit(0).cast(KEEP)).alias("w")).first()
    budget, all_w = share * float(total["size"]), float(total["w"])
    # What is left for a source and those after it, if all before are capped.
    left = F.lit(budget) - (F.col("caps") - F.col("cap")).cast("double")
    rest = F.lit(all_w) - (F.col("ws") - F.col("w")).cast("double")
    capped = left * F.col("w").cast("double") / F.greatest(rest, F.lit(1e-300)) > F.col("cap")
    placed = placed.withColumn("capped", capped)
    done = placed.where("capped").agg(F.coalesce(F.sum("cap"), F.lit(0)).cast("double").alias("cap"),
                                      F.coalesce(F.sum("w"), F.lit(0).cast(KEEP)).cast("double").alias("w")).first()
    free = all_w - done["w"]
    per_weight = (budget - done["cap"]) / free if free > 0 else 0.0
    return placed.select("s", "size", F.when(F.col("capped"), F.col("cap").cast("double"))
                         .otherwise(F.col("w").cast("double") * per_weight).alias("target"))


class Mix:
    """The plan of a mix. ``apply`` gives every document its number of copies.

    ``importance``: a column or expression of the documents (null or below zero: 0); the default
    gives all documents of a source the same odds.
    """

    def __init__(self, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_copies: int = 2,
                 key: str = "doc_id", text: str = "text", source: str = "source", importance: Column | str | None = None, seed: int = 7):
        self.key, self.text, self.source, self.importance, self.seed = key, text, source, importance, seed
        self.max_copies = max_copies
        checkpoint_root(docs.sparkSession)
        ship_package(docs.sparkSession)
        #: What the plan is made from; also the documents' keys and sizes for a report.
        self.rows = docs.select(F.col(key).alias("key"), *[c.alias(n) for n, c in self._expressions().items()]).checkpoint()
        levels = self.rows.groupBy("s", "sk", "level").agg(F.sum("size").alias("m"), F.count(F.lit(1)).alias("n")).checkpoint()
        per = targets(levels.groupBy("s").agg(F.sum("m").alias("size")), weights, share, max_copies)
        self.plan = self._factors(levels, per).checkpoint()
        self._draw()

    def _expressions(self) -> dict[str, Column]:
        """Row-local: source and its key in joins, size, level, a uniform number and a tie-breaker."""
        of = [F.col(self.key), F.col(self.source), F.col(self.text)]
        h = F.xxhash64(F.lit(self.seed), *of)
        s, size = F.col(self.source).cast("string"), n_words(F.col(self.text))
        if self.importance is None:
            level = F.lit(0)
        else:
            w = (F.col(self.importance) if isinstance(self.importance, str) else self.importance).cast("double")
            half = LEVELS // 2
            level = F.when(w > 0, F.greatest(F.lit(1 - half), F.least(F.lit(half - 1), F.floor(4 * F.log2(w) + 1e-9).cast("int"))))
        return {"s": s, "sk": F.coalesce(F.concat(F.lit("s"), s), F.lit("null")), "size": size, "level": F.coalesce(level, F.lit(-LEVELS)),
                "u": (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53)), "tie": F.xxhash64(F.lit(self.seed + 1), *of)}

    def _factors(self, levels: DataFrame, per: DataFrame) -> DataFrame:
        """Per source and level: certain copies ``whole``, chance ``p`` of one more, and of the source
        its size, target, words to draw and number of cells."""
        w = F.when(F.col("level") > -LEVELS, F.pow(F.lit(2.0), F.col("level") / 4.0)).otherwise(0.0)
        x = levels.join(per.select(F.coalesce(F.concat(F.lit("s"), "s"), F.lit("null")).alias("sk"), "size", "target"), "sk").withColumn("w", w)
        down = Window.partitionBy("sk").orderBy(F.desc("level"))  # at most LEVELS rows of a source
        higher = F.coalesce(F.sum(F.col("m") * self.max_copies).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        here_on = F.sum(F.col("m") * F.col("w")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        f = F.when(here_on > 0, (F.col("target") - higher) / here_on).otherwise(0.0)
        x = x.withColumn("f", f).withColumn("full", F.col("f") * F.col("w") > self.max_copies)
        every = Window.partitionBy("sk")
        factor = F.max_by("f", F.when(~F.col("full"), F.col("level"))).over(every)  # of the highest level that is not capped
        e = F.when(F.col("full"), F.lit(float(self.max_copies))).otherwise(F.greatest(F.lit(0.0), F.coalesce(factor, F.lit(0.0))) * F.col("w"))
        x = x.withColumn("e", F.least(F.lit(float(self.max_copies)), e)).withColumn("whole", F.floor(F.col("e") + F.lit(1e-9)).cast("int"))
        x = x.withColumn("p", F.greatest(F.col("e") - F.col("whole"), F.lit(0.0)))
        drawn = F.sum(F.when(F.col("p") > 0, F.col("n"))).over(every)
        mean = F.sum(F.col("n") * F.col("p")).over(every) / drawn
        return x.select("sk", "s", "level", "size", "target", "whole", "p", mean.alias("mean"),
                        F.ceil(F.coalesce(drawn, F.lit(0)) / F.lit(float(ROWS_PER_CELL))).cast("bigint").alias("cells"),
                        F.greatest(F.lit(0.0), F.col("target") - F.sum(F.col("whole") * F.col("m")).over(every)).alias("gap"))

    def _ranked(self, rows: DataFrame) -> DataFrame:
        """Adds the plan's columns, ``rank`` (null: no chance of one more) and ``cell``.

        The rank is odds(u) / odds(p) as q / (1 + q), in ``RANK_BITS`` bits; the odds of the source's mean
        p, which change no order, spread the ranks evenly over the cells.
        """
        plan = self.plan.select("sk", "level", F.col("size").alias("source_size"), "target", "whole", "p", "mean", "cells")
        x = join_small(rows, plan, ["sk", "level"], "left", check="stored")
        q, mean, p, u = F.col("u") * (1 - F.col("p")), F.col("mean"), F.col("p"), F.col("u")
        a, b = q * mean, (1 - u) * p * (1 - mean)
        a, b = (F.when(mean < 1, a).otherwise(q)), (F.when(mean < 1, b).otherwise((1 - u) * p))
        rank = F.when(p > 0, F.least(F.lit((1 << RANK_BITS) - 1), F.floor(a / (a + b) * float(1 << RANK_BITS)).cast("bigint")))
        x = x.withColumn("rank", rank)
        return x.withColumn("cell", F.floor(F.col("rank") / float(1 << RANK_BITS) * F.col("cells")).cast("bigint"))

    def _draw(self) -> None:
        """``lines``: per source the place up to which all are taken; ``extra``: documents behind it that are."""
        # Repeated rows are taken together: one document of all their words.
        drawn = self._ranked(self.rows).where("rank is not null").groupBy("sk", "cell", "rank", "tie").agg(F.sum("size").alias("size")).checkpoint()
        gaps = self.plan.groupBy("sk").agg(F.first("gap").alias("gap"))
        cells = drawn.groupBy("sk", "cell").agg(F.sum("size").alias("n")).join(gaps, "sk")  # a row per ROWS_PER_CELL documents
        upto = F.sum("n").over(Window.partitionBy("sk").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        crossing = (cells.withColumn("upto", upto).where("upto > gap").groupBy("sk")
                    .agg(F.min_by(F.struct("cell", (F.col("gap") - F.col("upto") + F.col("n")).alias("room")), "cell").alias("x"))
                    .select("sk", "x.*").checkpoint())
        at = join_small(drawn, crossing, ["sk", "cell"], check="stored").select("sk", "rank", "tie", "size", "room")
        found = at.repartition("sk").sortWithinPartitions("sk", "rank", "tie").mapInArrow(_greedy, _FOUND).checkpoint()
        # One document closes the gap: the nearest in size of those not taken.
        lines = found.where("line").select("sk", "rank", "tie", "room")
        left = join_small(drawn, lines.select("sk", F.col("rank").alias("line_rank"), F.col("tie").alias("line_tie"), F.col("room").alias("gap")).checkpoint(),
                          "sk", check="stored")
        more = found.where("NOT line").select("sk", "rank", "tie").withColumn("taken", F.lit(True)).checkpoint()
        left = left.where(_behind("rank", "tie", "line_rank", "line_tie") & (F.abs(F.col("size") - F.col("gap")) < F.col("gap")))
        left = join_small(left, more, ["sk", "rank", "tie"], "left_anti", check="stored")
        close = left.groupBy("sk").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "rank", "tie")).alias("x"))
        self.extra = more.unionAll(close.select("sk", "x.rank", "x.tie", F.lit(True))).checkpoint()
        #: Of a source without a line (all of it is taken) there is no row.
        self.lines = lines.select("sk", F.col("rank").alias("line_rank"), F.col("tie").alias("line_tie")).checkpoint()

    def _copies(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns of ``_expressions`` -> adds ``copies, source_size, target``."""
        x = join_small(self._ranked(rows), self.lines, "sk", "left", check="stored")
        x = join_small(x, self.extra, ["sk", "rank", "tie"], "left", check="stored")
        before = F.col("line_rank").isNull() | ~_behind("rank", "tie", "line_rank", "line_tie")
        more = F.col("rank").isNotNull() & (before | F.coalesce("taken", F.lit(False)))
        return x.withColumn("copies", F.col("whole") + more.cast("int"))

    def report(self) -> DataFrame:
        """Per document: ``<key>, size, source_size, target`` (its source's), ``taken`` (words,
        repeats counted), ``copies``."""
        return self._copies(self.rows).select(F.col("key").alias(self.key), "size", "source_size", "target",
                                              (F.col("size") * F.col("copies")).alias("taken"), "copies")

    def apply(self, docs: DataFrame) -> DataFrame:
        """The documents the mix takes, each as often as it is taken; columns as in ``docs``."""
        x = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in self._expressions().items()])
        x = self._copies(x).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        return x.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def _behind(rank: str, tie: str, line_rank: str, line_tie: str) -> Column:
    return (F.col(rank) > F.col(line_rank)) | ((F.col(rank) == F.col(line_rank)) & (F.col(tie) > F.col(line_tie)))


_FOUND = "sk string, rank bigint, tie bigint, room double, line boolean"


def _greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through the documents of each source's last cell in the order of their ranks, with the words
    left in hand. Gives a row per source (``line``: the last document before the first one that does not
    fit; what is left at the end) and one per document taken behind it."""
    sk = None
    room, line, passed, extra = 0.0, (-1, 0), False, []

    def rows():
        return [(sk, *line, room, True), *[(sk, r, t, 0.0, False) for r, t in extra]]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()))], names=["sk", "rank", "tie", "room", "line"])

    for b in batches:
        out = []
        for s, rank, tie, size, start in zip(*(b.column(k).to_pylist() for k in range(5))):
            if s != sk:
                if sk is not None:
                    out += rows()
                sk, room, line, passed, extra = s, start, (rank, tie - 1) if tie > -(1 << 63) else (rank - 1, (1 << 63) - 1), False, []
            if size > room:
                passed = True
            else:
                room -= size
                if passed and size:  # an empty document behind the line would come in at any gap
                    extra.append((rank, tie))
                elif not passed:
                    line = rank, tie
        if out:
            yield batch(out)
    if sk is not None:
        yield batch(rows())


def mix(docs: DataFrame, **options) -> Mix:
    """A mix of ``docs``. Defined results: a null or empty text has size 0 and takes
    no words; texts of any length count whole; a null source is a source of its own, after all others; rows equal in key, source
    and text share their rank, and are taken or left together; an empty table gives an
    empty report; other columns are carried along, whatever their names."""
    return Mix(docs, **options)

"""SimHash near-duplicates over a Gray-order hierarchical index.

Fingerprints: 64 bits over word shingles. Equal fingerprints are put together
first (hash aggregation), so a group of exact copies is one node from there on.

Links (at most ``distance`` differing bits) are found between distinct
fingerprints. A node of the index is a masked bit pattern that all fingerprints below
it share. The uppermost nodes are spread over the cluster: cutting the bits into
``distance + 1`` blocks, two linked fingerprints agree on one block at least, so
each fingerprint goes to one node per block. A node with more than ``node_rows``
fingerprints is divided further in the same way over its remaining bits (exact:
within the node the argument holds again). Inside a node fingerprints are sorted
by Gray rank, runs of them are factored into masked patterns level by level, and
pairs of such groups are followed downwards only while the differences on their
shared bits stay within the distance. A task joins what it links at once
(union by smallest) and sends one edge per fingerprint at most, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.components import components
from carelake.session import checkpoint_root, scratch_dir, ship_package

SEED = 42
NODE_ROWS = 2048
FANOUT = 8
PAIR_BLOCK = 16_384


# --- fingerprints ----------------------------------------------------------------------

def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit fingerprint of one text: A-Z lower-cased, words between ASCII
    white space, shingles of ``width`` words joined by a space (fewer words: the
    whole sequence), repeats included; a bit is set if more than half of the XXH64 values
    (UTF-8, seed 42) have it. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends))[:len(words) - width + 1].tolist()
    ends = (ends[width - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_280):
        bits = np.unpackbits(h[i:i + 65_280].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of 255 rows fit a byte
        if whole:
            counts += np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[whole:].sum(0, dtype=np.int64)
    return int(((counts * 2 > len(h)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fp)``: fp is the fingerprint as a signed 64-bit integer."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            fp = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return (docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, fp bigint"))


# --- the part of the index inside one task ---------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence (prefix xor of its bits)."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class _Forest:
    """Hierarchies over many nodes' fingerprints at once: ``group`` is sorted."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        order = np.lexsort((gray_rank(fp), group))
        self.order, leaf = order, fp[order]
        group = group[order]
        #: From the leaves up: (shared mask, pattern, first child, number of children).
        self.levels = [(np.full(len(leaf), ~np.uint64(0)), leaf, None, None)]
        while True:
            mask, value, _, _ = self.levels[-1]
            new = np.concatenate(([True], group[1:] != group[:-1]))
            begin = np.flatnonzero(new)
            within = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
            first = np.flatnonzero(within % FANOUT == 0)
            count = np.diff(np.append(first, len(group)))
            base = np.repeat(value[first], count)
            shared = np.bitwise_and.reduceat(mask & ~(value ^ base), first)
            self.levels.append((shared, value[first] & shared, first, count))
            group = group[first]
            if len(np.unique(group)) == len(group):
                break

    def link(self, distance: int) -> np.ndarray:
        """The smallest member (leaf position) of what each leaf is linked with inside its node."""
        label = np.arange(len(self.order))
        roots = np.arange(len(self.levels[-1][0]))
        todo = [(len(self.levels) - 1, roots[i:i + PAIR_BLOCK], roots[i:i + PAIR_BLOCK])
                for i in range(0, len(roots), PAIR_BLOCK)]
        while todo:  # depth first, in blocks: memory stays bounded
            level, a, b = todo.pop()
            if level == 0:
                _union(label, a, b)
                continue
            _, _, first, count = self.levels[level]
            mask, value, _, _ = self.levels[level - 1]
            step = np.arange(FANOUT)
            x = first[a][:, None] + step
            y = first[b][:, None] + step
            ok = (step < count[a][:, None])[:, :, None] & (step < count[b][:, None])[:, None, :]
            x, y = np.broadcast_to(x[:, :, None], ok.shape)[ok], np.broadcast_to(y[:, None, :], ok.shape)[ok]
            ok = (x <= y) if level > 1 else (x < y)
            x, y = x[ok], y[ok]
            ok = np.bitwise_count((value[x] ^ value[y]) & mask[x] & mask[y]) <= distance
            x, y = x[ok], y[ok]
            todo += [(level - 1, x[i:i + PAIR_BLOCK], y[i:i + PAIR_BLOCK]) for i in range(0, len(x), PAIR_BLOCK)]
        return label


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; label holds the smallest member of each set."""
    a, b = label[a], label[b]
    while len(a):
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            nxt = label[label]
            if np.array_equal(nxt, label):
                break
            label[:] = nxt
        a, b = label[a], label[b]
        ok = a != b
        a, b = a[ok], b[ok]


def linked_pairs(group: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) that join what is linked within each group of sorted ``group``."""
    size = np.unique(group, return_counts=True)[1]
    keep = np.repeat(size > 1, size)
    group, fp = group[keep], fp[keep]
    if not len(fp):
        return fp, fp
    forest = _Forest(group, fp)
    label = forest.link(distance)
    leaf = fp[forest.order]
    moved = label != np.arange(len(label))
    return leaf[moved], leaf[label[moved]]


# --- the part over the cluster ---------------------------------------------------------

def _blocks(free: int, parts: int) -> list[int]:
    """The bits set in ``free``, cut into ``parts`` blocks (as masks) of equal length, about."""
    bits = [i for i in range(64) if free >> i & 1]
    cut = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, distance: int, node_rows: int = NODE_ROWS) -> DataFrame:
    """Distinct ``fps(fp)`` -> edges ``(u, v)`` joining all fingerprints linked
    through steps of at most ``distance`` bits."""
    ship_package(fps.sparkSession)
    checkpoint_root(fps.sparkSession)
    parts = distance + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: np.ndarray) -> pa.RecordBatch:
            new = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            u, v = linked_pairs(np.concatenate(([0], np.cumsum(new))), rows[:, 2].copy().view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            held.append(np.column_stack([batch.column(k).to_numpy() for k in range(3)]).astype(np.int64))
            if sum(map(len, held)) < 32_768:
                continue
            rows = np.concatenate(held)
            change = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))
            cut = change[-1] + 1 if len(change) else 0
            if cut:
                yield out(rows[:cut])
            held = [rows[cut:]]  # a node may go on in the next batch
        if held and sum(map(len, held)):
            yield out(np.concatenate(held))

    edges, paths = None, [(0,)]
    rows = fps.select("fp", F.lit(0).cast("bigint").alias("mask"))
    while True:  # a node of more than node_rows needs free bits to tell them apart: few levels
        # One row per node below: its mask, and the fingerprint's bits under the mask.
        finer = {}
        for (mask,) in paths:
            finer[mask] = [mask | b for b in _blocks(~mask & (2**64 - 1), parts) if b]
        below = F.create_map(*[F.lit(x) for m, fs in finer.items()
                               for x in (_signed(m), F.array(*[F.lit(_signed(f)).cast("bigint") for f in fs]))])
        rows = (rows.select("fp", F.explode(below[F.col("mask")]).alias("mask"))
                .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")))
        full = rows.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_rows) \
            .select("mask", "bits").checkpoint()
        masks = [r[0] & (2**64 - 1) for r in full.select("mask").distinct().collect()]  # a few masks per level
        last = not masks or all(bin(~m & (2**64 - 1)).count("1") < parts for m in masks)
        leaf = rows if last else rows.join(full, ["mask", "bits"], "left_anti")
        found = (leaf.select("mask", "bits", "fp").repartition("mask", "bits").sortWithinPartitions("mask", "bits")
                 .mapInArrow(run, "u bigint, v bigint"))
        edges = found if edges is None else edges.unionAll(found)
        if last:
            return edges
        rows = rows.join(full, ["mask", "bits"], "left_semi").select("fp", "mask").checkpoint()
        paths = [(m,) for m in masks]


def _nodes(fps: DataFrame, distance: int, node_rows: int) -> DataFrame:
    """``fps(id, fp)`` -> per distinct fingerprint ``(fp, root, component_id)``; root is
    the smallest fingerprint of the component."""
    distinct = fps.groupBy("fp").agg(F.min("id").alias("low")).checkpoint()
    root = components(links(distinct.select("fp"), distance, node_rows)).withColumnRenamed("u", "fp")
    node = distinct.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = node.groupBy("root").agg(F.min("low").alias("component_id"))
    return node.join(low, "root").select("fp", "root", "component_id")


def _stored(docs: DataFrame, width: int, key: str, text: str) -> DataFrame:
    checkpoint_root(docs.sparkSession)
    folder = scratch_dir(docs.sparkSession, "simhash")
    fingerprints(docs, width, key, text).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text",
                    node_rows: int = NODE_ROWS) -> DataFrame:
    """``(<key>, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` as 16 lowercase hex digits; ``component_id`` is the smallest key
    reachable over links, the row's own included. Null or empty texts have
    fingerprint zero and are linked like any other; rows with a null key take part
    (a component without any key has a null id); repeated rows repeat. Other columns
    are not read. An empty table gives no rows.
    """
    fps = _stored(docs, width, key, text)
    node = _nodes(fps, distance, node_rows).select("fp", "component_id")
    return fps.join(node, "fp").select(F.col("id").alias(key),
                                       F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the
    smallest key; of several texts under that key the one whose sha256 is smallest, of equal rows
    any one. A component whose rows all have a null key keeps one of them by the same rule. Rows of
    different components never stand in for each other, whatever their keys.
    """
    name = "__" + "_" * max(map(len, docs.columns))  # no column of docs starts like that
    digest = F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256))
    marked = docs.select(F.struct(F.col(key).alias("k"), digest.alias("t")).alias("id"), F.col(text).alias("text"))
    fps = _stored(marked, width, "id", "text").select(F.col("id.k").alias("id"), F.col("id.t").alias("t"), "fp")
    node = _nodes(fps.select("id", "fp"), distance, NODE_ROWS)
    # One (key, text) per component, by its root; equal rows are counted along.
    of_key = fps.groupBy("fp", "id", "t").agg(F.count(F.lit(1)).alias("n")).join(node, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    first = of_key.groupBy("root").agg(F.min(F.struct("t", "id", "n")).alias("x")).select("x.*").checkpoint()
    first = first.select(F.col("id").alias(name + "id"), F.col("t").alias(name + "t"), F.col("n").alias(name + "n"))
    rows = docs.withColumn(name + "d", digest)
    kept = rows.join(first.drop(name + "n"), F.col(f"`{key}`").eqNullSafe(F.col(name + "id")) & (F.col(name + "d") == F.col(name + "t")), "left_semi")
    if first.where(F.col(name + "n") > 1).limit(1).count():
        kept = kept.dropDuplicates([key, name + "d"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct words, word starts (``START`` characters: inflected and
compound forms of a word share them), pairs of neighbouring words and skip-grams (two words
with one or two words between them), hashed into 2 ** ``bits`` coordinates. The model is
fitted online: every coordinate has its own learning rate, which falls with the squared
gradients it has seen, and the L1 term keeps a weight at exactly zero until its
evidence exceeds it. What is left is a short list of coordinates with weights (a few
thousand), which is broadcast; scoring gathers weights over whole slices of texts.

Fitting uses a bounded sample: ``PER_LABEL`` labelled ids of each label, those with the smallest
hash, joined to their texts by a broadcast of that size; features are made in parallel,
and one task runs over the examples, ``EPOCHS`` times, each time in another random order (a hash of
epoch and id: the hash that chose them would put the rarer label's rest at the end), as
a stream (its memory is the state of the model). The intercept is set for labels at the
square root of their true odds: halfway between the rare label's share and even odds,
as L1 holds the weights back. Scoring reads every text whole; rows stay where they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.pretokens import unused
from carelake.llm.vocab import held
from carelake.llm.wordarrays import LETTERS_DIGITS, ids, mapped, owners, slices, words
from carelake.session import checkpoint_root, ship_package

BITS = 20
PER_LABEL = 4800  # bound of the labelled sample, ids of each label
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.01
MAX_BITS = 26
START = 5  # characters of a longer word that make a feature of their own
SKIPS = (2, 3)  # distance of the two words of a skip-gram

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SALT = np.arange(1, 9, dtype=np.uint64) * _B


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(distinct: pa.Array) -> np.ndarray:
    own = np.fromiter(map(zlib.crc32, distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))
    return _mix(own * _A + _B)


def features(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, coordinate) of every word, word start, pair and skip-gram, repeats included.

    Words: small letters, runs of letters, digits and characters beyond ASCII.
    """
    offsets, flat = words(mapped(pc.utf8_lower(column), LETTERS_DIGITS).cast(pa.string()))
    at, distinct = ids(flat)
    if not len(flat):
        return
    h, owner, down = _hashes(distinct)[at], owners(offsets), np.uint64(64 - bits)
    yield owner, (h >> down).astype(np.int64)
    longer = np.asarray(pc.greater(pc.utf8_length(distinct), START))[at]
    begin = _mix(_hashes(pc.utf8_slice_codeunits(distinct, 0, START)) + _SALT[0])[at[longer]]
    yield owner[longer], (begin >> down).astype(np.int64)
    for gap in (1, *SKIPS):
        if len(h) > gap:
            inside = owner[:-gap] == owner[gap:]
            pair = _mix(h[:-gap][inside] * _A + h[gap:][inside] + _SALT[gap])
            yield owner[:-gap][inside], (pair >> down).astype(np.int64)


@dataclass(eq=False)
class Model:
    """Coordinates with a weight, ascending, and the intercept."""
    bits: int
    at: np.ndarray
    weight: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.at] = self.weight
        return out


class Ftrl:
    """FTRL-proximal on 0/1 features."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z0 = self.n0 = 0.0  # the intercept: a feature of every example, without L1

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def intercept(self) -> float:
        return -self.z0 / ((self.beta + np.sqrt(self.n0)) / self.alpha)

    def learn(self, at: np.ndarray, label: int) -> float:
        """One example (distinct coordinates); returns the probability before it was seen."""
        w, w0 = self.weights(at), self.intercept()
        p = float(_sigmoid(w.sum() + w0))
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        self.z0 += g - (np.sqrt(self.n0 + g * g) - np.sqrt(self.n0)) / self.alpha * w0
        self.n0 += g * g
        return p


def _sigmoid(x):
    with np.errstate(over="ignore"):  # far below zero: 0
        return 1.0 / (1.0 + np.exp(-x))


def held_out(key: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the key as text is divisible by 5 (a null key: false)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", bits: int = BITS,
        per_label: int = PER_LABEL, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """A model from the texts of the labelled ids (label over 0: toxic; null ids and labels are left out).

    An id with several labels counts as toxic if one of them says so; of an id with several texts
    the one with the smallest hash is learned from. The result depends neither on partitions nor on
    the order of rows. Without labelled texts the model scores 0.
    """
    if not 1 <= bits <= MAX_BITS:
        raise ValueError(f"bits must be 1 to {MAX_BITS}")
    spark = docs.sparkSession
    ship_package(spark)
    checkpoint_root(spark)
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k"))
             .agg(F.max((F.col(label) > 0).cast("int")).alias("label")))
    known = known.withColumn("h", F.xxhash64(F.col("k").cast("string"))).checkpoint()  # read by three jobs
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [known.where(F.col("label") == y).orderBy("h", "k").limit(per_label) for y in (0, 1)]
    sample = F.broadcast(few[0].unionAll(few[1]))  # at most 2 * per_label rows
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(text).cast("string").alias("text")).where("k is not null and text is not null")
    rows = (texts.join(sample, "k").withColumn("t", F.xxhash64("text"))
            .groupBy("h", "k", "label").agg(F.min_by("text", "t").alias("text")))

    def extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i, j in slices(batch.column(3)):
                pairs = [t.astype(np.int64) << bits | c for t, c in features(batch.column(3).slice(i, j - i), bits)]
                both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
                at = np.searchsorted(both >> bits, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i).cast(pa.string()), batch.column(2).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((both & ((1 << bits) - 1)).astype(np.int32)))],
                    names=["h", "k", "label", "at"])

    examples = rows.select("h", "k", "label", "text").mapInArrow(extract, "h bigint, k string, label int, at array<int>").checkpoint()
    passes = examples.select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "k", "label", "at")
    passes = passes.withColumn("o", F.xxhash64("epoch", "k"))

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Ftrl(1 << bits, alpha, beta, l1, l2), np.zeros(2, np.int64)
        for batch in parts:
            lists, y = batch.column(1), batch.column(0).to_pylist()
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, label_ in enumerate(y):
                model.learn(flat[offsets[k]:offsets[k + 1]], label_)
                seen[label_] += 1
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([w[at]], pa.list_(pa.float64())),
             pa.array([model.intercept()]), pa.array([seen.tolist()], pa.list_(pa.int64()))], names=["at", "w", "w0", "seen"])

    got = (passes.repartition(1).sortWithinPartitions("epoch", "o", "k").select("label", "at")
           .mapInArrow(learn, "at array<int>, w array<double>, w0 double, seen array<bigint>").collect())
    if not got or not sum(got[0]["seen"]):
        return Model(bits, np.zeros(0, np.int32), np.zeros(0, np.float32), -np.inf)
    r, n = got[0], [counts.get(0, 0), counts.get(1, 0)]
    shift = 0.5 * np.log((n[1] + 0.5) / (n[0] + 0.5)) - np.log((r["seen"][1] / epochs + 0.5) / (r["seen"][0] / epochs + 0.5))
    return Model(bits, np.array(r["at"], np.int32), np.array(r["w"], np.float32), float(r["w0"] + shift))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.weight = model, model.dense()

    def run(self, column: pa.Array) -> np.ndarray:
        """The probability of each text: a coordinate counts once, however often it occurs."""
        total, bits = np.full(len(column), self.model.intercept), self.model.bits
        hits = []
        for owner, at in features(column, bits):
            some = np.flatnonzero(self.weight[at])
            hits.append(owner[some] << bits | at[some])
        if hits:
            both = np.unique(np.concatenate(hits))
            total += np.bincount(both >> bits, self.weight[both & ((1 << bits) - 1)], len(column))
        return _sigmoid(total)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``score`` (0 to 1).

    A null or empty text has the intercept's score. Texts of any length count whole; repeated
    rows give repeated results, an empty table none; a kept column called ``score`` is replaced. No shuffle.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "score")]
    ship_package(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(model)  # 8 bytes per weight, at most 2 ** bits of them
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["score double"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("toxicity", data.value), lambda: Scorer(data.value))
        for batch in parts:
            for i, j in slices(batch.column(len(keep))):
                cols = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                got = scorer.run(batch.column(len(keep)).slice(i, j - i))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(got)], names=[*keep, "score"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(unused(docs))).mapInArrow(run, schema)


def fit_on_rest(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **more) -> Model:
    """A model from the labelled rows that are not held out."""
    return fit(docs.where(~held_out(key)), labels.where(~held_out(key)), key, **more)

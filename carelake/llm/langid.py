"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of words (lower case, padded at both
ends), of order ``ORDER``. The top order is discounted by its counts, lower orders by
the number of distinct left neighbours (Kneser-Ney), and every order is interpolated with the next
lower one down to a uniform distribution over the alphabet. A model is a pair of
sorted 64-bit hash arrays per order (n-grams with log probabilities, contexts with
log back-off weights), searched by bisection. The language with the lowest cross-entropy per
character wins; a calibration part of the training rows gives the rejection bound (how
far a text's cross-entropy may exceed what the language's own texts of that length
show, or what calibration texts of two known languages show when joined) and the
sharpness of the score.

Fitting uses a bounded sample of the labelled rows: about ``PER_LANGUAGE`` documents of each
language, taken by a hash of the key, whole texts; three quarters count, one quarter
calibrates. Prediction reads every text whole; rows stay where they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.pretokens import slices, unused
from carelake.llm.vocab import held
from carelake.session import checkpoint_root, ship_package

ORDER = 4
PER_LANGUAGE = 1500  # bound of the labelled sample, documents of each language
LEFT, RIGHT = "\x02", "\x03"
MAX_MODEL_BYTES = 512 * 1024 * 1024
WORDS = 200_000  # words in a worker's memo
SLACK = 1.5  # the rejection bound lies this much beyond the farthest calibration text
TRIM = 0.01  # of a language's calibration texts, the farthest: labelled texts that are mixed themselves
SHARES = tuple(k / 16 for k in range(1, 16))  # of one language in a calibration text of two
SHARPNESS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0)

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def letters(word: str) -> str:
    """The word without numerals that count as word characters (such as superscripts)."""
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold(points: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of code points."""
    h = np.full(len(points), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(points.shape[1]):
        h = _mix(h + points[:, k].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h


@dataclass
class LanguageModel:
    """Per order 1..n: sorted hashes of n-grams and of contexts, with log values."""
    grams: list[np.ndarray] = field(default_factory=list)
    log_p: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    log_back: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fit(cls, points: np.ndarray, counts: np.ndarray, alphabet: int) -> "LanguageModel":
        """From the distinct top-order n-grams (rows of code points) and their counts."""
        order = points.shape[1]
        levels = [(points, counts.astype(np.float64))]
        for _ in range(order - 1):  # continuation counts: distinct left neighbours
            tail = levels[-1][0][:, 1:]
            rows, n = np.unique(tail, axis=0, return_counts=True)
            levels.append((rows, n.astype(np.float64)))
        model, lower_hash, lower_p = cls(), None, None
        for rows, n in reversed(levels):  # order 1 first
            n1, n2 = np.sum(n == 1), np.sum(n == 2)
            discount = float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.95)) if n1 and n2 else 0.75
            context = _fold(rows[:, :-1])
            at, group = np.unique(context, return_inverse=True)
            total, types = np.bincount(group, n), np.bincount(group)
            back = discount * types / total
            below = 1.0 / alphabet if lower_p is None else lower_p[np.searchsorted(lower_hash, _fold(rows[:, 1:]))]
            p = np.maximum(n - discount, 0) / total[group] + back[group] * below
            h = _fold(rows)
            by = np.argsort(h)
            lower_hash, lower_p = h[by], p[by]
            model.grams.append(lower_hash)
            model.log_p.append(np.log(lower_p))
            model.contexts.append(at)
            model.log_back.append(np.log(back))
        return model

    def log_prob(self, hashes: list[np.ndarray], context: list[np.ndarray], alphabet: int) -> np.ndarray:
        """Log probability of each n-gram's last character; ``hashes[k]`` / ``context[k]``
        are the hashes of its last k + 1 characters / of those without the last one."""
        out = np.zeros(len(hashes[0]))
        todo = np.arange(len(out))
        for k in range(len(self.grams) - 1, -1, -1):
            h, keys = hashes[k][todo], self.grams[k]
            i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[i] == h
            out[todo[hit]] += self.log_p[k][i[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            c, keys = context[k][todo], self.contexts[k]
            i = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
            hit = keys[i] == c
            out[todo[hit]] += self.log_back[k][i[hit]]
        out[todo] -= np.log(alphabet)
        return out


@dataclass
class Model:
    languages: list[str]
    models: list[LanguageModel]
    alphabet: int
    order: int
    #: Per language: mean cross-entropy, its variance at any length, variance times length, bound in
    #: deviations, how far a text may lie beyond the mean that mixes two known languages.
    bound: np.ndarray | None = None
    sharpness: float = 10.0

    def nbytes(self) -> int:
        return sum(a.nbytes for m in self.models for arrays in (m.grams, m.log_p, m.contexts, m.log_back) for a in arrays)


class Scorer:
    """Log probabilities of texts under every language, by way of their distinct words."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.score = np.zeros((0, len(self.model.languages)))
        self.size = np.zeros(0, np.int64)

    def _add(self, words: list[str]) -> None:
        m, n = self.model, self.model.order
        clean = [letters(w) for w in words]
        pad = LEFT * (n - 1)
        stream = np.frombuffer("".join(pad + w + RIGHT for w in clean).encode("utf-32-le"), np.uint32)
        size = np.fromiter((len(w) for w in clean), np.int64, len(clean))
        begin = np.cumsum(size + n) - (size + n)
        grams = np.lib.stride_tricks.sliding_window_view(stream, n)
        at = np.repeat(begin - (np.cumsum(size + 1) - (size + 1)), size + 1) + np.arange(int((size + 1).sum()))
        points = grams[at]
        _, first, which = np.unique(_fold(points), return_index=True, return_inverse=True)
        points = points[first]
        hashes = [_fold(points[:, n - k - 1:]) for k in range(n)]
        context = [_fold(points[:, n - k - 1:n - 1]) for k in range(n)]
        starts = np.cumsum(size + 1) - (size + 1)
        score = np.column_stack([np.add.reduceat(lm.log_prob(hashes, context, m.alphabet)[which], starts) for lm in m.models])
        empty = size == 0  # nothing but numerals
        score[empty] = 0
        self.slot.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.score = np.concatenate([self.score, score])
        self.size = np.concatenate([self.size, np.where(empty, 0, size + 1)])

    def run(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each text per language, its length in characters and word ends)."""
        lists = [words_of(t) for t in texts]
        if len(self.slot) > WORDS:
            self._clear()
        flat = [w for ws in lists for w in ws]
        new = [w for w in dict.fromkeys(flat) if w not in self.slot]
        if new:
            self._add(new)
        at = np.fromiter(map(self.slot.__getitem__, flat), np.int64, len(flat))
        owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in lists])
        total = np.column_stack([np.bincount(owner, self.score[at, k], len(texts)) for k in range(len(self.model.languages))])
        return total, np.bincount(owner, self.size[at], len(texts)).astype(np.int64)


# --- fitting ----------------------------------------------------------------------------

def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
        per_language: int = PER_LANGUAGE) -> Model:
    """A model from rows with a language and a text (others are left out).

    The sample holds about ``per_language`` rows of each language (all, if fewer),
    chosen by a hash of key and text, so it does not depend on the partitioning.
    No labelled row at all gives a model without languages.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
                           F.xxhash64(F.col(key), F.col(text)).alias("h")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], [], 1, order)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    u = (F.shiftrightunsigned("h", 34) / float(1 << 30))
    checkpoint_root(spark)
    sample = rows.where(u < share[F.col("lang")]).withColumn("part", F.pmod("h", F.lit(4))).checkpoint()

    def grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found: Counter = Counter()
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update((name, w) for w in words_of(t))
            out: Counter = Counter()
            for (name, w), n in found.items():
                if w := letters(w):
                    p = LEFT * (order - 1) + w + RIGHT
                    for i in range(len(w) + 1):
                        out[name, p[i:i + order]] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()),
                                              pa.array(list(out.values()), pa.int64())], names=["lang", "gram", "n"])

    # The quarter that calibrates does not count; a language with few rows counts all.
    few = [k for k, n in sizes.items() if n < 40]
    counted = sample.where((F.col("part") != 3) | F.col("lang").isin(few)) if few else sample.where("part <> 3")
    table = (counted.select("lang", "text").mapInArrow(grams, "lang string, gram string, n bigint")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())  # bounded by the sample
    points = np.frombuffer("".join(table["gram"]).encode("utf-32-le"), np.uint32).reshape(-1, order) if len(table) \
        else np.zeros((0, order), np.uint32)
    alphabet = len(np.unique(points)) + 1
    models, kept = [], []
    for name in languages:
        mine = (table["lang"] == name).to_numpy()
        if mine.any():
            by = np.lexsort(points[mine].T[::-1])
            models.append(LanguageModel.fit(points[mine][by], table["n"].to_numpy()[mine][by], alphabet))
            kept.append(name)
    model = Model(kept, models, alphabet, order)
    if model.nbytes() > MAX_MODEL_BYTES:
        raise ValueError(f"the models take {model.nbytes()} bytes: lower per_language or order")
    if kept:
        _calibrate(model, sample.where((F.col("part") == 3) | F.col("lang").isin(few)) if few else sample.where("part = 3"))
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Set the rejection bound and the sharpness from labelled rows that did not count."""
    data = rows.sparkSession.sparkContext.broadcast(model)
    names = {k: i for i, k in enumerate(model.languages)}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(data)
        for batch in parts:
            for i, j, texts in slices(batch.column(1)):
                total, size = scorer.run(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(size),
                                                  pa.array(list(total), pa.list_(pa.float64()))], names=["lang", "size", "total"])

    got = rows.select("lang", "text").mapInArrow(run, "lang string, size bigint, total array<double>").toPandas()
    got = got[(got["size"] > 0) & got["lang"].isin(model.languages)].sort_values(["lang", "size"]).reset_index(drop=True)
    bound = np.tile(np.array([np.inf, 0.0, 0.0, 0.0, 0.0]), (len(names), 1))  # no calibration: nothing is rejected
    if len(got):
        size = got["size"].to_numpy(np.float64)
        cross = -np.stack(got["total"].to_numpy()) / size[:, None]
        true = got["lang"].map(names).to_numpy()
        own = cross[np.arange(len(got)), true]
        best = []
        for t in SHARPNESS:
            z = -t * cross
            best.append(np.mean(z[np.arange(len(got)), true] - np.logaddexp.reduce(z, axis=1)))
        model.sharpness = SHARPNESS[int(np.argmax(best))]
        clean = np.zeros(len(got), bool)
        for k in range(len(names)):
            mine = (true == k) & (cross.argmin(1) == k)
            if mine.sum() < 10:
                continue
            mine &= own <= np.quantile(own[mine], 1 - TRIM)
            clean |= mine
            mean = float(np.average(own[mine], weights=size[mine]))
            sq, inv = (own[mine] - mean) ** 2, 1 / size[mine]
            # Variance of a text's cross-entropy: a part at any length and a part that falls with it.
            falls = max(0.0, float(np.cov(sq, inv, bias=True)[0, 1] / max(np.var(inv), 1e-12)))
            any_length = max(1e-4, float(np.mean(sq) - falls * np.mean(inv)))
            far = float(np.max((own[mine] - mean) / np.sqrt(any_length + falls * inv)))
            bound[k] = mean, any_length, falls, max(6.0, SLACK * far), 0.0
        _allow_mixed(bound, -cross[clean], size[clean], true[clean])
    model.bound = bound


def _allow_mixed(bound: np.ndarray, log_p: np.ndarray, size: np.ndarray, true: np.ndarray) -> None:
    """Set the allowance for mixed texts: the farthest that calibration texts of two known
    languages, joined in ``SHARES``, lie beyond the mean of the language they are taken for.
    ``log_p`` per character; each language's texts ordered by ``size``."""
    own = [np.flatnonzero(true == k) for k in range(len(bound))]
    for a in range(len(bound)):
        for b, w in ((b, w) for b in range(a) for w in SHARES):
            n = max(len(own[a]), len(own[b])) if len(own[a]) and len(own[b]) else 0
            i, j = (x[np.arange(n) * len(x) // max(n, 1)] for x in (own[a], own[b]))  # of similar size
            cross = -(w * log_p[i] + (1 - w) * log_p[j])
            taken, length = cross.argmin(1), np.minimum(size[i] / w, size[j] / (1 - w))
            mean, any_length, falls, far, _ = bound[taken].T
            beyond = cross.min(1) - mean
            short = beyond <= far * np.sqrt(any_length + falls / length)  # stays by the bound of its length
            np.maximum.at(bound[:, 4], taken[~short], beyond[~short])


def _scorer(data) -> Scorer:
    """One scorer per worker process, for as long as its model is in use."""
    model = data.value
    return held(("langid", id(model)), lambda: Scorer(model))


# --- prediction -------------------------------------------------------------------------

def _judge(scorer: Scorer | None, m: Model, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the language, score, cross-entropy, rejected) of each text."""
    n, und = len(texts), len(m.languages)
    if not und:
        return np.zeros(n, int), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
    total, size = scorer.run(texts)
    some, length = size > 0, np.maximum(size, 1)
    cross = -total / length[:, None]
    pred, low = cross.argmin(1), cross.min(1)
    z = -m.sharpness * cross
    score = np.where(some, np.exp(z.max(1) - np.logaddexp.reduce(z, axis=1)), 0.0)
    mean, any_length, falls, far, mixed = m.bound[pred].T
    reach = np.maximum(far * np.sqrt(any_length + falls / length), mixed)
    rejected = ~some | (low - mean > reach)
    return np.where(some, pred, und), np.minimum(score, 1.0), np.where(some, low, np.nan), rejected


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``lang_pred``, ``score`` (0 to 1),
    ``cross_entropy`` (per character, null without letters) and ``rejected``.

    A null text, or one without letters, is ``und`` with score 0, and rejected; so is every
    text if the model knows no language. Repeated rows give repeated results. A
    kept column whose name is one of the new ones is replaced.
    """
    new = ["lang_pred", "score", "cross_entropy", "rejected"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    ship_package(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["lang_pred string", "score double", "cross_entropy double", "rejected boolean"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, m = _scorer(data), data.value
        names = np.array([*m.languages, "und"], object)
        for batch in parts:
            for i, j, texts in slices(batch.column(len(keep))):
                pred, score, low, out = _judge(scorer, m, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                    + [pa.array(names[pred], pa.string()), pa.array(score), pa.array(low, from_pandas=True), pa.array(out)],
                    names=keep + new)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(unused(docs))).mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with their columns as they are."""
    ship_package(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, m = _scorer(data), data.value
        for batch in parts:
            for i, j, texts in slices(batch.column(at)):
                out = _judge(scorer, m, texts)[3]
                yield batch.slice(i, j - i).filter(pa.array(~out))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the key as text leaves 2 when divided by 4 (a null key: false)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_rest(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows that are not held out and have a key."""
    return fit(docs.where(~held_out(key) & F.col(key).isNotNull()), key, text, lang)

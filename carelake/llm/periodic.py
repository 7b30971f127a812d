"""Runs of periodically repeated words.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``shortest`` words and ``repeats`` periods long, that no
neighbouring word extends with the same period.

Method: maximal-pair enumeration. A maximal pair is two equal stretches of l words,
d words apart, that differ in the word to their left and in the word to their
right. Together they span a stretch of l + d words with period d that cannot be
extended either way, so the pairs with l + d >= max(shortest, repeats * d) are exactly
the runs (each also with the multiples of its period: the least distance of a span is
the period). Maximal pairs are read off the tree of LCP intervals of the text's suffix
array, bottom-up: two suffixes that meet in an interval of value l from different
children match for exactly l words; a node keeps its positions in sorted lists by the
word to their left, and only lists of different left words make pairs.

What bounds the work:

* An interval matters from l >= shortest - shortest / repeats words on (16 of 24); texts
  in which no stretch of that length occurs twice (a rolling hash decides; a clash
  only costs time) have none.
* A pair counts only at a distance d <= l / (repeats - 1). With at least three repeats, the
  positions of a node within that distance of p are an arithmetic progression whose step is the
  stretch's period, and all but its first have the same word to the left. So of all
  lists only those of the first and the last position in reach can hold partners; every
  partner found is a run (or a multiple of its period), and their number is linear in the text.
* Children are put into the largest one, in sorted lists.

Texts are independent: no shuffle, each text whole in one task, memory by its own words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.pretokens import unused
from carelake.llm.wordarrays import ids, owners, slices, words
from carelake.session import ship_package

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def texts_with_repeats(word: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Per text: does a stretch of ``length`` words occur twice (or seem to)."""
    n, found = len(word), np.zeros(len(offsets) - 1, bool)
    if n < length:
        return found
    owner = owners(offsets)
    h, have, todo = _mix(word + 1), 1, length
    stretch = np.zeros(n, np.uint64)  # hash of the words done so far, right to left by powers of two
    done = 0
    while todo:
        if todo & 1:
            part = h[done:]
            stretch = stretch[:len(part)] * np.uint64(0xD6E8FEB86659FD93) + part
            done += have
        todo >>= 1
        if todo:
            h = _mix(h[:-have]) + h[have:]
            have *= 2
    at = np.flatnonzero(owner[:n - length + 1] == owner[length - 1:])
    key = _mix(stretch[at] ^ _mix(owner[at] + 1))
    by = np.argsort(key, kind="stable")
    same = key[by][1:] == key[by][:-1]
    found[owner[at[by[1:][same]]]] = True
    return found


def suffix_array(word: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 1, 2, 4, ... words) of stretches that end at
    ``end[i]`` for position i. Prefix doubling; a position whose rank is its own drops out."""
    n = len(word)
    by = np.argsort(word, kind="stable")
    rank = np.empty(n, np.int64)
    rank[by] = np.maximum.accumulate(np.where(np.concatenate(([True], word[by][1:] != word[by][:-1])), np.arange(n), 0))
    levels, k = [rank.astype(np.int32)], 1
    place = by
    while True:
        # Places whose group still has more than one position.
        head = rank[place] == np.arange(n)
        alone = head & np.concatenate((head[1:], [True]))
        live = np.flatnonzero(~alone)
        if not len(live):
            return place, levels
        pos = place[live]
        nxt = pos + k
        second = np.where(nxt < end[pos], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[pos] * np.int64(n + 1) + second
        order = np.argsort(key, kind="stable")
        place = place.copy()
        place[live] = pos = pos[order]
        key = key[order]
        rank = rank.copy()
        rank[pos] = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1])), live, 0))
        levels.append(rank.astype(np.int32))
        k *= 2


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` have in common."""
    n, out = len(levels[0]), np.zeros(len(a), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        fits = (x + (1 << j) <= end[a]) & (y + (1 << j) <= end[b])
        same = fits & (levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)])
        out += same.astype(np.int64) << j
    return out


class _Node:
    """Positions of an LCP interval: all of them, and by the word to their left."""
    __slots__ = ("all", "by_left")

    def __init__(self, position: int, left: int):
        self.all, self.by_left = [position], {left: [position]}


def maximal_pairs(sa: list[int], lcp: list[int], left: list[int], shortest: int, repeats: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, distance) of the spans of maximal pairs that meet the length constraints.

    ``lcp[i]`` belongs to ``sa[i - 1]`` and ``sa[i]``; intervals of value below the
    least that can matter are given as 0. A position stands for its own leaf until it meets another.
    """
    def join(a, b, size):
        """Put two children of an interval together; yields the pairs between them."""
        if type(a) is int:
            a = _Node(a, left[a])
        if type(b) is int:
            b = _Node(b, left[b])
        if len(a.all) < len(b.all):
            a, b = b, a
        reach, big, lists = size // (repeats - 1), a.all, a.by_left
        for p in b.all:
            lo, hi = bisect_left(big, p - reach), bisect_right(big, p + reach)
            if lo < hi:
                own = left[p]
                for other in {left[big[lo]], left[big[hi - 1]]}:
                    if other != own:
                        at = lists[other]
                        for q in at[bisect_left(at, p - reach):bisect_right(at, p + reach)]:
                            d = p - q if p > q else q - p
                            if size + d >= shortest:
                                found.append((min(p, q), max(p, q) + size, d))
        for p in b.all:
            insort(big, p)
        for c, at in b.by_left.items():
            mine = lists.get(c)
            if mine is None:
                lists[c] = at
            else:
                for p in at:
                    insort(mine, p)
        return a

    found: list[tuple[int, int, int]] = []
    open_: list[list] = []  # intervals not closed yet: [value, node]
    for i in range(len(sa)):
        value = lcp[i] if i else 0
        node = sa[i - 1] if i else None  # the leaf before joins the innermost interval it shares
        while open_ and open_[-1][0] > value:
            size, last = open_.pop()
            node = join(last, node, size)
        if value:
            if open_ and open_[-1][0] == value:
                open_[-1][1] = join(open_[-1][1], node, value)
            else:
                open_.append([value, node])
        elif found:
            yield from found
            found.clear()
    node = sa[-1] if sa else None
    while open_:
        size, last = open_.pop()
        node = join(last, node, size)
    yield from found


def runs_of(word: np.ndarray, offsets: np.ndarray, shortest: int = 24, repeats: int = 3) -> dict[int, list[tuple[int, int, int]]]:
    """text -> its runs (start, length, period), ordered; texts without runs are left out.

    ``word``: an integer per word, ``offsets``: the texts' bounds in it.
    """
    if repeats < 3:
        raise ValueError("repeats must be 3 at least")
    least = shortest - shortest // repeats
    hold = np.flatnonzero(texts_with_repeats(word, offsets, least))
    if not len(hold):
        return {}
    size = (offsets[hold + 1] - offsets[hold]).astype(np.int64)
    at = np.cumsum(size) - size
    source = np.repeat(offsets[hold] - at, size) + np.arange(int(size.sum()))
    end, text = np.repeat(at + size, size), np.repeat(np.arange(len(hold)), size)
    w = word[source].astype(np.int64)
    # Words of different texts differ, so that no interval spans two texts.
    _, w = np.unique(text * (int(w.max()) + 1) + w, return_inverse=True)
    sa, levels = suffix_array(w, end)
    lcp = np.zeros(len(sa), np.int64)
    lcp[1:] = common(levels, sa[:-1], sa[1:], end)
    lcp[lcp < least] = 0
    near = (lcp > 0) | np.concatenate((lcp[1:] > 0, [False]))  # leaves of no interval are left out
    left = np.where(np.arange(len(w)) == at[text], -1, np.concatenate(([-1], w[:-1])))
    spans: dict[tuple[int, int], int] = {}
    for a, b, d in maximal_pairs(sa[near].tolist(), lcp[near].tolist(), left.tolist(), shortest, repeats):
        if d < spans.get((a, b), 1 << 60):
            spans[a, b] = d
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (a, b), d in spans.items():
        k = int(text[a])
        out.setdefault(int(hold[k]), []).append((a - int(at[k]), b - a, d))
    for found in out.values():
        found.sort(key=lambda r: (r[0], r[2]))
    return out


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shortest: int = 24, repeats: int = 3,
                  collapse: bool = True) -> DataFrame:
    """``keep`` columns (default: all but the text) plus ``n_words``, ``runs`` (array of
    start, length, period; words numbered from 0; ordered by start, then period) and, with
    ``collapse``, ``collapsed``: the words outside the repeats, joined by one
    space (a word goes if any run contains it behind that run's first period).

    A null or empty text has no words, no runs and an empty collapsed text. Texts of any
    length are handled whole. Repeated rows give repeated results, an empty table none; a
    kept column whose name is one of the new ones is replaced. No shuffle.
    """
    new = ["n_words", "runs"] + ["collapsed"] * collapse
    keep = [c for c in (docs.columns if keep is None else keep) if c != text and c not in new]
    ship_package(docs.sparkSession)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + ["n_words bigint", f"runs {RUNS}"] + ["collapsed string"] * collapse)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            column = batch.column(len(keep))
            for i, j in slices(column):
                offsets, flat = words(column.slice(i, j - i))
                found = runs_of(ids(flat)[0], offsets, shortest, repeats)
                cols = [batch.column(k).slice(i, j - i) for k in range(len(keep))]
                cols += [pa.array(np.diff(offsets)), _run_lists(found, j - i, kind)]
                if collapse:
                    stay = np.ones(len(flat) + 1, np.int64)
                    for k, rows in found.items():
                        for start, length, period in rows:
                            stay[offsets[k] + start + period:offsets[k] + start + length] = 0
                    upto = np.concatenate(([0], np.cumsum(stay[:-1])))
                    left = flat.filter(pa.array(stay[:-1].astype(bool))) if found else flat
                    lists = pa.ListArray.from_arrays(pa.array(upto[offsets], pa.int32()), left)
                    cols.append(pc.binary_join(lists, " "))
                yield pa.RecordBatch.from_arrays(cols, names=keep + new)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(unused(docs))).mapInArrow(run, schema)


def _run_lists(found: dict, n: int, kind: pa.DataType) -> pa.Array:
    size = np.zeros(n, np.int64)
    for k, rows in found.items():
        size[k] = len(rows)
    flat = np.array([r for k in sorted(found) for r in found[k]], np.int64).reshape(-1, 3)
    rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), rows).cast(kind)


# --- the contract's digests ---------------------------------------------------------------

def with_repeated_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The text of rows whose key's crc32 h is divisible by 10 with its words from
    a = g % n on replaced by word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8), where
    g = h div 10 and n is the number of words; other rows (also null keys or texts) as they are."""
    h, g, w = (unused(docs) + x for x in "hgw")
    marked = docs.withColumn(h, F.crc32(F.col(key).cast("string").cast("binary")))
    changed = F.expr(f"""
        case when `{h}` % 10 = 0 and `{text}` is not null then
          transform(array(regexp_extract_all(`{text}`, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)), w ->
            case when size(w) = 0 then `{text}` else
              transform(array(struct((`{h}` div 10) % size(w) as a, `{h}` div 10 as g)), x ->
                transform(array(1 + (size(w) - x.a) div (3 + x.g % 8)), p ->
                  array_join(concat(slice(w, 1, cast(x.a as int)),
                    slice(flatten(array_repeat(slice(w, cast(x.a + 1 as int), cast(p as int)), cast(1 + (size(w) - x.a) div p as int))),
                          1, cast(size(w) - x.a as int))), ' '))[0])[0] end)[0]
        else `{text}` end""")
    return marked.withColumn(w, changed).drop(h, text).withColumnRenamed(w, text)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of ``periodic_runs``: number of runs, the run of greatest length / period, and digests."""
    best = F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period > y.length * x.period then -1 when x.length * y.period < y.length * x.period then 1
        when x.start < y.start then -1 when x.start > y.start then 1
        when x.period < y.period then -1 when x.period > y.period then 1 else 0 end)""")
    top = found.withColumn("best", F.get(best, F.lit(0)))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return top.select(key, F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

"""Periodic runs against a direct search over all periods."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carelake.llm import periodic
from carelake.llm.queries import QUERIES
from tests.conftest import SF0001
from tests.llm.helpers import ODD_TEXTS, WORD


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[i] == w[i + q] for i in range(len(w) - q)))


def brute(w, shortest=24, repeats=3):
    n, found = len(w), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(shortest, repeats * q) and smallest_period(w[i:j + q]) == q:
                found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, WORD.findall(text or ""))
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def runs(lists, **more):
    flat = np.array([x for w in lists for x in w], np.int64)
    return periodic.runs_of(flat, np.concatenate(([0], np.cumsum([len(w) for w in lists]))).astype(np.int64), **more)


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.sampled_from([(24, 3), (6, 3), (9, 4), (1, 3), (25, 3)]))
def test_random_words(lists, law):
    got = runs(lists, shortest=law[0], repeats=law[1])
    assert {k: brute(w, *law) for k, w in enumerate(lists) if brute(w, *law)} == got


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), min_size=1, max_size=6))
def test_repeated_blocks(blocks):
    w = [x for block, times in blocks for x in block * times]
    assert runs([w, w]).get(0, []) == brute(w) == runs([[9], w]).get(1, [])


def test_fibonacci_and_nested_repeats():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    inner = ([1] * 30 + [2]) * 5
    for w in (b, inner * 3, [0] * 24, [0] * 23, [0] * 200 + [1] + [0] * 200):
        assert runs([w]).get(0, []) == brute(w)


def test_long_texts_take_linear_time():
    n = 200_000
    for w in (np.zeros(n, int), np.arange(n) % 7, np.arange(n) % (n // 4),
              np.array([x for k in range(n // 18) for x in [100 + k, *range(17)]]),  # one passage behind ever new words
              np.array([x for k in range(n // 101) for x in [1000 + k] + [3] * 100])):
        t = time.time()
        got = runs([w])
        assert time.time() - t < 60
        if w.max() in (0, 6, n // 4 - 1):
            assert got == {0: [(0, n, w.max() + 1)]}
    assert len(got[0]) == n // 101


def test_two_repeats_are_refused():
    with pytest.raises(ValueError):
        runs([[1, 1]], repeats=2)


def test_odd_rows_through_spark(spark):
    random.seed(5)
    texts = ODD_TEXTS + [" ".join(random.choice("ab") for _ in range(random.randint(0, 90))) for _ in range(120)]
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(None, "a " * 40, 1, "y"), (None, None, None, None)]
    rows += rows[30:33]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, runs string").repartition(5)
    found = periodic.periodic_runs(docs)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    for r in found.collect():
        if r["doc_id"] is not None:
            w = WORD.findall(texts[r["doc_id"]] or "")
            assert r["n_words"] == len(w) and [tuple(x) for x in r["runs"]] == brute_fast(w)
    got = periodic.digests(periodic.periodic_runs(periodic.with_repeated_tails(docs))).collect()
    small = [tuple(r) for r in got if r["doc_id"] is None or len(texts[r["doc_id"]] or "") < 3000]
    want = [(i, *expected(i, t)) for i, t, *_ in rows if len(t or "") < 3000]
    assert sorted(small, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def brute_fast(w):
    """Texts of one word repeated need no search."""
    return [(0, len(w), 1)] if len(w) > 1000 and len(set(w)) == 1 else brute(w)


def test_registered_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    want = {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in docs if len(r["text"] or "") < 8000}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF0001).collect()}
    assert len(got) == len(docs) and {k: got[k] for k in want} == want
    assert any(v[0] for v in want.values())

"""Importance resampling against a plain-Python version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa
from pyspark.sql import functions as F

from carelake.llm import importance
from carelake.llm.queries import QUERIES
from carelake.operators.places import with_place
from tests.conftest import SF0001
from tests.llm.helpers import ODD_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def feature_list(text, grams=1):
    w = WORD.findall(small(text))
    return [" ".join(w[i:i + k]) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, grams=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """docs: (id, text) -> rows (id, n_features, weight, score, rank)."""
    code = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (Counter(code(x) for text in texts for x in feature_list(text, grams)) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        found = feature_list(text, grams)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in map(code, found))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(WORD.findall(small(text)))])
    fit = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aZz09é \n-_[\x7f日", max_size=25), max_size=6), st.integers(1, 3))
def test_features(texts, grams):
    n, owner, code = importance.features(pa.array(texts, pa.string()), grams, 97)
    assert n.tolist() == [len(WORD.findall(small(t))) for t in texts]
    got = [[] for _ in texts]
    for k, c in zip(owner.tolist(), code.tolist()):
        got[k].append(c)
    assert [sorted(x) for x in got] == [sorted(zlib.crc32(f.encode()) % 97 for f in feature_list(t, grams)) for t in texts]


@pytest.mark.parametrize("grams,percent,min_words", [(1, 10, 20), (2, 35, 0), (1, 100, 1), (1, 0, 1)])
def test_odd_rows_against_brute_force(spark, grams, percent, min_words):
    texts = ODD_TEXTS + [f"w{k % 7} " * (15 + k % 11) + "Idiot x" for k in range(60)]
    rows = [(i, t, 5, 1, "x", 0) for i, t in enumerate(texts)] + [(3, texts[3], 5, 1, "x", 0)] * 3 + [(40, texts[40], 5, 1, "x", 0)]
    rows += [(None, "a b " * 30, 5, 1, "x", 0), (None, None, 5, 1, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words int, rank int, score string, row int").repartition(6)
    target = spark.createDataFrame([(1, "w1 w3 w3 idiot"), (2, None), (3, "")], "item_id bigint, text string")
    got = importance.resample(docs, target, grams=grams, percent=percent, min_words=min_words, buckets=500)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute([(r[0], r[1]) for r in rows], ["w1 w3 w3 idiot"], grams, 500, percent, min_words)
    order = lambda r: (str(r[0]), r[2], r[3], r[4] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string")
    target = docs.limit(0)
    assert importance.resample(docs.limit(0), docs).count() == 0
    assert importance.resample(docs, target, percent=100, min_words=1).collect()[0]["rank"] == 1


def test_quickselect_finds_every_place(spark):
    rows = spark.range(1000).select(F.expr("id % 7 as a"), F.when(F.expr("id % 3 = 0"), F.lit(None)).otherwise(F.col("id")).alias("b"), F.col("id").alias("row"))
    key = F.struct("a", "b", "row")
    order = sorted(((r["a"], -1 if r["b"] is None else r["b"], r["row"]) for r in rows.collect()))
    for k in (1, 2, 499, 1000):
        a, b, row = importance.kth_key(rows, key, k, pivots=3)
        assert (a, -1 if b is None else b, row) == order[k - 1]
    with pytest.raises(ValueError):
        importance.kth_key(rows, key, 1001)


def test_a_hot_score_does_not_crowd_one_task(spark):
    """Rows equal in id, text and score are cut by their row number."""
    docs = spark.createDataFrame([(None, "same words " * 12)] * 300 + [(k, f"other {k} " * 12) for k in range(100)], "doc_id bigint, text string")
    got = importance.resample(docs, docs.limit(3), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 201))
    plan = with_place(spark.range(10), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("LogicalRDD")[0]


def test_registered_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance"](spark, SF0001).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(brute(docs, target), key=lambda r: r[0])

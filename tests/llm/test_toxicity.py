"""The toxicity model: FTRL against a plain loop, held-out quality, odd rows."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carelake.llm import toxicity
from carelake.llm.queries import QUERIES
from tests.llm.helpers import ODD_TEXTS

SF = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_ftrl_against_a_loop_over_coordinates():
    rng = np.random.default_rng(2)
    examples = [(np.unique(rng.integers(0, 40, 6)), int(rng.random() < 0.3)) for _ in range(300)]
    a, b, l1, l2 = 0.5, 1.0, 0.7, 0.1
    fast = toxicity.Ftrl(40, a, b, l1, l2)
    z, n, z0, n0 = [0.0] * 40, [0.0] * 40, 0.0, 0.0
    for at, y in examples:
        w = {i: 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2) for i in at}
        w0 = -z0 / ((b + math.sqrt(n0)) / a)
        p = 1 / (1 + math.exp(-sum(w.values()) - w0))
        assert fast.learn(at, y) == pytest.approx(p, abs=1e-9)
        g = p - y
        for i in at:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * w[i]
            n[i] += g * g
        z0 += g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / a * w0
        n0 += g * g
    assert np.allclose(fast.z, z) and np.allclose(fast.n, n) and (fast.weights(slice(None)) == 0).any()


def test_features_are_words_starts_pairs_and_skips():
    texts = ["An Élan vital, an ÉLAN again", None, "", "x", "abcdefg abcde"]
    got = [set() for _ in texts]
    for owner, at in toxicity.features(pa.array(texts), 40):
        for k, c in zip(owner.tolist(), at.tolist()):
            got[k].add(c)
    for t, g in zip(texts, got):
        w = WORD.findall((t or "").lower())
        want = set(w) | {("start", x[:5]) for x in w if len(x) > 5} | {(d, *p) for d in (1, 2, 3) for p in zip(w, w[d:])}
        assert len(g) == len(want)
    assert got[4] != got[3] and len(got[4]) == 4


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit_on_rest(*tables)


def test_held_out_quality(tables, model):
    docs, labels = tables
    got = toxicity.score(docs, model, keep=["doc_id"]).where(toxicity.held_out()).join(labels, "doc_id").toPandas()
    toxic, clean = got[got.toxic == 1].score, got[got.toxic == 0].score
    assert len(toxic) > 80 and (toxic >= 0.5).mean() > 0.87 and (clean >= 0.5).mean() < 0.01
    rank = got.score.rank()
    area = (rank[got.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert area > 0.97
    assert len(model.at) < 5000  # sparse


def test_model_does_not_depend_on_partitions(tables, model):
    docs, labels = tables
    other = toxicity.fit_on_rest(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(other.at, model.at) and np.array_equal(other.weight, model.weight) and other.intercept == model.intercept


def test_a_bound_that_cuts_one_label_only_does_not_tip_the_scale(tables):
    """Fewer clean texts than there are, all toxic ones: the order must not put the rest of these at the end."""
    docs, labels = tables
    small = toxicity.fit_on_rest(docs, labels, per_label=400)
    got = toxicity.score(docs, small, keep=["doc_id"]).where(toxicity.held_out()).join(labels, "doc_id").toPandas()
    assert (got[got.toxic == 0].score >= 0.5).mean() < 0.02 and (got[got.toxic == 1].score >= 0.5).mean() > 0.8


def test_held_out_rows_do_not_train(tables, model):
    docs, labels = tables
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    changed = docs.withColumn("text", F.when(toxicity.held_out(), F.lit("idiot idiot")).otherwise(F.col("text")))
    other = toxicity.fit_on_rest(changed, flipped)
    assert np.array_equal(other.at, model.at) and np.array_equal(other.weight, model.weight)


def test_odd_rows(spark, model):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD_TEXTS)] + [(3, ODD_TEXTS[3], "x", 1), (None, "idiot moron loser trash", "y", 2),
                                                               (90, "word " * 200_000 + " idiot you stupid loser scum", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string, predicted int").repartition(4)
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "predicted", "score"]
    got = {(r["doc_id"]): r["score"] for r in got.collect()}
    base = 1 / (1 + math.exp(-model.intercept))
    assert got[0] == got[1] == pytest.approx(base) and base < 0.5
    assert got[None] > 0.9 and got[90] > 0.5 and all(0 <= x <= 1 for x in got.values())
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_labels_that_say_little(spark):
    docs = spark.createDataFrame([(1, "idiot here"), (1, "other text"), (2, "fine words"), (3, None), (None, "idiot")], "doc_id bigint, text string")
    labels = "doc_id bigint, toxic int"
    for rows in ([], [(None, 1), (1, None)], [(3, 1)], [(77, 1)]):
        m = toxicity.fit(docs, spark.createDataFrame(rows, labels))
        assert {r["score"] for r in toxicity.score(docs, m).collect()} == {0.0}
    both = toxicity.fit(docs, spark.createDataFrame([(1, 0), (1, 1), (2, 0)], labels))  # an id said to be toxic once is toxic
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, both).where("doc_id IS NOT NULL").collect()}
    assert 0 < got[2] < 1 and np.isfinite(both.intercept)
    assert toxicity.fit(docs.limit(0), spark.createDataFrame([(1, 1)], labels)).intercept == -np.inf


def test_registered_query(spark):
    got = QUERIES["op11_toxicity"](spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and list(got.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()

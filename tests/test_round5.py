"""The forest search on all training rows, counted per cell of the features' bins."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import functions as F

from carelake.operators import forest, treatment
from carelake.plans import catalog


def _lines(spark, path, n=9000):
    x = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"), (F.col("id") * 31 % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") * 7919 % 104729).cast("double").alias("l_extendedprice"), (F.col("id") % 11 / 100).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"), F.when(F.col("id") % 2 == 0, "O").otherwise("F").alias("l_linestatus"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"))
    x.write.parquet(f"{path}/lineitem.parquet")
    return path


def _rows_of_fit(model):
    return {int(sum(t._java_obj.rootNode().impurityStats().stats())) for t in model.bestModel.trees}


def test_queries_fit_on_every_training_row(spark, scratch, monkeypatch):
    """The roots of trees without bags hold all training rows: 9,000 lines are beyond the 4,000 rows of the sample there was."""
    monkeypatch.setattr(treatment, "GRID_BOOTSTRAP", [False])
    monkeypatch.setattr(treatment, "GRID_MAX_DEPTH", [2, 4])
    monkeypatch.setattr(treatment, "GRID_NUM_TREES", [2, 3])
    path = _lines(spark, scratch("lines"))
    catalog.reset_model_cache()
    try:
        train = catalog._split(spark, path).where("split = 'train'").count()
        assert train > 7000 and _rows_of_fit(catalog._fitted(spark, path)) == {train}
        got = catalog.q_rf_metrics(spark, path).collect()
        assert sum(r["positives"] + r["negatives"] for r in got) == 9000 and all(r["above_chance"] and r["is_area"] and r["adds_up"] for r in got)
        assert catalog.q_rf_predictions(spark, path).where("is_class AND is_probability AND agrees").count() == 9000
    finally:
        catalog.reset_model_cache()


def _table(spark, n=600, values=9):
    random.seed(3)
    rows = [(i, float(random.randint(0, values)), float(random.randint(0, values)), random.randint(0, 1)) for i in range(n)]
    rows = [(i, a, b, s, int(a + b * s > values * 0.8) ^ int(random.random() < 0.15)) for i, a, b, s in rows]
    return treatment.scale_features(spark.createDataFrame(rows, "id long, a double, b double, s int, y int"), ["a", "b"], ["s"])


def test_a_tree_is_the_one_of_mllib(spark):
    """Without bags and with all features looked at, nothing is drawn: tree and scores are MLlib's."""
    data = _table(spark)
    model = treatment.tune_forest(data, "y", grid_kwargs={"bootstrap": [False], "max_depth": [4], "num_trees": [1]}, key=["id"])
    plain = RandomForestClassifier(labelCol="y", featuresCol="all_features", numTrees=1, maxDepth=4, bootstrap=False, seed=1, maxBins=64).fit(data)
    assert model.bestModel.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
    p = [treatment.scoring_model(m).transform(data).select("id", "prediction", vector_to_array("probability")).sort("id").collect() for m in (model.bestModel, plain)]
    assert p[0] == p[1] and model.bestModel.getMaxDepth() == 4 and model.bestModel.getLabelCol() == "y"


def test_search_is_the_same_on_any_partitioning(spark):
    """Also with keys that are null or repeat; every set is scored, the best is refit."""
    data = _table(spark, 400).withColumn("id", F.when(F.col("id") % 5 > 0, F.floor(F.col("id") / 2)))
    got = []
    for parts in (2, 7):
        model = treatment.tune_forest(data.repartition(parts), "y", grid_kwargs={"max_depth": [2, 6], "num_trees": [3, 12]}, key=["id"])
        assert len(model.validationMetrics) == 8 and len(set(model.validationMetrics)) > 2
        best = int(np.argmax(model.validationMetrics))
        chosen = {k.name: v for k, v in model.getEstimatorParamMaps()[best].items()}
        assert model.bestModel.getNumTrees == chosen["numTrees"] and model.bestModel.getMaxDepth() == chosen["maxDepth"]
        got.append((model.validationMetrics, model.bestModel.toDebugString.split("\n")[1:]))
    assert got[0] == got[1]


def test_a_shared_tree_is_the_tree_of_its_own_depth():
    rng = np.random.default_rng(1)
    bins, count = rng.integers(0, 12, (5, 900)).astype(np.uint8), rng.integers(0, 4, (2, 900))
    deep = forest.grow(bins, count, 12, 12, 3, True, 100, 4)
    for depth in (0, 1, 3, 7, 12):
        own = forest.grow(bins, count, 12, depth, 3, True, 100, 4)
        a, b = forest.kept(deep, depth), forest.kept(own, depth)
        assert np.array_equal(a[1], b[1]) and np.array_equal(a[2], b[2])
        for part in ("feature", "split", "count"):
            inner = ~a[1] if part != "count" else slice(None)
            assert np.array_equal(getattr(deep, part)[a[0]][inner], getattr(own, part)[b[0]][inner])
        assert np.array_equal(*[next(forest.shares(t, bins, [depth])) for t in (deep, own)])
        leaf = {tuple(deep.count[n]) for n, is_leaf in zip(*a[:2]) if is_leaf}
        assert {round(x, 9) for x in next(forest.shares(deep, bins, [depth]))} == {round(n1 / (n0 + n1), 9) for n0, n1 in leaf} or depth == 12


def test_a_bag_draws_rows_not_cells():
    """A cell of a million rows keeps about a million in a bag; a small block of the histogram changes nothing."""
    bins, count = np.array([[0, 1, 2]], np.uint8), np.array([[10**6, 0, 5], [0, 10**6, 5]])
    tree = forest.grow(bins, count, 3, 2, 1, True, 7, 0)
    assert all(abs(n - 10**6) < 6000 for n in tree.count[0])


def test_blocks_of_nodes(monkeypatch):
    rng = np.random.default_rng(2)
    bins, count = rng.integers(0, 9, (4, 500)).astype(np.uint8), rng.integers(0, 3, (2, 500))
    whole = forest.grow(bins, count, 9, 8, 2, True, 1, 0)
    monkeypatch.setattr(forest, "HISTOGRAM", 20)
    for a, b in zip(whole, forest.grow(bins, count, 9, 8, 2, True, 1, 0)):
        assert np.array_equal(a, b)


def test_cuts_come_from_all_rows(spark):
    """Quantiles of 20,000 values, all neighbours of few, one cut beside a value that nearly all rows have, none of a constant."""
    data = spark.range(20_000).repartition(5).select(F.array(
        F.col("id").cast("double"), (F.col("id") % 3).cast("double"), F.greatest(F.col("id") - 19_900, F.lit(0)).cast("double"), F.lit(4.0)).alias("all_values"))
    even, few, hot, none = treatment.exact_cuts(data, "all_values", 8)
    assert even == [2500 * k - 0.5 for k in range(1, 8)] and few == [0.5, 1.5] and hot == [0.5] and none == []
    odd = spark.createDataFrame([([1.0, float("nan")],), ([2.0, 3.0],)], "all_values array<double>")
    assert treatment.exact_cuts(odd, "all_values", 8) is None and treatment.exact_cuts(data.limit(0), "all_values", 8) is None


@pytest.mark.parametrize("why", ["cells", "labels"])
def test_without_counts_the_search_is_mllibs_on_all_rows(spark, monkeypatch, why):
    seen, plain = [], TrainValidationSplit.fit
    monkeypatch.setattr(TrainValidationSplit, "fit", lambda self, df, *a: seen.append(df.count()) or plain(self, df, *a))
    data = _table(spark, 300)
    if why == "cells":
        monkeypatch.setattr(treatment, "FIT_CELLS", 3)
    else:
        data = data.withColumn("y", F.when(F.col("id") < 60, 2).otherwise(F.col("y")))
    if why == "labels":
        assert treatment._tune_on_cells(TrainValidationSplit(estimator=treatment.forest("y"), estimatorParamMaps=treatment.param_grid(treatment.forest("y")),
                                                             evaluator=treatment.evaluator("y"), trainRatio=0.8, seed=1), data, ["id"]) is None
    else:
        model = treatment.tune_forest(data, "y", grid_kwargs={"bootstrap": [False], "max_depth": [2], "num_trees": [3]}, key=["id"])
        assert seen == [300] and _rows_of_fit(model) == {300}

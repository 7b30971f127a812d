import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from carelake.functions.columns import lenient_cast
from carelake.operators import treatment

LAB = ("HAEMATOCRIT double, HAEMOGLOBINS double, ERYTHROCYTE double, LEUCOCYTE double, "
       "THROMBOCYTE int, AGE int, SEX string, SOURCE string")
FEATURES = ["HAEMATOCRIT", "HAEMOGLOBINS", "ERYTHROCYTE", "LEUCOCYTE", "THROMBOCYTE", "AGE"]


def _lab(spark, with_null=False):
    rows = [(35.1, 11.8, 4.65, 6.3, 310, 1, "F", "out"), (43.5, 14.8, 5.39, 12.7, 334, 1, "M", "in"),
            (33.5, 11.3, 4.74, 13.2, 305, 1, None, None), (39.1, 13.7, 4.98, 10.5, 366, 1, "M", "7"),
            (30.9, 9.9, 4.23, 22.1, 333, 1, "F", "in"), (34.3, 11.6, 4.53, 6.6, 185, 1, "M", "out")]
    if with_null:
        rows.append((None, 12.0, 4.0, 7.0, 200, 1, "F", "out"))
    return spark.createDataFrame(rows, LAB)


def test_lenient_cast_does_not_raise(spark):
    df = _lab(spark).withColumns({"TREATMENT": lenient_cast("SOURCE"), "SEX_": lenient_cast("SEX")})
    vals = [(r.SOURCE, r.TREATMENT, r.SEX_) for r in df.collect()]
    assert ("7", 7, 1) in [(s, t, 1) for s, t, _ in vals if s == "7"]
    assert all(t is None for s, t, _ in vals if s != "7")
    assert spark.range(1).select(lenient_cast(F.lit("in")).alias("x")).first().x is None


def test_encode_flags_null_is_zero_and_replaces_sources(spark):
    df = treatment.encode_flags(_lab(spark), {"TREATMENT": ("SOURCE", "in"), "SEX": ("SEX", "M")})
    assert "SOURCE" not in df.columns and "SEX" in df.columns
    got = [(r.TREATMENT, r.SEX) for r in df.collect()]
    assert got == [(0, 0), (1, 1), (0, 0), (0, 1), (1, 0), (0, 1)]


def test_scaled_features_range_and_constant(spark):
    df = treatment.encode_flags(_lab(spark), {"TREATMENT": ("SOURCE", "in"), "SEX": ("SEX", "M")})
    out = treatment.scale_features(df, FEATURES, ["SEX"])
    arrs = [r.a for r in out.select(vector_to_array("scaled_features").alias("a")).collect()]
    for a in arrs:
        assert all(0.0 <= x <= 1.0 for x in a)
        assert a[5] == 0.5  # AGE is constant
    allf = out.select(vector_to_array("all_features").alias("a")).first().a
    assert len(allf) == 7


def test_null_feature_raises_unless_skipped(spark):
    df = _lab(spark, with_null=True)
    with pytest.raises(Exception):
        treatment.scale_features(df, FEATURES).count()
    assert treatment.scale_features(df, FEATURES, handle_invalid="skip").count() == 6


def test_hash_split_is_stable(spark):
    df = spark.range(1000)
    a = {r.id: r.split for r in treatment.hash_split(df.repartition(3), ["id"]).collect()}
    b = {r.id: r.split for r in treatment.hash_split(df.repartition(7), ["id"]).collect()}
    assert a == b
    assert 700 < sum(v == "train" for v in a.values()) < 900


def test_forest_search_tables(spark):
    rows = [(float(i % 10), float((i * 7) % 13), int(i % 10 > 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, y int")
    data = treatment.scale_features(df, ["x1", "x2"])
    data = treatment.hash_split(data, ["x1", "x2"], ratio=0.6)
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    model = treatment.tune_forest(train, "y", grid_kwargs={"bootstrap": [True], "max_depth": [2, 3],
                                                           "num_trees": [5]})
    grid = treatment.grid_table(spark, model).collect()
    assert len(grid) == 2 and sum(r.is_best for r in grid) == 1
    assert {r.metric for r in grid} == {"areaUnderROC"}
    m = {r.split: r for r in treatment.metrics_table(model, data, "y").collect()}
    assert m["train"].auc > 0.9 and m["train"].error == pytest.approx(1 - m["train"].auc)
    ev = BinaryClassificationEvaluator(labelCol="y", metricName="areaUnderROC", numBins=0)
    for name, part in (("train", train), ("test", test)):  # the exact area is MLlib's without bins
        assert m[name].auc == pytest.approx(ev.evaluate(treatment.scoring_model(model).transform(part)), abs=1e-12)
    pred = treatment.predictions_table(model, test, ["x1", "x2"], "y")
    assert pred.columns == ["x1", "x2", "y", "prediction", "probability_1"]
    assert pred.count() == test.count()


def test_default_grid_is_the_full_search(spark):
    rf = treatment.forest("y")
    assert len(treatment.param_grid(rf)) == 24


def test_fit_is_the_same_on_any_partitioning(spark):
    df = spark.range(3000).selectExpr("id", "CAST(id % 17 AS double) AS x1", "CAST(id * 7 % 13 AS double) AS x2", "CAST(id % 17 > 8 AS int) AS y")
    got = []
    for parts in (4, 16):
        data = treatment.hash_split(treatment.scale_features(df.repartition(parts), ["x1", "x2"]), ["id"])
        train = treatment.fit_sample(data.where("split = 'train'"), ["id"], rows=1000)
        model = treatment.tune_forest(train, "y", grid_kwargs={"bootstrap": [True], "max_depth": [3], "num_trees": [5]})
        pred = treatment.predictions_table(model, data, ["id", "split"], "y").select("id", "split", "y", "prediction", "probability_1")
        got.append((sorted(train.select("id").collect()), sorted(map(tuple, pred.collect()))))
    assert got[0] == got[1] and len(got[0][1]) == 3000 and 800 < len(got[0][0]) < 1200


def test_scaled_columns_equal_the_scaler(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5), (2.5, 5)], "a double, b int")
    got = treatment.scale_columns(df, ["a", "b"]).select("scaled_a", "scaled_b").collect()
    want = [tuple(r.v) for r in treatment.scale_features(df, ["a", "b"]).select(vector_to_array("scaled_features").alias("v")).collect()]
    assert [tuple(r) for r in got] == want

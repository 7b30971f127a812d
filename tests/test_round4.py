"""Scoring by the cells of a forest's grid, and the settlement of matches, at the size of the data."""

import math
import random

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from carelake.operators import notes, stats, treatment


def _forest(spark, trees=7, depth=4):
    random.seed(11)
    rows = [(i, random.random() * 40 - 20, float(random.randint(0, 9)), random.randint(0, 1)) for i in range(400)]
    rows = [(i, a, b, s, int(a + 3 * b > 9) ^ int(random.random() < 0.1)) for i, a, b, s in rows]
    data = treatment.scale_features(spark.createDataFrame(rows, "id long, a double, b double, sex int, y int"), ["a", "b"], ["sex"])
    model = treatment.tune_forest(data, "y", grid_kwargs={"bootstrap": [True], "max_depth": [depth], "num_trees": [trees], "max_bins": 8})
    return model, data


def _row_by_row(model, df, key):
    p = treatment.scoring_model(model).transform(df)
    return sorted(tuple(r) for r in p.select(*key, "prediction", vector_to_array("probability")[1]).collect())


def test_rows_of_a_cell_are_scored_once(spark, monkeypatch):
    model, data = _forest(spark)
    many = data.crossJoin(spark.range(25).withColumnRenamed("id", "copy"))
    want = _row_by_row(model, many, ["id", "copy", "y"])
    seen, plain = [], RandomForestClassificationModel.transform
    monkeypatch.setattr(RandomForestClassificationModel, "transform", lambda self, df, *a: seen.append(df.count()) or plain(self, df, *a))
    got = treatment.predictions_table(model, many, ["id", "copy"], "y")
    assert sorted(tuple(r) for r in got.collect()) == want
    cells = math.prod(len(c) + 2 for c in treatment.cut_points(treatment.scoring_model(model)) if c)
    assert many.count() == 10_000 and len(seen) == 1 and seen[0] <= min(400, cells)
    seen.clear()
    metrics = treatment.metrics_table(model, many.withColumn("split", F.lit("all")), "y").first()
    assert len(seen) == 1 and seen[0] <= 400 and metrics["positives"] + metrics["negatives"] == 10_000


def test_cells_follow_the_splits_to_the_last_bit(spark):
    """Values on a threshold, next to it, beyond all of them, and NaN: the scores are the model's own."""
    model, _ = _forest(spark)
    cuts = treatment.cut_points(treatment.scoring_model(model))
    assert len(cuts) == 3 and cuts[0] and cuts[1]
    odd = [0.0, -0.0, -1e300, 1e300, math.inf, -math.inf, math.nan]
    a = [x for t in cuts[0] for x in (t, math.nextafter(t, -math.inf), math.nextafter(t, math.inf))] + odd
    b = [x for t in cuts[1] for x in (t, math.nextafter(t, math.inf))] + odd
    rows = [(i, [x, y, float(i % 2)], i % 2) for i, (x, y) in enumerate((x, y) for x in a for y in b)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y int").select("id", "y", array_to_vector("v").alias("all_features"))
    got = {r["id"]: (r["prediction"], r["probability_1"]) for r in treatment.predictions_table(model, df, ["id"], "y").collect()}
    p = treatment.scoring_model(model).transform(df).select("id", "prediction", vector_to_array("probability")[1].alias("p"))
    assert got == {r["id"]: (r["prediction"], r["p"]) for r in p.collect()} and len(got) == len(rows)


def test_array_and_vector_hold_the_same_numbers(spark):
    random.seed(5)
    rows = [(random.uniform(-1e6, 1e6), random.randint(-50, 50), 7.0, i % 2) for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b int, c double, s int")
    out = treatment.scale_features(df, ["a", "b", "c"], ["s"]).select("all_values", vector_to_array("all_features").alias("v"))
    assert all(r["all_values"] == r["v"] for r in out.collect())
    missing = spark.createDataFrame([(1.0, 2), (2.0, None)], "a double, s int")
    with pytest.raises(Exception):
        treatment.scale_features(missing, ["a"], ["s"]).select("all_features").collect()


def test_a_forest_without_a_grid_scores_rows(spark, monkeypatch):
    model, data = _forest(spark)
    monkeypatch.setattr(treatment, "_MAX_CELLS", 1)
    got = treatment.predictions_table(model, data, ["id"], "y").collect()
    assert sorted(tuple(r) for r in got) == _row_by_row(model, data, ["id", "y"])
    auc = [treatment.metrics_table(model, data.withColumn("split", F.lit("x")), "y").first()]
    monkeypatch.undo()
    auc.append(treatment.metrics_table(model, data.withColumn("split", F.lit("x")), "y").first())
    assert auc[0] == auc[1]


def test_shares_by_hex_digits(spark):
    df = spark.range(2000)
    text = F.concat_ws("|", F.lit("9"), F.col("id").cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
    for share in (0.0, 0.123456789, 0.5, 0.8, 1.0):
        assert df.where(treatment._below(share, ["id"], 9) != (number < share)).count() == 0


def test_auc_of_rows_that_stand_for_many(spark):
    rows = [("a", 0.1, 0, 3), ("a", 0.4, 1, 2), ("a", 0.4, 0, 1), ("a", 0.9, 1, 5), ("b", 0.2, 1, 1), ("b", 0.1, 0, 4)]
    df = spark.createDataFrame(rows, "part string, s double, y int, n long")
    each = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = stats.auc_rank_sum(df, "s", "y", by="part", weight="n").collect()
    assert sorted(got) == sorted(stats.auc_rank_sum(each, "s", "y", by="part").collect())


def test_terms_with_one_first_word_do_not_multiply_the_tokens(spark, monkeypatch):
    """400 terms begin with the word that the note is full of: a token is joined once per length of terms and rules."""
    words = ["alpha"] * 600 + ["w7", "alpha", "12", "alpha"]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "Alpha W8 mg"), (3, None), (None, "w7 12 13")], "doc_id bigint, text string")
    lex = spark.createDataFrame([(f"alpha w{i}", "DRUG") for i in range(400)], "term string, entity string")
    joined, plain = [], notes.join_small
    monkeypatch.setattr(notes, "join_small", lambda *a, **k: joined.append(plain(*a, **k)) or joined[-1])
    got = {tuple(r) for r in notes.entity_spans(docs, lex, rules={"DURATION": "[0-9]+ [0-9]+", "STRENGTH": "[0-9]+"}).collect()}
    assert got == {(1, "alpha w7", "DRUG", 599, 601), (1, "12", "STRENGTH", 602, 603), (2, "alpha w8", "DRUG", 0, 2),
                   (None, "12 13", "DURATION", 1, 3)}
    assert len(joined) == 1 and joined[0].count() <= 2 * (len(words) + 3 + 3)


@pytest.mark.parametrize("bound", [2_000_000, 0])
def test_lexicon_rows_of_one_term(spark, bound):
    """A term with two labels takes the first, one without a label keeps none, a longer one wins; also in a shuffle join."""
    docs = spark.createDataFrame([(1, "one two three one 4"), (2, "five one two")], "doc_id bigint, text string")
    lex = spark.createDataFrame([("one", "ROUTE"), ("one", "DRUG"), ("one two three", "FORM"), ("five", None), (None, "DRUG"), ("--", "DRUG"),
                                 ("ONE  two", "DOSAGE")], "term string, entity string")
    got = {tuple(r) for r in notes.entity_spans(docs, lex, rules={"STRENGTH": "[0-9]+"}, max_broadcast_rows=bound).collect()}
    assert got == {(1, "one two three", "FORM", 0, 3), (1, "one", "DRUG", 3, 4), (1, "4", "STRENGTH", 4, 5), (2, "five", None, 0, 1),
                   (2, "one two", "DOSAGE", 1, 3)}

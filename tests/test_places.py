"""Global places, running sums and the exact area under ROC, against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.operators import notes, stats
from carelake.operators.places import with_place, with_running_sum

NOTES = "doc_id bigint, text string"


def test_places_over_many_partitions(spark):
    random.seed(3)
    rows = [(random.choice([None, 1, 2, 3]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, id bigint").repartition(5)
    got = {r["id"]: r["place"] for r in with_place(df, [F.desc_nulls_last("a"), "id"], partitions=7).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == {i: k + 1 for k, (_, i) in enumerate(want)}
    assert with_place(df.limit(0), ["id"]).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([(i * 7 % 100, i) for i in range(100)], "k int, v int")
    got = {r["k"]: int(r["s"]) for r in with_running_sum(df, ["k"], {"s": "v"}, partitions=6).collect()}
    order, total = sorted((i * 7 % 100, i) for i in range(100)), 0
    for k, v in order:
        total += v
        assert got[k] == total


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y > 0], [s for s, y in rows if y <= 0]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 6), st.integers(0, 1)), min_size=1, max_size=40))
def test_auc_against_all_pairs(spark, rows):
    df = spark.createDataFrame([(p, float(s), y) for p, s, y in rows] + [("a", None, 1), ("b", 2.0, None)], "part string, s double, y int")
    got = {r["part"]: r["auc"] for r in stats.auc_rank_sum(df, "s", "y", by="part").collect()}
    assert got.keys() == {p for p, _, _ in rows}
    for part in got:
        want = brute_auc([(s, y) for p, s, y in rows if p == part])
        assert (got[part] is None) == (want is None) and (want is None or got[part] == pytest.approx(want, abs=1e-12))
    whole = stats.auc_rank_sum(df, "s", "y").first()["auc"]
    assert whole is None or whole == pytest.approx(brute_auc([(s, y) for _, s, y in rows]), abs=1e-12)


def test_places_need_no_window_over_all_rows(spark, capfd):
    ents = spark.createDataFrame([(n, f"d{n % 50}", "DRUG", 0) for n in range(400)], "doc_id bigint, chunk string, entity string, first_start int")
    placed = with_place(notes.entity_doc_freq(ents), [F.desc("Frequency"), "first_note", "first_start"])
    assert [r["place"] for r in placed.orderBy("place").collect()] == list(range(1, 51))
    assert "No Partition Defined" not in capfd.readouterr().err


def test_a_long_note_of_numbers_is_settled_in_linear_time(spark):
    """Every two neighbours overlap: 100,000 numbers in one note, equal to the per-row model."""
    import time
    docs = spark.createDataFrame([(1, " ".join(str(i % 97) for i in range(100_000))), (1, "7 8 mg"), (None, "5 6 7")], NOTES)
    lex = spark.createDataFrame([("mg", "FORM"), ("13 14 15", "DRUG"), ("15 16", "ROUTE")], "term string, entity string")
    rules = {"DURATION": "[0-9]+ [0-9]+", "STRENGTH": "[0-9]+"}
    t = time.time()
    got = sorted((tuple(r) for r in notes.entity_spans(docs, lex, rules=rules).collect()), key=str)
    assert time.time() - t < 60
    want = sorted((tuple(r) for r in notes.extract_with_model(docs, notes.LexiconModel(lex, rules)).collect()), key=str)
    assert got == want and len(got) > 40_000

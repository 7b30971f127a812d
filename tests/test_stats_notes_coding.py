import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.functions.columns import exact_sum, month_of
from carelake.operators import coding, notes, stats
from carelake.operators.joins import join_small

DAILY = "date date, state string, hospitalized bigint, death bigint, positive bigint"


def _daily(spark):
    d = dt.date
    return spark.createDataFrame([
        (d(2020, 3, 1), "WA", 10, 1, 100), (d(2020, 3, 2), "WA", None, 2, 110),
        (d(2020, 4, 1), "WA", 5, 3, 120), (d(2020, 3, 1), "FL", None, 0, 50),
        (d(2020, 4, 1), "FL", None, 1, 60), (d(2020, 3, 1), "NY", 7, 7, 70),
        (d(2020, 3, 1), None, 1, 1, 1)], DAILY)


def test_sum_by_key_all_null_group_is_null(spark):
    out = {r.state: r.hospitalized for r in stats.grouped(
        _daily(spark), ["state"], {"hospitalized": F.sum("hospitalized")}).collect()}
    assert out == {"WA": 15, "FL": None, "NY": 7, None: 1}


def test_monthly_sums_and_in_list(spark):
    df = _daily(spark)
    m = stats.grouped(df, [month_of("date").alias("period")],
                      {"hospitalized": F.sum("hospitalized"), "deaths": F.sum("death")},
                      where=F.col("state") == "WA").orderBy("period").collect()
    assert [(r.period, r.hospitalized, r.deaths) for r in m] == [("2020-03", 10, 3), ("2020-04", 5, 3)]
    k = stats.grouped(df, [month_of("date").alias("period"), "state"], {"h": F.sum("hospitalized")},
                      where=F.col("hospitalized").isNotNull())
    assert {(r.period, r.state) for r in k.collect()} == {("2020-03", "WA"), ("2020-04", "WA"),
                                                          ("2020-03", "NY"), ("2020-03", None)}
    i = stats.grouped(df, ["state"], {"p": F.sum("positive")}, where=F.col("state").isin("WA", "FL", "WI", "AR"))
    assert {r.state: r.p for r in i.collect()} == {"WA": 330, "FL": 110}


def test_exact_sum_independent_of_partitioning(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    a = spark.createDataFrame(vals, "x double").repartition(1).agg(exact_sum("x").alias("s")).first().s
    b = spark.createDataFrame(vals, "x double").repartition(7).agg(exact_sum("x").alias("s")).first().s
    assert a == b == 600.0


def test_describe_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1), (2.0, 4.1, 5.0, 0), (3.0, 5.9, 5.0, 1), (4.0, 8.2, 5.0, 0)],
                               "a double, b double, c double, y int")
    d = {(r.column, r.stat): r.value for r in stats.describe_long(df, ["a", "c"]).collect()}
    assert d[("a", "count")] == 4 and d[("a", "mean")] == 2.5 and d[("a", "min")] == 1 and d[("a", "max")] == 4
    assert d[("a", "stddev")] == pytest.approx(1.290994, abs=1e-6)
    assert d[("c", "stddev")] == 0
    m = {(r.feature_a, r.feature_b): r.r for r in stats.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "a")] == 1 and m[("b", "b")] == 1
    assert m[("a", "b")] == m[("b", "a")]
    assert m[("c", "c")] is None and m[("a", "c")] is None  # constant column: NULL, no error
    with_text = df.withColumn("s", F.lit("text"))
    assert {r.feature_a for r in stats.corr_matrix(with_text).collect()} == {"a", "b", "c", "y"}
    t = stats.corr_with_target(df, ["a", "b", "c"], "y").collect()
    assert t[0].feature == "y" and t[0].r == 1
    assert [r.r for r in t if r.r is not None] == sorted([r.r for r in t if r.r is not None], reverse=True)


NOTES = "doc_id bigint, text string"


def test_note_entities_last_label_and_doc_freq(spark):
    spans = spark.createDataFrame([
        (1, "aspirin", "DRUG", 0, 1), (1, "aspirin", "DRUG", 5, 6),   # twice in one note: counted once
        (2, "heparin", "DRUG", 0, 1), (2, "heparin", "FORM", 9, 10),  # last label not DRUG: not counted
    ], "doc_id bigint, chunk string, entity string, start int, end int")
    ne = {(r.doc_id, r.chunk): (r.entity, r.first_start) for r in notes.note_entities(spans).collect()}
    assert ne == {(1, "aspirin"): ("DRUG", 0), (2, "heparin"): ("FORM", 0)}
    freq = notes.entity_doc_freq(notes.note_entities(spans), min_notes=1).collect()
    assert [(r.Drug, r.Frequency) for r in freq] == [("aspirin", 1)]
    free = {(r.doc_id, r.chunk): r.entity for r in notes.note_entities(spans, labels=None).collect()}
    assert free == {k: v[0] for k, v in ne.items()}
    odd = spans.union(spark.createDataFrame([(3, "x", "GENE", 0, 1)], spans.schema))
    with pytest.raises(Exception, match="label set"):
        notes.note_entities(odd).collect()
    assert notes.note_entities(odd, labels=None).where("entity = 'GENE'").count() == 1


def test_doc_freq_threshold_and_tie_order(spark):
    rows = []
    for n in range(6):
        rows.append((n, "zeta", "DRUG", 3))       # 6 notes: kept
        rows.append((n, "alpha", "DRUG", 5))      # 6 notes, appears later in note 0: after zeta
    for n in range(5):
        rows.append((n, "beta", "DRUG", 0))       # 5 notes: dropped
    ne = spark.createDataFrame(rows, "doc_id bigint, chunk string, entity string, first_start int")
    out = [(r.Drug, r.Frequency) for r in notes.entity_doc_freq(ne, min_notes=6).collect()]
    assert out == [("zeta", 6), ("alpha", 6)]


def test_entity_spans_lexicon_and_model_agree(spark, scratch):
    docs = spark.createDataFrame([(1, "Take Warfarin daily; warfarin again. Café heparinx"),
                                  (2, ""), (3, "nothing here")], NOTES)
    lex = spark.createDataFrame([("warfarin", "DRUG"), ("daily", "FREQUENCY")], "term string, entity string")
    spans = sorted(tuple(r) for r in notes.entity_spans(docs, lex).collect())
    assert spans == [(1, "daily", "FREQUENCY", 2, 3), (1, "warfarin", "DRUG", 1, 2), (1, "warfarin", "DRUG", 3, 4)]
    salted = sorted(tuple(r) for r in notes.entity_spans(docs, lex, max_broadcast_rows=0).collect())
    assert salted == spans
    model = sorted(tuple(r) for r in notes.extract_with_model(docs, notes.LexiconModel(lex)).collect())
    assert model == spans
    by_path = docs.selectExpr("concat('note_', doc_id) AS path", "text")
    keyed = sorted(tuple(r) for r in notes.extract_with_model(by_path, notes.LexiconModel(lex), key="path").collect())
    assert keyed == [("note_" + str(k), *rest) for k, *rest in spans]


def test_lexicon_classes(spark):
    b = spark.createDataFrame([("Alpha betaaa gammmma DELTAAA",)], "text string")
    lex = {r.term: r.entity for r in notes.lexicon_from_text(b).collect()}
    assert lex == {"betaaa": notes.ENTITY_CLASSES[6], "gammmma": notes.ENTITY_CLASSES[0],
                   "deltaaa": notes.ENTITY_CLASSES[0]}


ONE = ("<rxnormdata><drugGroup><name>Lovenox</name><conceptGroup><tty>BN</tty><conceptProperties>"
       "<rxcui>1</rxcui><name>Lovenox</name></conceptProperties></conceptGroup>"
       "<conceptGroup><tty>SBD</tty><conceptProperties><rxcui>2</rxcui><name>a</name></conceptProperties>"
       "<conceptProperties><rxcui>3</rxcui><name>b</name></conceptProperties></conceptGroup>"
       "<conceptGroup><tty>SCD</tty></conceptGroup></drugGroup></rxnormdata>")
SINGLE_GROUP = ("<rxnormdata><drugGroup><name>Coumadin</name><conceptGroup><tty>SBD</tty><conceptProperties>"
                "<rxcui>9</rxcui><name>c</name></conceptProperties></conceptGroup></drugGroup></rxnormdata>")


def test_xml_one_many_none_and_bad_payloads(spark):
    payloads = spark.createDataFrame([
        ("Lovenox", ONE), ("Coumadin", SINGLE_GROUP),
        ("NoGroup", "<rxnormdata><drugGroup><name>x</name></drugGroup></rxnormdata>"),
        ("Malformed", "<rxnormdata><drugGroup>"), ("Null", None)], "drug string, xml string")
    parsed = coding.parse_responses(payloads)
    got = sorted(tuple(r) for r in coding.flatten_concepts(parsed).collect())
    assert got == [("Coumadin", "9", "c"), ("Lovenox", "1", "Lovenox"), ("Lovenox", "2", "a"), ("Lovenox", "3", "b")]
    assert sorted(tuple(r) for r in coding.flatten_concepts(coding.json_roundtrip(parsed)).collect()) == got


def test_payload_build_roundtrip_and_coding_join(spark):
    concepts = spark.createDataFrame([("B&1", "T<1", i, f"n{i}") for i in range(20)] + [("B2", "T", 99, "z")],
                                     "brand string, grp string, key bigint, name string")
    pl = coding.concept_payloads(concepts, "brand", "grp", "key", "name", bucket=F.floor(F.col("key") / 8))
    assert pl.count() == 4  # 20 keys of B&1 in 3 buckets + one for B2
    flat = coding.flatten_concepts(coding.parse_responses(pl))
    assert sorted(tuple(r) for r in flat.collect()) == sorted(
        [("B&1", str(i), f"n{i}") for i in range(20)] + [("B2", "99", "z")])
    drugs = spark.createDataFrame([("B2", 7), ("Unknown", 3)], "Drug string, Frequency bigint")
    coded = [tuple(r) for r in coding.code_drugs(drugs, flat).select("Drug", "Frequency", "RxCUI").collect()]
    assert coded == [("B2", 7, "99")]
    url = coding.lookup_urls(spark.createDataFrame([("Lovenox",)], "Drug string")).first().request_url
    assert url == coding.SERVICE_BASE + coding.DRUGS_PATH + "Lovenox"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_small_salted_equals_broadcast(spark, how):
    big = spark.createDataFrame([(i % 3, i) for i in range(300)] + [(None, -1)], "k int, v int")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (7, "z")], "k int, s string")
    a = sorted(map(str, join_small(big, small, "k", how).collect()))
    b = sorted(map(str, join_small(big, small, "k", how, max_rows=0).collect()))
    assert a == b and len(a) > 0


def test_entity_rules_fill_tokens_the_lexicon_does_not_know(spark):
    docs = spark.createDataFrame([(1, "Warfarin daily by mouth; tablets nightly for weeks")], NOTES)
    lex = spark.createDataFrame([("warfarin", "DRUG"), ("nightly", "DOSAGE")], "term string, entity string")
    rules = {"FREQUENCY": "daily|nightly|weekly", "FORM": "tablets?|capsules?", "DURATION": "days?|weeks?"}
    got = sorted((r.chunk, r.entity, r.start) for r in notes.entity_spans(docs, lex, rules=rules).collect())
    assert got == [("daily", "FREQUENCY", 1), ("nightly", "DOSAGE", 5), ("tablets", "FORM", 4),
                   ("warfarin", "DRUG", 0), ("weeks", "DURATION", 7)]
    salted = sorted((r.chunk, r.entity, r.start) for r in
                    notes.entity_spans(docs, lex, rules=rules, max_broadcast_rows=0).collect())
    assert salted == got


def test_describe_table_wide(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, s string")
    rows = {r.summary: (r.x, r.s) for r in stats.describe_table(df).collect()}
    assert rows["count"] == ("2", "2") and rows["mean"][0] == "2.0" and rows["max"] == ("3.0", "b")


def test_model_hook_multi_token_terms(spark, scratch):
    docs = spark.createDataFrame([(1, "Take aspirin twice daily by mouth, then twice weekly."),
                                  (2, "by mouth by mouth daily")], NOTES)
    lex = spark.createDataFrame([("aspirin", "DRUG"), ("twice daily", "FREQUENCY"), ("daily", "FREQUENCY"),
                                 ("by mouth", "ROUTE"), ("mouth", "FORM"), ("twice", "DOSAGE")],
                                "term string, entity string")
    got = sorted(tuple(r) for r in notes.extract_with_model(docs, notes.LexiconModel(lex)).collect())
    assert sorted(tuple(r) for r in notes.entity_spans(docs, lex).collect()) == got
    with pytest.raises(ValueError):
        notes.LexiconModel(lex, max_rows=3)
    assert got == [
        (1, "aspirin", "DRUG", 1, 2), (1, "by mouth", "ROUTE", 4, 6), (1, "twice", "DOSAGE", 7, 8),
        (1, "twice daily", "FREQUENCY", 2, 4),
        (2, "by mouth", "ROUTE", 0, 2), (2, "by mouth", "ROUTE", 2, 4), (2, "daily", "FREQUENCY", 4, 5)]


def test_correlation_uses_pairwise_complete_rows(spark):
    df = spark.createDataFrame([(None, 0.0), (0.0, 0.0), (0.01, 0.01)], "x double, y double")
    r = {(a.feature_a, a.feature_b): a.r for a in stats.corr_matrix(df, ["x", "y"]).collect()}
    assert r[("x", "y")] == 1.0  # not 1.22: the row with a NULL x is left out on both sides


def test_payloads_keep_concepts_with_null_values(spark):
    df = spark.createDataFrame([("B1", "T", 1, None), ("B1", None, 2, "n2"), ("B1", "T", 3, "n3")],
                               "drug string, grp string, key bigint, name string")
    docs = coding.concept_payloads(df, "drug", "grp", "key", "name", bucket=F.lit(0))
    got = sorted(tuple(r) for r in coding.flatten_concepts(coding.parse_responses(docs)).collect())
    assert got == [("B1", "1", ""), ("B1", "2", "n2"), ("B1", "3", "n3")]


def test_numbers_units_and_phrases(spark):
    docs = spark.createDataFrame([(1, "Aspirin 81 mg twice daily for 7 days 50mg")], NOTES)
    lex = spark.createDataFrame([("aspirin", "DRUG"), ("Twice Daily", "FREQUENCY"), ("daily", "FREQUENCY")], "term string, entity string")
    rules = {"STRENGTH": "[0-9.]+ mg", "DURATION": "[0-9]+ days", "DOSAGE": "[0-9]+mg"}
    got = sorted(tuple(r)[1:] for r in notes.entity_spans(docs, lex, rules=rules).collect())
    assert got == [("50mg", "DOSAGE", 8, 9), ("7 days", "DURATION", 6, 8), ("81 mg", "STRENGTH", 1, 3), ("aspirin", "DRUG", 0, 1),
                   ("twice daily", "FREQUENCY", 3, 5)]


def test_rejected_responses_are_reported(spark):
    tag = coding.ROW_TAG
    one = "<conceptGroup><conceptProperties><rxcui>1</rxcui><name>n</name></conceptProperties></conceptGroup>"
    rows = [("good", f"<{tag}><drugGroup><name>g</name>{one}</drugGroup></{tag}>"), ("cut", f"<{tag}><drugGroup><name>g</na"),
            ("null", None), ("none", f"<{tag}><drugGroup><name>g</name></drugGroup></{tag}>"), ("text", "not xml"),
            ("empty group", f"<{tag}><drugGroup><conceptGroup><tty>x</tty></conceptGroup></drugGroup></{tag}>")]
    parsed = coding.parse_responses(spark.createDataFrame(rows, "drug string, xml string"))
    got = {r.drug: r.reason for r in coding.rejects(parsed).collect()}
    assert got == {"cut": "malformed", "null": "missing", "none": "no group", "text": "malformed", "empty group": "no concept"}
    assert [r.Drug for r in coding.flatten_concepts(parsed).collect()] == ["good"]

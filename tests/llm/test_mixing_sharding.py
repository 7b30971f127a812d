import re
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelake.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(sizes, weights, budget, caps):
    """Shares by weight; what a cap cuts off is shared again until none is above."""
    out, active, left = [0.0] * len(sizes), list(range(len(sizes))), float(budget)
    while active:
        total = sum(weights[i] for i in active)
        out = [left * weights[i] / total if i in active else x for i, x in enumerate(out)]
        over = [i for i in active if out[i] > caps[i]]
        if not over:
            break
        for i in over:
            out[i] = float(caps[i])
            left -= caps[i]
        active = [i for i in active if i not in over]
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9), st.sampled_from([0.1, 0.7, 1.5, 1.9, 3.0]))
def test_targets_equal_repeated_sharing(spark, sizes, share):
    names = [f"s{i:02}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "s string, size bigint")
    got = {r["s"]: r["target"] for r in mixing.targets(df, (5, 2, 1), share, 2).collect()}
    want = shared(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], share * sum(sizes), [2 * x for x in sizes])
    assert [got[n] for n in names] == pytest.approx(want, rel=1e-12)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 53)), f"s{i % 7}" if i % 11 else None, 1) for i in range(3000)]
    rows += [(5000 + i, " ".join(["hot"] * (1 + i % 40)), "s1", 1) for i in range(2000)]
    rows += [(9000, None, "s2", 1), (9001, "", "s3", 1), (9002, "only", "empty-later", 1), (9003, None, "nothing", 1), (9004, "w " * 5000, "s4", 1)]
    rows += [(7, rows[7][1], rows[7][2], 1)]  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    return docs.selectExpr("*", "1 AS `__e`", "2 AS copies", "3 AS s", "4 AS rank", "5 AS `row`")  # names the operators use themselves


def test_mix_meets_targets(docs):
    mix = mixing.mix(docs)
    got = mix.report().toPandas()
    assert len(got) == docs.count()
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert all(size[r.doc_id] == r.size for r in got[["doc_id", "size"]].itertuples())
    assert (got.taken <= 2 * got["size"]).all() and (got.taken == got["size"] * got.copies).all()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    got["source"] = [source[i] or "-" for i in got.doc_id]
    for _, g in got.groupby("source"):
        assert g["size"].sum() == g.source_size.iloc[0]
        assert abs(g.taken.sum() - g.target.iloc[0]) <= max(4, 0.01 * g.target.iloc[0])
    taken = dict(zip(got.doc_id, got.copies))
    applied = mix.apply(docs)
    assert applied.columns == docs.columns
    n = pd.Series([r["doc_id"] for r in applied.select("doc_id").collect()]).value_counts()
    assert all(n.get(i, 0) == c * (2 if i == 7 else 1) for i, c in taken.items())


def greedy(rows, target):
    """Words taken by the draw, document by document in the order of their ranks."""
    left, rest = target, []
    for size in rows:
        if size <= left:
            left -= size
        else:
            rest.append(size)
    near = min((abs(x - left) for x in rest), default=left)
    return target - left if near >= left else target - left + min((x for x in rest if abs(x - left) == near))


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_a_giant_document_does_not_end_the_draw(spark, seed):
    d = spark.range(3001).selectExpr("id AS doc_id", "repeat('w ', IF(id = 0, 60000, 50)) AS text", "'s' AS source")
    plan = mixing.mix(d, weights=(1,), share=0.45, seed=seed)
    got = plan.report().toPandas()
    target = got.target.iloc[0]
    assert abs(got.taken.sum() - target) <= 50  # 94,500 of 210,000 words, with the giant or without
    assert plan.apply(d).count() == got.copies.sum()


def test_the_draw_goes_on_behind_every_document_that_does_not_fit(spark):
    sizes = [(1, 3, 20, 400, 9000)[i % 5] + i % 7 for i in range(600)]
    d = spark.createDataFrame([(i, "w " * n, f"s{i % 2}") for i, n in enumerate(sizes)], "doc_id bigint, text string, source string")
    plan = mixing.mix(d, weights=(3, 2), share=0.3)
    got = plan.report().toPandas()
    ranked = plan._ranked(plan.rows).toPandas()
    for s, g in ranked.groupby("s"):
        mine = got[got.doc_id.isin(g.key)]
        want = greedy(g.sort_values(["rank", "tie"])["size"], mine.target.iloc[0])
        assert mine.taken.sum() == want and abs(want - mine.target.iloc[0]) <= 3


def test_repeated_rows_are_taken_together_if_all_fit(spark):
    rows = [(i, "w " * 50, "s") for i in range(40) for _ in range(1 + 19 * (i % 2))]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mixing.mix(d, weights=(1,), share=0.3)
    got = plan.report().toPandas()
    assert got.groupby("doc_id").copies.nunique().max() == 1
    assert abs(got.taken.sum() - got.target.iloc[0]) <= 50
    assert plan.apply(d).count() == got.copies.sum()


def test_reruns_and_partitions_agree(docs):
    a = sorted(map(tuple, mixing.mix(docs).report().collect()), key=str)
    b = sorted(map(tuple, mixing.mix(docs.repartition(5)).report().collect()), key=str)
    assert a == b
    c = sorted(map(tuple, mixing.mix(docs, seed=8).report().collect()), key=str)
    assert a != c


def test_importance_changes_the_odds(docs):
    d = docs.selectExpr("*", "IF(doc_id % 2 = 0, 4.0, 1.0) AS worth").where("source = 's1' AND doc_id <> 7")
    got = mixing.mix(d, weights=(1,), share=0.5, importance="worth").report().toPandas()
    assert abs(got.taken.sum() - got.target.iloc[0]) <= 0.02 * got.target.iloc[0]
    even, odd = got[got.doc_id % 2 == 0], got[got.doc_id % 2 == 1]
    assert 3 < even.copies.mean() / odd.copies.mean() < 5.5


def test_unequal_odds_follow_their_probabilities(spark):
    """Levels of importance far apart: capped ones are certain, the others' shares follow their weights."""
    d = spark.range(30_000).selectExpr("id AS doc_id", "concat('a b ', id) AS text", "'s' AS source", "pow(2.0, id % 5) AS worth")
    plan = mixing.mix(d, weights=(1,), share=0.9, importance="worth")
    got = plan.report().toPandas()
    share = [got[got.doc_id % 5 == k].copies.mean() for k in range(5)]
    # words: f * (1 + 2 + 4 + 8 + 16) capped at 2 copies: the top level is full
    f = (0.9 * 5 - 2) / 15
    assert share == pytest.approx([f, 2 * f, 4 * f, 8 * f, 2.0], abs=0.03)
    assert abs(got.taken.sum() - got.target.iloc[0]) <= 3
    assert (got[got.doc_id % 5 == 4].copies == 2).all()


def test_many_cells_and_many_sources(spark, monkeypatch):
    """The words run out inside one of many cells; sources by the thousand stay a table."""
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", 40)
    d = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + pow(10, (id * 7919 % 1000) / 400.0) as int)) AS text",
                                       "IF(id < 9000, 'hot', concat('s', id % 800)) AS source")
    plan = mixing.mix(d, importance=F.sqrt(mixing.n_words(F.col("text"))))
    got = plan.report().toPandas()
    got["source"] = ["hot" if i < 9000 else f"s{i % 800}" for i in got.doc_id]
    off = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), top=("size", "max"))
    assert abs(off.loc["hot"].taken - off.loc["hot"].target) <= 0.001 * off.loc["hot"].target + 5
    assert ((off.taken - off.target).abs() <= off.top).all() and ((off.taken - off.target).abs() / off.target).median() < 0.05
    again = mixing.mix(d.repartition(9), importance=F.sqrt(mixing.n_words(F.col("text")))).report().toPandas()
    assert got[["doc_id", "taken", "target"]].sort_values("doc_id").values.tolist() == again[["doc_id", "taken", "target"]].sort_values("doc_id").values.tolist()
    assert plan.apply(d).count() == got.copies.sum()


def test_inclusion_follows_its_probability(spark):
    d = spark.range(20000).selectExpr("id AS doc_id", "concat('a b ', id) AS text", "'s' AS source")
    got = mixing.mix(d, weights=(1,), share=0.3).report().toPandas()
    for part in range(4):
        assert abs(got[got.doc_id % 4 == part].copies.mean() - 0.3) < 0.02


def test_empty_mix(docs):
    assert mixing.mix(docs.limit(0)).report().count() == 0
    assert mixing.mix(docs.limit(0)).apply(docs.limit(0)).count() == 0


def test_shards(docs):
    got = sharding.shard(docs, shards=10).toPandas()
    assert len(got) == docs.count() and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert all(r.size == len(text[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id])
               for r in got[["doc_id", "size", "text_crc32"]].itertuples())
    by = got.groupby("shard")["size"].sum()
    assert len(by) == 10 and by.max() - by.min() <= 2 * got["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_a_hot_text_is_subdivided(spark):
    d = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'hot', concat('t', id)) AS text")
    got = sharding.shard(d, shards=8).toPandas()
    by = got.groupby("shard")["size"].sum()
    assert by.max() - by.min() <= 2 * got["size"].max()


def test_few_or_no_records(spark, docs):
    assert sharding.shard(docs.limit(0)).count() == 0
    d = spark.createDataFrame([(None, None), (None, "x"), (1, "x"), (1, "x")], "doc_id bigint, text string")
    got = sharding.shard(d, shards=3).toPandas()
    assert len(got) == 4 and got["size"].sum() == 3 * 17 + 16
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shards_are_written_in_order(spark, docs, scratch):
    more = docs.selectExpr("*", "doc_id % 3 AS shard", "'mine' AS slot", "1 AS _slot")
    stored = spark.read.parquet(sharding.write_shards(more, scratch("shards"), shards=4))
    assert stored.count() == docs.count()  # the repeated row too
    assert set(stored.columns) == {*docs.columns, "_shard", "__slot", "_slot", "slot", "shard"}
    assert stored.where("__slot <> 'mine' OR _shard <> doc_id % 3").count() == 0
    got = stored.select("shard", "slot", "doc_id").toPandas()
    assert set(got["shard"]) == {0, 1, 2, 3} and (got.doc_id == 7).sum() == 2
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    want = sharding.shard(docs, shards=4).select("shard", "slot", "doc_id").toPandas()
    key = ["shard", "slot"]
    a, b = (x.sort_values(key)[[*key, "doc_id"]].fillna(-1).to_numpy().tolist() for x in (got, want))
    assert a == b


def test_equal_rows_are_spread_over_cells(spark, monkeypatch):
    """Half of the rows are equal in id and text: no hash of these tells them apart."""
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 100)
    d = spark.range(4000).selectExpr("IF(id % 2 = 0, NULL, id) AS doc_id", "IF(id % 2 = 0, 'the same', concat('text ', id)) AS text").repartition(4)
    seen = []
    window = sharding.Window.partitionBy
    monkeypatch.setattr(sharding.Window, "partitionBy", staticmethod(lambda *c: (seen.append(c), window(*c))[1]))
    got = sharding.shard(d, shards=8)
    assert ("range", "part", "sub") in seen
    rows = got.toPandas()
    by = rows.groupby("shard")["size"].sum()
    assert len(rows) == 4000 and by.max() - by.min() <= 2 * rows["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in rows.groupby("shard"))


def test_ranges_are_bounded_and_the_rest_is_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_RANGES", 3)
    monkeypatch.setattr(sharding, "ROWS_PER_CELL", 50)
    d = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id % 700) AS text")
    rows = sharding.shard(d, shards=6).toPandas()
    by = rows.groupby("shard")["size"].sum()
    assert len(rows) == 3000 and by.max() - by.min() <= 2 * rows["size"].max()


def test_a_very_long_text_is_one_record(spark):
    d = spark.createDataFrame([(1, "x" * 3_000_000), *[(i, "y" * 1000) for i in range(2, 900)]], "doc_id bigint, text string")
    rows = sharding.shard(d, shards=3).toPandas()
    assert rows["size"].max() == 3_000_016 and len(rows) == 899 and rows.groupby("shard")["size"].sum().max() < 3_700_000

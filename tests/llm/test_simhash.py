import numpy as np
import pytest

from carelake.llm import simhash
from carelake.llm.components import components
from tests.llm.helpers import components as brute
from tests.llm.helpers import fingerprint


def test_fingerprints(spark):
    texts = [None, "", "A b", "a B c", "x  y\tz\x0bw", "É é x y", "w " * 70_000, "same words here and there again"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["id"]: r["fp"] % 2**64 for r in simhash.fingerprints(docs).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_gray_rank_orders_codes_that_differ_in_one_bit():
    x = np.arange(256, dtype=np.uint64)
    by = x[np.argsort(simhash.gray_rank(x))]
    assert all(bin(int(a ^ b)).count("1") == 1 for a, b in zip(by, by[1:]))


@pytest.mark.parametrize("node_rows", [25, 4096])
@pytest.mark.parametrize("distance", [0, 2, 3])
def test_links_join_all_that_is_linked(spark, node_rows, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 2**63, 8, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 8).astype(np.uint64) for _ in range(90)]
    fp = np.unique(np.concatenate([base, *[base ^ f ^ g for f, g in zip(flips, flips[1:])]]))
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint")
    root = {r["u"]: r["root"] for r in components(simhash.links(df, distance, node_rows)).collect()}
    signed = fp.view(np.int64).tolist()
    want = brute([int(x) for x in fp], distance)
    groups: dict = {}
    for i, c in enumerate(want):
        groups.setdefault(c, []).append(signed[i])
    for members in groups.values():
        assert {root.get(x, x) for x in members} == {min(members)}


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    fps = [fingerprint(t) for _, t in rows]
    low = brute(fps, 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == {rows[i][0]: (f"{fps[i]:016x}", rows[low[i]][0]) for i in range(len(rows))}


def test_nulls_ties_and_clashing_names(spark):
    rows = [(None, "a b c", 1), (None, "a b c", 2), (1, None, 3), (2, "", 4), (None, None, 5), (3, "x y", 6), (3, "x y", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == 7
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted(
        [("None", "None")] * 2 + [("1", "1"), ("2", "1"), ("None", "1"), ("3", "3"), ("3", "3")])
    kept = simhash.keep_one(docs).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r["text"]) == [("3", "x y"), ("None", "a b c")]
    assert len(kept) == 3 and simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_a_large_group_of_copies_sends_few_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one text of many copies', concat('text ', id, ' a b')) AS text")
    got = simhash.near_duplicates(docs).where("doc_id % 3 = 0").select("component_id").distinct().collect()
    assert [r[0] for r in got] == [0]


def test_one_row_stays_of_each_component_whatever_the_keys(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a, 1), (1, b, 2),                # one key, two texts that are no copies: both stay
            (2, b, 3), (3, a, 4),                # copies of them go
            (5, c, 5), (5, c, 6), (6, c, 7),     # equal rows: one stays
            (None, b, 8), (None, "null key only", 9), (None, "null key only", 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __d int")
    kept = simhash.keep_one(docs).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", a), ("1", b), ("5", c), ("None", "null key only")])
    # the smallest key of one component is merely a member of another
    rows = [(1, a, 0), (2, a, 0), (2, b, 0), (3, b, 0)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, fp int")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (2, b)]


def test_a_hub_is_not_joined_by_shuffle(spark, monkeypatch):
    from carelake.llm import components as C
    monkeypatch.setattr(C, "HUB_EDGES", 5)
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1000) for i in range(1, 50)] + [(2000, 2001), (2001, 2002)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r["u"]: r["root"] for r in C.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 400)}, **{i + 1000: 0 for i in range(1, 50)}, 2001: 2000, 2002: 2000}
    low = df.groupBy("u").count().selectExpr("u", "u AS m", "count AS n")
    assert C._beside(df, low, len(edges)).count() == len(edges)

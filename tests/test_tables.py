import pytest
from pyspark.sql import functions as F

from carelake.operators import tables as tbl

CORD = "cord_uid string, title string, publish_time string"


def _db(spark, scratch):
    root = scratch("db")
    return root, tbl.scratch_database(spark, f"{root}/db", prefix="t")


def test_merge_insert_only_keys(spark, scratch):
    root, db = _db(spark, scratch)
    t = f"{db}.clean"
    tbl.save_table(spark.createDataFrame([("a", "A", "1"), ("b", "B", "2")], CORD), t)
    src = spark.createDataFrame([
        ("a", "A2", "9"),          # matched: not inserted
        ("c", "C", "3"),           # unmatched: inserted
        ("d", "D1", "4"), ("d", "D2", "5"),  # two unmatched rows, same key: both inserted
        (None, "N", "6"),          # NULL key never matches: inserted
    ], CORD)
    n = tbl.merge_insert_only(spark, t, src, "cord_uid")
    assert n == 4
    rows = sorted(spark.table(t).collect(), key=lambda r: (r.cord_uid is None, r.cord_uid or "", r.title))
    assert [(r.cord_uid, r.title) for r in rows] == [
        ("a", "A"), ("b", "B"), ("c", "C"), ("d", "D1"), ("d", "D2"), (None, "N")]


def test_merge_into_bucketed_target(spark, scratch):
    root, db = _db(spark, scratch)
    t = f"{db}.b"
    tbl.save_table(spark.createDataFrame([("a", "A", "1"), ("b", "B", "2")], CORD), t, bucket_by=(4, ["cord_uid"]))
    src = spark.createDataFrame([("a", "x", "9"), ("c", "C", "3"), (None, "N", "6")], CORD)
    assert tbl.merge_insert_only(spark, t, src, "cord_uid") == 2
    assert sorted((r.cord_uid or "", r.title) for r in spark.table(t).collect()) == [
        ("", "N"), ("a", "A"), ("b", "B"), ("c", "C")]


def test_merge_twice_equals_once_for_non_null_keys(spark, scratch):
    root, db = _db(spark, scratch)
    t = f"{db}.m"
    tbl.save_table(spark.createDataFrame([("a", "A", "1")], CORD), t)
    src = spark.createDataFrame([("a", "x", "1"), ("b", "B", "2"), ("c", "C", "3")], CORD)
    tbl.merge_insert_only(spark, t, src, "cord_uid")
    once = sorted(spark.table(t).collect())
    assert tbl.merge_insert_only(spark, t, src, "cord_uid") == 0
    assert sorted(spark.table(t).collect()) == once


def _versioned(spark, scratch, rows):
    root, db = _db(spark, scratch)
    tbl.create_versioned(spark.createDataFrame(rows, CORD), f"{db}.raw", f"{root}/raw")
    return root, db


def test_snapshot_clone_is_isolated(spark, scratch):
    root, db = _versioned(spark, scratch, [("a", "A", "1"), ("b", "B", "2"), ("c", "C", "3")])
    tbl.snapshot_clone(spark, f"{db}.raw", f"{db}.clean", f"{root}/clean")
    tbl.append_versioned(spark.createDataFrame([("xxxxxxx",)], "cord_uid string"), f"{db}.raw")
    tbl.append_versioned(spark.createDataFrame([("e", "E", "5")], CORD), f"{db}.raw")
    assert spark.table(f"{db}.raw").count() == 5 and spark.table(f"{db}.clean").count() == 3
    tbl.snapshot_clone(spark, f"{db}.raw", f"{db}.deep", f"{root}/deep", deep=True)
    assert spark.table(f"{db}.deep").count() == 5


def test_a_clone_made_again_shows_the_new_state(spark, scratch):
    root, db = _versioned(spark, scratch, [("a", "A", "1")])
    for i, deep in enumerate((False, True, False)):
        tbl.append_versioned(spark.createDataFrame([(str(i), "x", "1")], CORD), f"{db}.raw")
        tbl.snapshot_clone(spark, f"{db}.raw", f"{db}.clean", f"{root}/clean{i}", deep=deep)
        assert spark.table(f"{db}.clean").count() == 2 + i
    tbl.append_versioned(spark.createDataFrame([("own", "x", "1")], CORD), f"{db}.clean")
    tbl.snapshot_clone(spark, f"{db}.clean", f"{db}.second", f"{root}/second")  # a clone of a clone
    tbl.append_versioned(spark.createDataFrame([("own2", "x", "1")], CORD), f"{db}.second")
    assert [spark.table(f"{db}.{t}").count() for t in ("raw", "clean", "second")] == [4, 5, 6]


def test_clone_of_an_empty_table(spark, scratch):
    root, db = _versioned(spark, scratch, [])
    tbl.snapshot_clone(spark, f"{db}.raw", f"{db}.c", f"{root}/c")
    tbl.append_versioned(spark.createDataFrame([("x", "X", "1")], CORD), f"{db}.raw")
    clone = spark.table(f"{db}.c")
    assert clone.count() == 0 and clone.columns == ["cord_uid", "title", "publish_time"]


def test_clone_then_merge_brings_new_rows(spark, scratch):
    """Clone, insert into the source, merge the source into the clone."""
    root, db = _versioned(spark, scratch, [("a", "A", "1")])
    tbl.snapshot_clone(spark, f"{db}.raw", f"{db}.clean", f"{root}/clean")
    tbl.append_versioned(spark.createDataFrame([("xxxxxxx",)], "cord_uid string"), f"{db}.raw")
    assert tbl.merge_insert_only(spark, f"{db}.clean", spark.table(f"{db}.raw"), "cord_uid") == 1
    got = {(r.cord_uid, r.title) for r in spark.table(f"{db}.clean").collect()}
    assert got == {("a", "A"), ("xxxxxxx", None)}
    assert tbl.merge_insert_only(spark, f"{db}.clean", spark.table(f"{db}.raw"), "cord_uid") == 0


def test_old_versions_are_dropped(spark, scratch):
    root, db = _db(spark, scratch)
    for i in range(4):
        tbl.publish(spark.range(i + 1), f"{db}.v", f"{root}/v")
    assert tbl.drop_old_versions(spark, f"{root}/v", f"{db}.v", keep=2) == 2
    assert spark.table(f"{db}.v").count() == 4


def test_insert_partial_sets_other_columns_null(spark, scratch):
    root, db = _db(spark, scratch)
    tbl.create_empty(spark, f"{db}.e", CORD)
    assert spark.table(f"{db}.e").count() == 0
    tbl.insert_partial(spark, f"{db}.e", {"cord_uid": "xxxxxxx"})
    (r,) = spark.table(f"{db}.e").collect()
    assert r.cord_uid == "xxxxxxx" and r.title is None and r.publish_time is None


def test_managed_table_default_mode_refuses_second_write(spark, scratch):
    root, db = _db(spark, scratch)
    df = spark.range(3)
    tbl.save_table(df, f"{db}.ehr")
    with pytest.raises(Exception):
        tbl.save_table(df, f"{db}.ehr")
    assert tbl.save_table(spark.range(5), f"{db}.ehr", mode="overwrite").count() == 5


def test_schema_evolution(spark, scratch):
    root = scratch("evolve")
    spark.createDataFrame([("a", "A")], "cord_uid string, title string").write.parquet(f"{root}/1")
    spark.createDataFrame([("b", "B", "x")], "cord_uid string, title string, extra string").write.parquet(f"{root}/2")
    got = {tuple(r) for r in tbl.read_evolving(spark, f"{root}/1", f"{root}/2")
           .select("cord_uid", "title", "extra").collect()}
    assert got == {("a", "A", None), ("b", "B", "x")}
    u = tbl.union_evolving(spark.createDataFrame([("a",)], "k string"),
                           spark.createDataFrame([("b", 1)], "k string, v int"))
    assert sorted(tuple(r) for r in u.collect()) == [("a", None), ("b", 1)]


def test_database_recreate_and_path_tables(spark, scratch):
    root = scratch("ddl")
    tbl.recreate_database(spark, "carelake_ddl_test", f"{root}/db")
    spark.sql("CREATE TABLE carelake_ddl_test.x (a INT) USING parquet")
    tbl.recreate_database(spark, "carelake_ddl_test", f"{root}/db")  # drop cascade, create, use
    assert spark.catalog.currentDatabase() == "carelake_ddl_test"
    assert not spark.catalog.tableExists("carelake_ddl_test.x")
    spark.sql("USE default")
    p = tbl.write_overwrite(spark.range(4), f"{root}/p")
    assert tbl.read_path(spark, p).count() == 4
    assert tbl.create_external(spark, "carelake_ddl_test.ext", p).count() == 4
    d = tbl.table_detail(spark, p).first()
    assert d.num_files >= 1 and d.size_in_bytes > 0
    assert [tuple(r) for r in tbl.describe_schema(spark.range(1)).collect()] == [("id", "bigint")]


def test_publish_keeps_old_version_when_job_fails(spark, scratch):
    from carelake.operators.quality import Rule, enforce
    root, db = _db(spark, scratch)
    good = spark.createDataFrame([(1,), (2,)], "Count int")
    tbl.publish(good, f"{db}.s", f"{root}/s")
    bad = enforce(spark.createDataFrame([(1,), (0,)], "Count int"), [Rule("valid_count", "Count > 0", "fail")])
    with pytest.raises(Exception, match="valid_count"):
        tbl.publish(bad, f"{db}.s", f"{root}/s")
    assert sorted(r.Count for r in spark.table(f"{db}.s").collect()) == [1, 2]
    assert spark.table(f"{db}.s").where(F.col("Count") == 0).count() == 0


def test_two_interleaved_appends_lose_nothing(spark, scratch, monkeypatch):
    """A second writer starts and ends while the first one writes its rows."""
    root, db = _versioned(spark, scratch, [("a", "A", "1")])
    name, look = f"{db}.raw", tbl._segments
    calls = []

    def slow(spark, name):
        calls.append(1)
        if len(calls) == 2:  # the first writer's rows are written; it looks at the list again
            monkeypatch.setattr(tbl, "_segments", look)
            tbl.append_versioned(spark.createDataFrame([("second", "S", "2")], CORD), name)
        return look(spark, name)

    monkeypatch.setattr(tbl, "_segments", slow)
    tbl.append_versioned(spark.createDataFrame([("first", "F", "3")], CORD), name)
    assert sorted(r.cord_uid for r in spark.table(name).collect()) == ["a", "first", "second"]
    assert len({b for _, names in tbl.versions(spark, name) for b in names}) == 3


def test_a_merge_is_refused_when_the_table_has_changed(spark, scratch):
    root, db = _versioned(spark, scratch, [("a", "A", "1")])
    name = f"{db}.raw"
    seen = tbl.versions(spark, name)
    new = tbl.new_rows(spark.table(name), spark.createDataFrame([("b", "B", "1")], CORD), ["cord_uid"])
    tbl.append_versioned(spark.createDataFrame([("b", "other", "1")], CORD), name)
    with pytest.raises(tbl.ConcurrentWrite):
        tbl.append_versioned(new, name, seen)
    assert sorted((r.cord_uid, r.title) for r in spark.table(name).collect()) == [("a", "A"), ("b", "other")]
    assert tbl.merge_insert_only(spark, name, spark.createDataFrame([("b", "B", "1"), ("c", "C", "1")], CORD), "cord_uid") == 1


def test_a_folder_of_a_write_that_died_is_not_seen(spark, scratch):
    root, db = _versioned(spark, scratch, [("a", "A", "1")])
    spark.createDataFrame([("lost", "L", "1")], CORD).write.parquet(f"{root}/raw/batch=b1-deadbeef")
    tbl.append_versioned(spark.createDataFrame([("b", "B", "1")], CORD), f"{db}.raw")
    assert sorted(r.cord_uid for r in spark.table(f"{db}.raw").collect()) == ["a", "b"]


def _exchanged_rows(plan):
    """Rows that went through the shuffles of a plan that has run."""
    total, todo = 0, [plan]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "Exchange" and p.metrics().contains("shuffleRecordsWritten"):
            total += p.metrics().apply("shuffleRecordsWritten").value()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(p.plan())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


def test_a_prefiltered_merge_does_not_shuffle_what_is_surely_new(spark):
    target = spark.range(0, 20_000, 7).selectExpr("id AS k", "concat('s', id) AS s").repartition(3)
    source = (spark.range(0, 60_000).selectExpr("id AS k", "concat('s', id) AS s", "id AS v")
              .unionAll(spark.createDataFrame([(None, "s1", -1), (3, None, -2), (7, "s7", -3), (8, "s8", -4)], "k bigint, s string, v bigint")).repartition(5))
    got = {}
    for prefilter in (False, True):
        for on in (["k"], ["k", "s"]):
            df = tbl.new_rows(target, source, on, prefilter)
            got[prefilter, len(on)] = sorted(map(tuple, df.collect()), key=str)
    assert got[True, 1] == got[False, 1] and got[True, 2] == got[False, 2] and len(got[True, 1]) > 57_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        moved = {}
        for prefilter in (False, True):
            df = tbl.new_rows(target, source, ["k"], prefilter)
            plan = df._jdf.queryExecution().executedPlan()
            df._jdf.queryExecution().toRdd().count()
            moved[prefilter] = _exchanged_rows(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert moved[False] > 60_000
    assert moved[True] - 2 * 60_004 - 2 * 2858 < 0.3 * moved[False]  # beside the tests' own repartitions


def test_bloom_filter_holds_every_key(spark):
    keys = spark.range(5000).selectExpr("id * 13 AS k")
    bloom = tbl.bloom_filter(keys, ["k"], 5000)
    blocks = -(-5000 * tbl.BLOOM_BITS // tbl._BLOCK_BITS)
    assert bloom.count() <= blocks
    probe = spark.range(65_000).withColumnRenamed("id", "k").withColumn("__block", tbl._bloom_bits(["k"], blocks)[0])
    seen = probe.join(F.broadcast(bloom), "__block", "left").where(tbl._may_be_known(["k"], blocks)).select("k")
    assert seen.where("k % 13 = 0").count() == 5000
    assert seen.where("k % 13 <> 0").count() < 0.02 * 60_000

import os

import pytest
from pyspark.sql import functions as F

from carelake.operators.quality import Rule, enforce, expect_report, observe_rules, report_from_observation
from carelake.plans import medallion
from carelake.sources import files
from carelake.streaming.incremental import incremental_load, read_loaded

HEADER = "Year,First Name,County,Sex,Count\n"


def _csv(dirpath, name, body):
    os.makedirs(dirpath.removeprefix("file:"), exist_ok=True)
    with open(os.path.join(dirpath.removeprefix("file:"), name), "w") as f:
        f.write(HEADER + body)


CLEAN = ("2021,OLIVIA,KINGS,F,100\n2021,LIAM,KINGS,M,90\n2020,OLIVIA,QUEENS,F,80\n"
         "2021,OLIVIA,QUEENS,F,5\n")


def test_rules_warn_counts_and_null_is_violation(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None), ("d", -1)], "First_Name string, Count int")
    rules = [Rule("valid_first_name", "First_Name IS NOT NULL"), Rule("valid_count", "Count > 0")]
    got = {r.rule: (r.passed, r.failed) for r in expect_report(df, rules).collect()}
    assert got == {"valid_first_name": (3, 1), "valid_count": (2, 2)}
    for p, f in got.values():
        assert p + f == df.count()
    checked, obs = observe_rules(df, rules)
    checked.write.format("noop").mode("overwrite").save()
    rep = {r.rule: (r.passed, r.failed) for r in report_from_observation(spark, obs, rules).collect()}
    assert rep == got


def test_fail_rule_raises_inside_plan(spark):
    df = spark.createDataFrame([(1,), (0,)], "Count int")
    with pytest.raises(Exception, match="valid_count"):
        enforce(df, [Rule("valid_count", "Count > 0", "fail")]).collect()
    ok = spark.createDataFrame([(1,), (2,)], "Count int")
    assert enforce(ok, [Rule("valid_count", "Count > 0", "fail")]).count() == 2


def test_bronze_sql_failfast_raises_and_permissive_gives_null(spark, scratch):
    d = scratch("csv")
    _csv(d, "rows.csv", CLEAN + "2021,NOAH,KINGS,M,many\n")
    with pytest.raises(Exception):
        medallion.bronze_sql(spark, d).collect()
    py = medallion.bronze_py(spark, d)  # inferred: Count falls back to string
    assert "First_Name" in py.columns
    lenient = files.scan_csv(spark, d, schema=medallion.BRONZE_SCHEMA)  # permissive + schema
    assert lenient.where(F.col("Count").isNull()).count() == 1


def test_bronze_py_infers_types(spark, scratch):
    d = scratch("csv")
    _csv(d, "rows.csv", CLEAN)
    df = medallion.bronze_py(spark, d)
    types = dict(df.dtypes)
    assert types["Year"] == "int" and types["Count"] == "int" and types["First_Name"] == "string"


def test_gold_sorted_with_ties_and_top10(spark):
    rows = [(2021, f"N{i:02d}", 100 - i) for i in range(12)] + [(2021, "N09b", 91), (2020, "OLD", 1000)]
    silver = spark.createDataFrame(rows, "Year_Of_Birth int, First_Name string, Count int")
    g = medallion.gold(silver, 2021).collect()
    assert [r.Total_Count for r in g] == sorted([r.Total_Count for r in g], reverse=True)
    top = medallion.gold_top(silver, 2021, 10).collect()
    assert len(top) == 10
    # N09 and N09b tie at rank 10 (91): the name breaks the tie
    assert top[-1].First_Name == "N09" and top[-1].Total_Count == 91


def test_whole_text_notes_scan(spark, scratch):
    d = scratch("notes").removeprefix("file:")
    os.makedirs(d)
    texts = {"mt_oncology_0.txt": "line one\nline two\n", "mt_oncology_1.txt": "", "mt_oncology_2.txt": "x"}
    for n, t in texts.items():
        with open(os.path.join(d, n), "w") as f:
            f.write(t)
    def scanned(**how):
        return {r.path.rsplit("/", 1)[-1]: r.text for r in files.scan_notes(spark, d, **how).collect()}

    # Zero-length files are skipped by Spark's file scan; the listing has them.
    assert scanned(keep_empty=False) == {k: v for k, v in texts.items() if v}
    assert scanned() == texts
    listing = files.list_files(spark, d, "*.txt")
    assert listing.count() == 2 and set(listing.columns) == {"path", "modificationTime", "length"}


def test_notes_written_and_read_back(spark, scratch):
    rows = [("007", "a\nb"), ("7", "ends with newline\n"), ("e", ""), ("n", None), ("s", "x\x1ey\x1fz\x1b01 \r\n")]
    df = spark.createDataFrame(rows, "note string, text string")
    p = scratch("notes")
    files.write_notes(df.coalesce(1), p, "note")
    assert sorted(map(tuple, files.read_notes(spark, p, "note").collect())) == sorted(rows)
    parts = [f for f in os.listdir(p.removeprefix("file:")) if f.startswith("part-")]
    assert len(parts) == 1  # a pack, not a folder or file per note
    files.write_notes(df.where("note LIKE '%7'"), p, "note")
    assert sorted(r.note for r in files.read_notes(spark, p, "note", "int").collect()) == [7, 7]


def test_scan_notes_takes_the_id_from_the_file_name(spark, scratch):
    root = scratch("note-files").removeprefix("file:")
    for name, text in (("a/007.txt", "one\n"), ("b=3/7.txt", "two"), ("note.v1.txt", "three")):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    got = {(r.note_id, r.text) for r in files.scan_notes(spark, root).collect()}
    assert got == {("007", "one\n"), ("7", "two"), ("note.v1", "three")}


def test_gold_reads_a_checked_silver(spark, scratch):
    """A bad row of another year stops the update, wherever it is stored."""
    root = scratch("checked")
    schema = "Year int, First_Name string, County string, Sex string, Count int"
    for i, row in enumerate([(1998, "A", "x", "F", 3), (1997, "B", "x", "F", 0)]):
        spark.createDataFrame([row], schema).write.parquet(f"{root}/in/{i}")
    bronze = spark.read.parquet(f"{root}/in/0", f"{root}/in/1")
    with pytest.raises(Exception, match="valid_count"):
        medallion.gold(medallion.store_silver(bronze, f"{root}/silver"), 1998).collect()
    good = medallion.store_silver(bronze.where("Count > 0"), f"{root}/silver2")
    assert [tuple(r) for r in medallion.gold(good, 1998).collect()] == [("A", 3)]


def test_a_given_master_and_checkpoint_folder_survive(tmp_path):
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.')\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            f"s.sparkContext.setCheckpointDir('{tmp_path}')\n"
            "from carelake.session import build_session, checkpoint_root, clean_scratch, scratch_dir\n"
            "spark = build_session()\n"
            "assert spark.sparkContext.master == 'local[2]'\n"
            f"assert checkpoint_root(spark).startswith('file:{tmp_path}'), checkpoint_root(spark)\n"
            "a, b = scratch_dir(spark, 'x'), scratch_dir(spark, 'x')\n"
            "assert a != b and a.startswith(checkpoint_root(spark))\n"
            "spark.range(3).write.parquet(a)\n"
            "assert clean_scratch(spark, 'x') and not clean_scratch(spark, 'x')\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_incremental_load_is_idempotent(spark, scratch):
    root = scratch("inc")
    land = f"{root}/landing"
    _csv(f"{land}/b1", "rows.csv", CLEAN)
    args = (f"{land}/*", medallion.BRONZE_SCHEMA, f"{root}/t", f"{root}/ck")
    assert incremental_load(spark, *args) == 4
    assert incremental_load(spark, *args) == 0
    assert read_loaded(spark, f"{root}/t").count() == 4
    _csv(f"{land}/b2", "rows.csv", "2021,EMMA,BRONX,F,7\n")
    assert incremental_load(spark, *args) == 1
    assert read_loaded(spark, f"{root}/t").count() == 5


def test_medallion_run_updates_and_fail_keeps_old_tables(spark, scratch):
    root = scratch("med")
    land, out = f"{root}/landing", f"{root}/out"
    _csv(f"{land}/b1", "rows.csv", CLEAN + "2021,,KINGS,M,3\n")  # NULL name: warned, kept
    res = medallion.run_medallion(spark, f"{land}/*", out, 2021, "med_test_db")
    rep = {r.rule: (r.passed, r.failed) for r in res["report"].collect()}
    assert rep["valid_first_name"] == (4, 1) and rep["valid_count"] == (5, 0)
    gold = [(r.First_Name, r.Total_Count) for r in res["gold"].collect()]
    assert gold[0] == ("OLIVIA", 105)
    # A file with Count = 0 stops the update: silver and gold keep their versions.
    _csv(f"{land}/b2", "rows.csv", "2021,EMMA,BRONX,F,0\n")
    with pytest.raises(Exception, match="valid_count"):
        medallion.run_medallion(spark, f"{land}/*", out, 2021, "med_test_db")
    assert spark.table("med_test_db.silver").count() == 5
    assert {r.First_Name for r in spark.table("med_test_db.gold").collect()} == {"OLIVIA", "LIAM", None}
    history = spark.table("med_test_db.expectations")
    assert history.count() == 2 and set(history.columns) >= {"rule", "passed", "failed", "table", "run_at"}
    # full refresh starts from a new bronze generation (new folder, new checkpoint)
    land2 = f"{root}/landing2"
    _csv(f"{land2}/b1", "rows.csv", CLEAN)
    res = medallion.run_medallion(spark, f"{land2}/*", out, 2021, "med_test_db", full_refresh=True)
    assert res["bronze_rows_added"] == 4


def test_blob_credentials_are_session_conf(spark):
    files.set_blob_sas(spark, "public", "lake", "tok")
    assert spark.conf.get("fs.azure.sas.public.lake.blob.core.windows.net") == "tok"
    assert files.blob_uri("public", "lake", "/a/b.parquet") == "wasbs://public@lake.blob.core.windows.net/a/b.parquet"


def test_incremental_load_schema_evolution(spark, scratch):
    root = scratch("ev").removeprefix("file:")
    os.makedirs(f"{root}/land/b1")
    with open(f"{root}/land/b1/a.csv", "w") as f:
        f.write("cord_uid,title\na,A\nb,B\n")
    args = (f"{root}/land/*", f"{root}/t", f"{root}/ck")
    assert incremental_load(spark, args[0], "cord_uid string, title string", *args[1:]) == 2
    assert incremental_load(spark, args[0], "cord_uid string, title string", *args[1:]) == 0
    os.makedirs(f"{root}/land/b2")
    with open(f"{root}/land/b2/a.csv", "w") as f:
        f.write("cord_uid,title,journal\nc,C,J\n")
    assert incremental_load(spark, args[0], "cord_uid string, title string, journal string", *args[1:]) == 1
    got = sorted(tuple(r) for r in read_loaded(spark, args[1]).select("cord_uid", "title", "journal").collect())
    assert got == [("a", "A", None), ("b", "B", None), ("c", "C", "J")]


def test_null_count_stops_the_update(spark, scratch):
    root = scratch("med")
    land, out = f"{root}/landing", f"{root}/out"
    _csv(f"{land}/b1", "rows.csv", CLEAN)
    medallion.run_medallion(spark, f"{land}/*", out, 2021, "med_null_db")
    _csv(f"{land}/b2", "rows.csv", "2021,EMMA,BRONX,F,\n")  # NULL Count
    with pytest.raises(Exception, match="valid_count"):
        medallion.run_medallion(spark, f"{land}/*", out, 2021, "med_null_db")
    assert spark.table("med_null_db.silver").count() == 4


def test_continuous_load_picks_up_new_files(spark, scratch):
    from carelake.streaming.incremental import start_continuous_load
    root = scratch("cont").removeprefix("file:")
    os.makedirs(f"{root}/land/b1")
    with open(f"{root}/land/b1/a.csv", "w") as f:
        f.write("k,v\na,1\n")
    q = start_continuous_load(spark, f"{root}/land/*", "k string, v int", f"{root}/t", f"{root}/ck", every="1 second")
    try:
        q.processAllAvailable()
        os.makedirs(f"{root}/land/b2")
        with open(f"{root}/land/b2/a.csv", "w") as f:
            f.write("k,v\nb,2\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(tuple(r) for r in read_loaded(spark, f"{root}/t").collect()) == [("a", 1), ("b", 2)]


def test_incremental_load_counts_every_batch(spark, scratch):
    root = scratch("many").removeprefix("file:")
    for i in range(5):
        os.makedirs(f"{root}/land/b{i}")
        with open(f"{root}/land/b{i}/a.csv", "w") as f:
            f.write("k,v\n" + "".join(f"x{i}_{j},{j}\n" for j in range(3)))
    n = incremental_load(spark, f"{root}/land/*", "k string, v int", f"{root}/t", f"{root}/ck",
                         max_files_per_trigger=1)
    assert n == 15 and read_loaded(spark, f"{root}/t").count() == 15


def test_medallion_run_before_any_file_landed(spark, scratch):
    root = scratch("empty").removeprefix("file:")
    os.makedirs(f"{root}/landing")
    res = medallion.run_medallion(spark, f"{root}/landing", f"{root}/out", 2021, "med_empty_db")
    assert res["bronze_rows_added"] == 0 and res["gold"].count() == 0
    _csv(f"{root}/landing", "a.csv", CLEAN)
    res = medallion.run_medallion(spark, f"{root}/landing", f"{root}/out", 2021, "med_empty_db")
    assert res["bronze_rows_added"] == 4 and res["gold"].count() == 2


def test_command_line_jobs(spark, scratch, capsys):
    import json

    from carelake.plans import jobs
    root = scratch("jobs").removeprefix("file:")
    _csv(f"{root}/land/b1", "a.csv", CLEAN)
    assert jobs.main(["medallion", "--landing", f"{root}/land/*", "--out", f"{root}/out",
                      "--year", "2021", "--db", "jobs_test_db"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["bronze_rows_added"] == 4 and {r["rule"] for r in out["rules"]} == {"valid_first_name", "valid_count"}
    assert jobs.main(["load", "--source", f"{root}/land/*", "--schema", medallion.BRONZE_SCHEMA,
                      "--target", f"{root}/t", "--checkpoint", f"{root}/ck"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"rows_added": 4}


def test_continuous_load_resumes_after_a_stop(spark, scratch):
    from carelake.streaming.incremental import start_continuous_load
    root = scratch("resume").removeprefix("file:")
    args = (f"{root}/land/*", "k string, v int", f"{root}/t", f"{root}/ck")
    os.makedirs(f"{root}/land/b1")
    with open(f"{root}/land/b1/a.csv", "w") as f:
        f.write("k,v\na,1\n")
    q = start_continuous_load(spark, *args, every="1 second")
    q.processAllAvailable()
    q.stop()
    os.makedirs(f"{root}/land/b2")  # arrives while the load is stopped
    with open(f"{root}/land/b2/a.csv", "w") as f:
        f.write("k,v\nb,2\n")
    q = start_continuous_load(spark, *args, every="1 second")
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in read_loaded(spark, f"{root}/t").collect()) == [("a", 1), ("b", 2)]


def test_scan_csv_separator_schema_and_modes(spark, scratch):
    d = scratch("csv2").removeprefix("file:")
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("id|name|amount\n1|x|2.5\n2|y|bad\n")
    inferred = files.scan_csv(spark, d, sep="|")
    assert dict(inferred.dtypes) == {"id": "int", "name": "string", "amount": "string"}
    declared = files.scan_csv(spark, d, schema="id INT, name STRING, amount DOUBLE", sep="|")
    assert [(r.id, r.amount) for r in declared.orderBy("id").collect()] == [(1, 2.5), (2, None)]
    with pytest.raises(Exception):
        files.scan_csv(spark, d, schema="id INT, name STRING, amount DOUBLE", sep="|", mode="FAILFAST").collect()
    out = files.write_csv(declared.where("amount IS NOT NULL"), f"{d}/out", sep=";")
    again = files.scan_csv(spark, out, schema="id INT, name STRING, amount DOUBLE", sep=";")
    assert [tuple(r) for r in again.collect()] == [(1, "x", 2.5)]

"""Bronze -> silver -> gold for name counts.

bronze: CSV as it arrives (the Python variant infers the schema and is
        permissive; the SQL variant declares it and fails fast), ``First Name``
        renamed to ``First_Name``.
silver: ``Year AS Year_Of_Birth, First_Name, Count`` under two expectations:
        ``valid_first_name`` warns, ``valid_count`` stops the update.
gold:   names of one year, total count per name, largest first.

``run_medallion`` runs the three layers as one triggered update: bronze is an
incremental, exactly-once load of newly arrived files; silver appends the new
bronze rows that pass the rules (partitioned by year, so gold reads one
partition); gold is recomputed and published as a new version only when its job
succeeds.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.quality import Rule, counters, enforce, report_of
from carelake.operators.tables import drop_old_versions, nothing_there, point_name, publish
from carelake.sources.files import scan_csv
from carelake.streaming.incremental import incremental_load, run_available_now

BRONZE_SCHEMA = "Year INT, `First Name` STRING, County STRING, Sex STRING, Count INT"
BRONZE_TABLE_SCHEMA = "Year INT, First_Name STRING, County STRING, Sex STRING, Count INT"
SILVER_TABLE_SCHEMA = "First_Name STRING, Count INT, Year_Of_Birth INT"

SILVER_RULES = [
    Rule("valid_first_name", "First_Name IS NOT NULL", "warn"),
    Rule("valid_count", "Count > 0", "fail"),
]

KEPT_VERSIONS = 3  # of gold: readers of an older one finish before its files go

# The table comments of the three layers.
BRONZE_COMMENT = "Data ingested from NY State Department of Health"
SILVER_COMMENT = "Data cleaned and prepared for analysis"
GOLD_COMMENT = "A table summarizing counts of the top names for NY in {year}."


def bronze_py(spark: SparkSession, path: str) -> DataFrame:
    """Inferred schema, permissive parsing, one rename."""
    return scan_csv(spark, path).withColumnRenamed("First Name", "First_Name")


def bronze_sql(spark: SparkSession, path: str) -> DataFrame:
    """Declared schema, fail-fast parsing, projection written in SQL."""
    raw = scan_csv(spark, path, schema=BRONZE_SCHEMA, mode="FAILFAST")
    return spark.sql("SELECT Year, `First Name` AS First_Name, County, Sex, Count FROM {raw}", raw=raw)


def bronze_rename(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("First Name", "First_Name").select("Year", "First_Name", "County", "Sex", "Count")


def silver(bronze: DataFrame, rules: list[Rule] = SILVER_RULES) -> DataFrame:
    """Rename and project; ``fail`` rules raise inside the plan."""
    df = bronze.withColumnRenamed("Year", "Year_Of_Birth").select("Year_Of_Birth", "First_Name", "Count")
    return enforce(df, rules)


def store_silver(bronze: DataFrame, path: str, rules: list[Rule] = SILVER_RULES) -> DataFrame:
    """Silver as a checked table, partitioned by year.

    Every row passes the rules while it is written, whatever is read later: a
    filter on a lazily checked frame would be pushed below the check, and rows it
    prunes would never be checked. A failing rule leaves nothing at ``path``.
    """
    silver(bronze, rules).write.partitionBy("Year_Of_Birth").parquet(path)
    return bronze.sparkSession.read.schema(SILVER_TABLE_SCHEMA).parquet(path)


def gold(silver_df: DataFrame, year: int) -> DataFrame:
    """Total count per name in ``year``, largest first (ties by name). ``silver_df``
    is a stored, checked table (``store_silver``)."""
    return (silver_df.filter(F.expr(f"Year_Of_Birth == {int(year)}"))
            .groupBy("First_Name").agg(F.sum("Count").alias("Total_Count"))
            .sort(F.desc("Total_Count"), F.asc("First_Name")))


def gold_top(silver_df: DataFrame, year: int, k: int = 10) -> DataFrame:
    """The top-``k`` names (plans as a top-k, not a full sort)."""
    return gold(silver_df, year).limit(k)


def run_medallion(spark: SparkSession, landing_dir: str, out_dir: str, year: int, db: str,
                  full_refresh: bool = False) -> dict:
    """One triggered update of the three layers.

    bronze: files that arrived since the last update, loaded exactly once.
    silver: the bronze rows new since the last update, checked and appended
            (partitioned by year). A ``fail`` rule violation fails the batch:
            nothing of it is committed, silver and gold keep their state, and
            the next update retries the same rows.
    gold:   recomputed from the year's silver partition and published atomically.

    Returns ``{"bronze_rows_added", "report" (DataFrame), "gold" (DataFrame)}``;
    the rule counts of every update are also appended to ``<db>.expectations``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{out_dir}/_db'")
    gen = _generation(spark, out_dir, new=full_refresh)
    bronze_dir, bronze_ck = f"{out_dir}/bronze/{gen}/data", f"{out_dir}/bronze/{gen}/_checkpoint"
    silver_dir, silver_ck = f"{out_dir}/silver/{gen}/data", f"{out_dir}/silver/{gen}/_checkpoint"
    added = incremental_load(spark, landing_dir, BRONZE_SCHEMA, bronze_dir, bronze_ck, fmt="csv",
                             transform=bronze_rename)

    # Silver reads the committed bronze files through bronze's commit log.
    new_bronze = spark.readStream.schema(BRONZE_TABLE_SCHEMA).parquet(bronze_dir)
    checked = silver(new_bronze, SILVER_RULES).observe("silver_rules", *counters(SILVER_RULES))
    run = run_available_now(checked, silver_dir, silver_ck, partition_by=["Year_Of_Birth"])
    totals = {m: 0 for m in ["__rows"] + [r.name for r in SILVER_RULES]} | run.observed.get("silver_rules", {})
    report = report_of(spark, totals, SILVER_RULES)
    # Expectation history: one row per rule and update, appended (never rewritten).
    (report.withColumn("table", F.lit("silver")).withColumn("run_at", F.current_timestamp())
     .write.mode("append").parquet(f"{out_dir}/_expectations"))
    point_name(spark, f"{db}.expectations", f"{out_dir}/_expectations", "Expectation counts per update")

    for name, path, comment in ((f"{db}.bronze", bronze_dir, BRONZE_COMMENT),
                                (f"{db}.silver", silver_dir, SILVER_COMMENT)):
        try:
            point_name(spark, name, path, comment)
        except AnalysisException as e:  # nothing has landed yet; the name appears with the first file
            if not nothing_there(e):
                raise
    # Declared schema: also reads a sink that has not committed any file yet;
    # the year filter prunes silver to one partition.
    silver_tbl = spark.read.schema(SILVER_TABLE_SCHEMA).parquet(silver_dir)
    gold_tbl = publish(gold(silver_tbl, year), f"{db}.gold", f"{out_dir}/gold", GOLD_COMMENT.format(year=year))
    drop_old_versions(spark, f"{out_dir}/gold", f"{db}.gold", keep=KEPT_VERSIONS)
    # Row order of stored files is not kept on read: sort again.
    gold_sorted = gold_tbl.sort(F.desc("Total_Count"), F.asc("First_Name"))
    return {"bronze_rows_added": added, "report": report, "gold": gold_sorted}


def _generation(spark: SparkSession, out_dir: str, new: bool) -> str:
    """Name of the bronze generation; a full refresh starts a new one (new data
    folder and new stream checkpoint), leaving the old files untouched.

    Generations are counted. Each refresh appends one marker row and none is ever
    rewritten, so a refresh that dies before its marker is committed leaves the last
    one in force. No marker yet: ``g-0``.
    """
    markers = f"{out_dir}/_generations"
    try:
        last = spark.read.schema("generation int").parquet(markers).agg(F.max("generation")).first()[0] or 0
    except AnalysisException as e:
        if not nothing_there(e):
            raise
        last = 0
    if new:
        last += 1
        spark.createDataFrame([(last,)], "generation int").coalesce(1).write.mode("append").parquet(markers)
    return f"g-{last}"

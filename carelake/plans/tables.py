"""How the driver's test tables stand in for the notebooks' inputs.

name counts      <- lineitem: Year = year(l_shipdate), First Name = 'name_' || l_suppkey,
                    County = l_returnflag, Sex = l_linestatus, Count = int(l_quantity)
daily counts     <- orders (date o_orderdate, state o_orderpriority, measure o_totalprice)
                    and lineitem (three measures)
lab results      <- customer (AGE = c_acctbal, SOURCE = c_mktsegment, SEX = c_nationkey);
                    lineitem for correlation and the classifier
clinical notes   <- documents; lexicon from the words of benchmark
drug responses   <- part: drug = p_brand, group = p_type, concept = (p_partkey, p_name)
article metadata <- customer / orders for merges, clones, loads
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GOLD_YEAR = 1998
TOP_K = 10
CONCEPTS_PER_RESPONSE = 8
MIN_NOTES = 6

ORDERS_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                 "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")

LAB_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped name counts (CSV header names, ``First Name`` with a space)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.year("l_shipdate").alias("Year"),
                     F.concat(F.lit("name_"), F.col("l_suppkey").cast("string")).alias("First Name"),
                     F.col("l_returnflag").alias("County"), F.col("l_linestatus").alias("Sex"),
                     F.col("l_quantity").cast("int").alias("Count"))


def lab_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lab-style frame: four numeric features, a SEX flag, the TREATMENT target."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *LAB_FEATURES,
                     F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("SEX"),
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("TREATMENT"))


def learning_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lab frame with a target that its features determine (a unit price above 2,000), so that what a
    classifier has learned shows on rows it has not seen."""
    return lab_frame(spark, sf_dir).withColumn("TREATMENT", F.when(F.col("l_extendedprice") > 2000 * F.col("l_quantity"), 1).otherwise(0))


def concept_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand", "p_type", "p_partkey", "p_name")


def brand_frequency(spark: SparkSession, sf_dir: str, min_lines: int = MIN_NOTES) -> DataFrame:
    """Drugs to code: brands with their number of order lines, kept when >= min.

    Lines are counted per part first (partial aggregation map-side, so a hot
    part costs nothing), the per-part counts — at most one row per part — are
    joined to part and summed per brand.
    """
    per_part = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
                .agg(F.count(F.lit(1)).alias("n")))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return (per_part.join(part, "l_partkey")
            .groupBy(F.col("p_brand").alias("Drug")).agg(F.sum("n").alias("Frequency"))
            .where(F.col("Frequency") >= min_lines))

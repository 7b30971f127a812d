"""Reference SQL (DuckDB dialect) for each registered query, over the driver's
tables registered as views. Column names and types match the Spark results."""

from __future__ import annotations

from carelake.operators.coding import DRUGS_PATH, SERVICE_BASE
from carelake.operators.notes import ENTITY_CLASSES
from carelake.operators.treatment import (GRID_BOOTSTRAP, GRID_MAX_DEPTH, GRID_NUM_TREES, SEED,
                                          TRAIN_RATIO)
from carelake.plans.tables import GOLD_YEAR, LAB_FEATURES, MIN_NOTES, TOP_K

_NAMES = """(SELECT CAST(year(l_shipdate) AS INTEGER) AS Year,
        'name_' || CAST(l_suppkey AS VARCHAR) AS First_Name,
        l_returnflag AS County, l_linestatus AS Sex, CAST(l_quantity AS INTEGER) AS Count
 FROM lineitem)"""

_GOLD = f"""SELECT First_Name, CAST(SUM(Count) AS BIGINT) AS Total_Count
FROM {_NAMES} n WHERE Year = {GOLD_YEAR} GROUP BY First_Name"""


def _money(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


_THREE = f"{_money('l_quantity')} AS quantity, {_money('l_extendedprice')} AS extendedprice, " \
         f"{_money('l_discount')} AS discount"


def _describe(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        for stat, agg in (("count", f"CAST(count({x}) AS DOUBLE)"), ("mean", f"avg({x})"),
                          ("stddev", f"stddev_samp({x})"), ("min", f"min({x})"), ("max", f"max({x})")):
            parts.append(f"SELECT '{c}' AS \"column\", '{stat}' AS stat, round({agg}, 6) AS value FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _describe_wide(table: str, numbers: list[str], texts: list[str]) -> str:
    stats = (("count", "count({})"), ("mean", "avg({})"), ("stddev", "stddev_samp({})"),
             ("min", "min({})"), ("max", "max({})"))

    def of(stat: str, agg: str, c: str) -> str:
        return "CAST(NULL AS VARCHAR)" if c in texts and stat in ("mean", "stddev") else f"CAST({agg.format(c)} AS VARCHAR)"

    return "\nUNION ALL\n".join(
        f"SELECT '{stat}' AS summary, " + ", ".join(f"{of(stat, agg, c)} AS {c}" for c in numbers + texts)
        + f" FROM {table}" for stat, agg in stats)


def _r(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    x, y = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    return f"round(covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0), 6)"


_LAB = """(SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
        CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS SEX,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS TREATMENT FROM lineitem)"""

#: The rows the classifier learns from: a target that the features determine.
_LEARN = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 2000 * l_quantity THEN 1 ELSE 0 END AS TREATMENT FROM lineitem)"""


def _corr_matrix(cols: list[str] = LAB_FEATURES) -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_r(a, b)} AS r FROM {_LAB} t"
             for a in cols for b in cols]
    return "\nUNION ALL\n".join(parts)


def _corr_target() -> str:
    cols = LAB_FEATURES + ["SEX", "TREATMENT"]
    return "SELECT *, CAST(row_number() OVER (ORDER BY r DESC NULLS LAST, feature) AS INTEGER) AS place FROM (" + "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {_r(c, 'TREATMENT')} AS r FROM {_LAB} t" for c in cols) + ") u"


def _scaled() -> str:
    def s(c):
        return (f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.5 "
                f"ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS scaled_{c}")
    return (f"SELECT l_orderkey, l_linenumber, {', '.join(s(c) for c in LAB_FEATURES)}, "
            f"CAST(SEX AS DOUBLE) AS SEX, TREATMENT FROM {_LAB} t")


_CLASSES = "[" + ", ".join(f"'{c}'" for c in ENTITY_CLASSES) + "]"

_TOKEN = "[A-Za-z0-9]+(?:[.][0-9]+[A-Za-z0-9]*)?"

#: Terms and rules span one or two tokens. Pairs win over single tokens; of a run of
#: pairs that overlap in a chain, every second one stays, beginning with the first.
_SPANS = f"""WITH lists AS (
  SELECT [lower(x) FOR x IN regexp_extract_all(text, '{_TOKEN}')] AS t FROM benchmark WHERE text IS NOT NULL),
words AS (
  SELECT unnest(t) AS term FROM lists
  UNION ALL
  SELECT a || ' ' || b FROM (SELECT unnest(t[:-2]) AS a, unnest(t[2:]) AS b FROM lists)
  WHERE length(a) >= 6 AND length(b) >= 6),
lexicon AS MATERIALIZED (
  SELECT DISTINCT term, ({_CLASSES})[length(term) % 7 + 1] AS entity FROM words WHERE length(term) >= 6),
toks AS MATERIALIZED (
  SELECT doc_id, unnest(t) AS a, unnest(t[2:]) AS b, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT doc_id, [lower(x) FOR x IN regexp_extract_all(text, '{_TOKEN}')] AS t FROM documents WHERE text IS NOT NULL) d),
two AS MATERIALIZED (
  SELECT doc_id, pos, a || ' ' || b AS chunk, coalesce(entity, 'DURATION') AS entity
  FROM toks LEFT JOIN lexicon ON a || ' ' || b = term
  WHERE b IS NOT NULL AND (entity IS NOT NULL OR regexp_full_match(a || ' ' || b, '[0-9]+ [0-9]+'))),
chains AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS chain FROM two),
pairs AS MATERIALIZED (
  SELECT doc_id, pos, chunk, entity FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, chain ORDER BY pos) AS r FROM chains) WHERE r % 2 = 1),
one AS (
  SELECT doc_id, pos, a AS chunk, coalesce(entity, 'STRENGTH') AS entity FROM toks LEFT JOIN lexicon ON a = term
  WHERE entity IS NOT NULL OR regexp_full_match(a, '[0-9]+([.][0-9]+)?[a-z]*')),
taken AS (SELECT doc_id, pos FROM pairs UNION ALL SELECT doc_id, pos + 1 FROM pairs),
spans AS (
  SELECT doc_id, chunk, entity, CAST(pos AS INTEGER) AS start, CAST(pos + 2 AS INTEGER) AS "end" FROM pairs
  UNION ALL
  SELECT doc_id, chunk, entity, CAST(pos AS INTEGER), CAST(pos + 1 AS INTEGER) FROM one ANTI JOIN taken USING (doc_id, pos)),
note_entities AS (
  SELECT doc_id, chunk, max_by(entity, start) AS entity, min(start) AS first_start
  FROM spans GROUP BY doc_id, chunk)
"""

_SPAN_ROWS = 'SELECT doc_id, chunk, entity, start AS first_token, "end" AS after_token FROM spans'

#: train / test by the md5 of seed and key.
_SPLIT = f"""CASE WHEN ('0x' || substr(md5('{SEED}|' || l_orderkey || '|' || l_linenumber), 1, 8))::BIGINT / 4294967296.0
  < {TRAIN_RATIO} THEN 'train' ELSE 'test' END"""

_CONCEPTS = "SELECT p_brand AS Drug, CAST(p_partkey AS VARCHAR) AS RxCUI, p_name AS Concept FROM part"

_BRANDS = f"""(SELECT p_brand AS Drug, CAST(count(*) AS BIGINT) AS Frequency
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand HAVING count(*) >= {MIN_NOTES})"""

_DUCK_TO_SPARK = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE lower(column_type) END"""

_CUSTOMER_PLUS_PARTIAL = """SELECT * FROM customer UNION ALL
SELECT CAST(-1 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR)"""

_EVOLVED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""

ORACLE: dict[str, str] = {
    "gold_top10": f"{_GOLD} ORDER BY Total_Count DESC, First_Name LIMIT {TOP_K}",
    "gold": f"{_GOLD} ORDER BY Total_Count DESC, First_Name",
    "silver": f"SELECT Year AS Year_Of_Birth, First_Name, Count FROM {_NAMES} n",
    "bronze_py": f"SELECT * FROM {_NAMES} n",
    "bronze_sql": f"SELECT * FROM {_NAMES} n",
    "medallion_run": f"{_GOLD} ORDER BY Total_Count DESC, First_Name",
    "sum_by_key": f"SELECT o_orderpriority, {_money('o_totalprice')} AS total_price FROM orders GROUP BY o_orderpriority",
    "sum_by_month_key": f"""SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority,
  {_money('o_totalprice')} AS total_price FROM orders WHERE o_totalprice IS NOT NULL
  GROUP BY period, o_orderpriority""",
    "monthly_sums": f"""SELECT strftime(l_shipdate, '%Y-%m') AS period, {_THREE}
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY period ORDER BY period""",
    "sum_in_list": f"SELECT l_returnflag, {_THREE} FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_returnflag",
    "filter_eq": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "date_range": "SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders",
    "avg_by_key": "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean_acctbal FROM customer GROUP BY c_mktsegment",
    "count_by_key": "SELECT c_nationkey, count(c_mktsegment) AS n_segment FROM customer GROUP BY c_nationkey",
    "mean_min_max": """SELECT round(avg(c_acctbal), 6) AS mean_c_acctbal, min(c_acctbal) AS min_c_acctbal,
  max(c_acctbal) AS max_c_acctbal FROM customer""",
    "describe_stats": _describe("customer", ["c_custkey", "c_nationkey", "c_acctbal"]),
    "describe_summary": _describe_wide("customer", ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"]),
    "row_count": "SELECT count(*) AS n FROM customer LIMIT 5",
    "limit_n": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    "encode_flags": """SELECT c_custkey, c_name, c_acctbal,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS TREATMENT,
  CASE WHEN c_nationkey = 2 THEN 1 ELSE 0 END AS SEX FROM customer""",
    "lenient_cast": """SELECT *, TRY_CAST(c_mktsegment AS INTEGER) AS TREATMENT,
  TRY_CAST(substr(c_name, 10, 64) AS INTEGER) AS SEX_ FROM customer""",
    "corr_matrix": _corr_matrix(),
    "corr_matrix_wide": _corr_matrix(LAB_FEATURES + ["SEX"]),
    "corr_target": _corr_target(),
    "scaled_features": _scaled(),
    "scan_notes": "SELECT doc_id, text FROM documents",
    "read_packed_notes": "SELECT doc_id, text FROM documents",
    "entity_spans": _SPANS + _SPAN_ROWS,
    "entity_udf": _SPANS + _SPAN_ROWS,
    "note_entities": _SPANS + "SELECT * FROM note_entities",
    "entity_doc_freq": _SPANS + f"""SELECT Drug, Frequency,
  CAST(row_number() OVER (ORDER BY Frequency DESC, first_note, first_start) AS INTEGER) AS place
  FROM (SELECT chunk AS Drug, count(*) AS Frequency, min(doc_id) AS first_note, min_by(first_start, doc_id) AS first_start
        FROM note_entities WHERE entity = 'DRUG' GROUP BY chunk HAVING count(*) >= {MIN_NOTES})""",
    "rxnorm_rejects": """SELECT 'part ' || p_partkey AS drug, CASE p_partkey % 7 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no group'
  WHEN 2 THEN 'no concept' ELSE 'missing' END AS reason FROM part WHERE p_partkey % 7 < 4""",
    "failed_update": f"SELECT Year AS Year_Of_Birth, First_Name, Count FROM {_NAMES} n",
    "malformed_file": f"SELECT * FROM {_NAMES} n",
    "bucketed_join": "SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "clone_then_merge": _CUSTOMER_PLUS_PARTIAL,
    "recreate_database": "SELECT * FROM customer",
    "empty_table": "SELECT * FROM orders",
    "table_detail": """SELECT count(*) AS n_rows, true AS all_files_listed, true AS has_size, true AS has_time FROM orders""",
    "train_split": f"SELECT l_orderkey, l_linenumber, TREATMENT, {_SPLIT} AS split FROM {_LAB} t",
    "rf_grid": f"""SELECT b AS bootstrap, CAST(d AS INTEGER) AS max_depth, CAST(n AS INTEGER) AS num_trees, 'areaUnderROC' AS metric,
  true AS is_area, CAST(1 AS INTEGER) AS n_best, true AS best_is_highest, true AS scores_differ
  FROM (SELECT unnest({str(GRID_BOOTSTRAP).lower()}) AS b) CROSS JOIN (SELECT unnest({GRID_MAX_DEPTH}) AS d)
  CROSS JOIN (SELECT unnest({GRID_NUM_TREES}) AS n)""",
    "rf_predictions": f"""SELECT l_orderkey, l_linenumber, TREATMENT, {_SPLIT} AS split, true AS is_class, true AS is_probability,
  true AS agrees, true AS adds_up, true AS separates FROM {_LEARN} t""",
    "rf_metrics": f"""SELECT split, CAST(count_if(TREATMENT = 1) AS BIGINT) AS positives, CAST(count_if(TREATMENT = 0) AS BIGINT) AS negatives,
  true AS above_chance, true AS is_area, true AS adds_up
  FROM (SELECT {_SPLIT} AS split, TREATMENT FROM {_LEARN} t) GROUP BY split""",
    "auc_rank_sum": f"""WITH counted AS (
  SELECT split, score, count_if(TREATMENT = 1) AS pos, count_if(TREATMENT = 0) AS neg
  FROM (SELECT {_SPLIT} AS split, TREATMENT, l_quantity * (1 - l_discount) AS score FROM {_LAB} t) GROUP BY split, score),
below AS (SELECT *, sum(neg) OVER (PARTITION BY split ORDER BY score) AS upto FROM counted)
SELECT split, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  CAST(sum(pos * (2 * upto - neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS auc
FROM below GROUP BY split""",
    "rxnorm_parse": _CONCEPTS,
    "rxnorm_inferred": "SELECT p_brand AS Drug, CAST(p_partkey AS VARCHAR) AS RxCUI, p_name AS Concept, CAST(p_size AS VARCHAR) AS size FROM part",
    "json_roundtrip": _CONCEPTS,
    "request_url": f"SELECT Drug, '{SERVICE_BASE}{DRUGS_PATH}' || url_encode(Drug) AS request_url FROM {_BRANDS} b",
    "rxnorm_code": f"""SELECT b.Drug, b.Frequency, CAST(p_partkey AS VARCHAR) AS RxCUI, p_name AS Concept
  FROM {_BRANDS} b JOIN part ON p_brand = b.Drug""",
    "merge_insert_only": "SELECT * FROM customer",
    "merge_prefiltered": "SELECT * FROM customer",
    "insert_partial": _CUSTOMER_PLUS_PARTIAL,
    "snapshot_clone": "SELECT * FROM customer",
    "schema_evolution_load": _EVOLVED,
    "schema_evolution": _EVOLVED,
    "union_all": "SELECT * FROM customer",
    "incremental_load": "SELECT * FROM orders",
    "scan_csv": "SELECT * FROM orders",
    "scan_parquet": "SELECT * FROM orders",
    "overwrite_roundtrip": "SELECT * FROM orders",
    "managed_table": "SELECT * FROM orders",
    "external_table": "SELECT * FROM orders",
    "path_table": "SELECT * FROM orders",
    "expect_report": """SELECT 'key_present' AS rule,
  CAST(count_if(coalesce(o_orderkey IS NOT NULL, false)) AS BIGINT) AS passed,
  CAST(count_if(NOT coalesce(o_orderkey IS NOT NULL, false)) AS BIGINT) AS failed FROM orders
UNION ALL
SELECT 'large_order' AS rule, CAST(count_if(coalesce(o_totalprice > 100000, false)) AS BIGINT) AS passed,
  CAST(count_if(NOT coalesce(o_totalprice > 100000, false)) AS BIGINT) AS failed FROM orders""",
    "describe_schema": f"SELECT column_name AS col_name, {_DUCK_TO_SPARK} AS data_type FROM (DESCRIBE orders)",
}

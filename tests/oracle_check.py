"""Run registered queries against their DuckDB oracle and compare.

usage: python -m tests.oracle_check [--plain] [sf_dir] [key ...]

``--plain`` runs in a default SparkSession (as an outside caller would) instead
of one made by ``carelake.session.build_session``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "boolean": "BOOLEAN",
                 "date": "DATE", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, con, sql: str) -> list:
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got != want:
            out.append((f.name, f.dataType.simpleString(), got))
    return out


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    got = sdf.toPandas()
    t1 = time.time()
    out = {"key": key, "rows": len(got), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    want = con.execute(sql).df()
    out["oracle_rows"] = len(want)
    if sorted(got.columns) != sorted(want.columns):
        out["status"] = f"COLUMNS {sorted(got.columns)} vs {sorted(want.columns)}"
        return out
    a, b = canon(got), canon(want)
    if len(a) != len(b):
        out["status"] = "ROWCOUNT"
        return out
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    out["status"] = "ok" if not bad else f"VALUES {len(bad)} differ, e.g. {bad[:2]}"
    types = type_mismatches(sdf, con, sql)
    if types:
        out["types"] = types
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from carelake.session import build_session
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    if plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    fails = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        fails += r["status"] not in ("ok", "rows-only") or bool(r.get("types"))
        print(r, flush=True)
    print("failures:", fails)
    return 1 if fails else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))

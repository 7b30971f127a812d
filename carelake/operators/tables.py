"""Table operations on open-source Spark with Parquet tables.

Covers: overwrite and managed-table sinks, external and path-addressed tables,
tables created from an explicit schema, partial-row inserts, snapshot clones,
insert-only merges, schema evolution, storage detail, schema description, and
publishing a new table version only after its job succeeded.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake.operators.joins import stored
from carelake.sources.files import list_files


MAX_BUCKETS = 100_000  # Spark's own limit of buckets


def qname(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the data at ``path``. Never point this at a path the same plan reads."""
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def save_table(df: DataFrame, name: str, mode: str = "errorifexists",
               bucket_by: tuple[int, list[str]] | None = None) -> DataFrame:
    """Managed table sink. The default mode refuses to replace an existing table.

    ``bucket_by=(n, keys)`` stores the rows hash-bucketed (and sorted) by
    ``keys``: later joins on those keys read the table already co-partitioned,
    so only the other side is shuffled. Choose ``n`` from the table's size
    (``bucket_count``). Rows are clustered first, so a write makes one file per
    bucket, not one per task and bucket.
    """
    if bucket_by:
        n, keys = bucket_by
        w = df.repartition(n, *keys).write.format("parquet").mode(mode).bucketBy(n, *keys).sortBy(*keys)
    else:
        w = df.write.format("parquet").mode(mode)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def bucket_count(df: DataFrame, bytes_per_bucket: int = 256 * 1024 * 1024) -> int:
    """Buckets for a table of this many bytes: of the files it is read from where the plan is a
    scan, else the planner's estimate (no row is read; a poor estimate costs file sizes, not results)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, -(-min(size, MAX_BUCKETS * bytes_per_bucket) // bytes_per_bucket))


def scratch_database(spark: SparkSession, location: str, prefix: str = "carelake") -> str:
    """A fresh database whose managed tables live under ``location``."""
    db = f"{prefix}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")
    return db


def recreate_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``DROP DATABASE … CASCADE`` then ``CREATE DATABASE``, then ``USE``."""
    spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")
    spark.sql(f"USE `{db}`")


def create_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS name USING fmt LOCATION path``: a catalog entry
    over files that already exist."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qname(name)} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Query files by path, no catalog entry: ``SELECT * FROM parquet.`path```."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def create_empty(spark: SparkSession, name: str, schema: StructType | str) -> DataFrame:
    """A managed table with a declared schema and no rows."""
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def insert_partial(spark: SparkSession, name: str, values: dict) -> None:
    """Insert one row that sets only some columns; the rest are NULL."""
    target = spark.table(name)
    row = spark.range(1).select(*[
        (F.lit(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields])
    row.write.insertInto(name)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append rows to a table, matching columns by name (missing ones NULL)."""
    target_cols = df.sparkSession.table(name).schema
    df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in target_cols.fields]).write.insertInto(name)


# --- versioned tables, clones -----------------------------------------------------------
#
# A versioned table is a list of segments (folder, names of its batches): every write puts
# its rows into a folder of its own, ``batch=b<number>-<random>``, and the table's name is a view over the
# batches of the list, which stands in the view's properties. A write becomes visible in one
# catalog operation. A shallow clone copies the list (one short name per write, whatever
# the table's size) and adds a folder of its own, which takes what is written to the
# clone; the source's later batches are not in its list.
#
# Writers share no folder, so none overwrites another's rows. Before the name is pointed the list
# is read again: batches that came in between are kept (appends commute), and a write that must
# see all rows of the table, a merge, is refused. What is left is the moment between that
# look and the catalog operation; the catalog has no compare-and-swap.

_SEGMENTS = "carelake.segments"


class ConcurrentWrite(RuntimeError):
    """The table has changed since the write that is refused looked at it."""


def _segments(spark: SparkSession, name: str) -> list[list]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {qname(name)}").where(F.col("key") == _SEGMENTS).collect()
    if not rows:
        raise ValueError(f"{name} is not a versioned table")
    return json.loads(rows[0]["value"])


def _point_versioned(spark: SparkSession, name: str, segments: list[list], columns: list[str]) -> DataFrame:
    cols = ", ".join(f"`{c}`" for c in columns)
    body = " UNION ALL ".join("SELECT {} FROM parquet.`{}` WHERE batch IN ({})".format(cols, path, ", ".join(f"'{b}'" for b in batches))
                              for path, batches in segments if batches)
    value = json.dumps(segments).replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {qname(name)} TBLPROPERTIES ('{_SEGMENTS}' = '{value}') AS {body}")
    return spark.table(name)


def _new_batch(segments: list[list]) -> str:
    return f"b{sum(len(b) for _, b in segments)}-{uuid.uuid4().hex[:8]}"


def create_versioned(df: DataFrame, name: str, path: str) -> DataFrame:
    """A table ``name`` whose data lies under ``path``, one folder per write."""
    if "batch" in df.columns:
        raise ValueError("batch is the name of the version column")
    batch = _new_batch([])
    df.write.parquet(f"{path}/batch={batch}")
    return _point_versioned(df.sparkSession, name, [[path, [batch]]], df.columns)


def append_versioned(df: DataFrame, name: str, seen: list[list] | None = None) -> DataFrame:
    """Append rows by column name (missing columns NULL) as the table's next batch.

    Batches that other writers add meanwhile are kept. With ``seen`` (the list the rows were made
    from, ``versions``) the append raises ``ConcurrentWrite`` instead if there are any; its rows stay
    invisible.
    """
    spark = df.sparkSession
    segments, target = _segments(spark, name), spark.table(name)
    path, batch = segments[-1][0], _new_batch(segments)
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in target.schema.fields])
    rows.write.parquet(f"{path}/batch={batch}")
    now = _segments(spark, name)
    if seen is not None and now != seen:
        raise ConcurrentWrite(f"{name} has been written to since it was read")
    if now[-1][0] != path:
        raise ConcurrentWrite(f"{name} has been replaced since the write began")
    return _point_versioned(spark, name, now[:-1] + [[path, now[-1][1] + [batch]]], target.columns)


def versions(spark: SparkSession, name: str) -> list[list]:
    """The batches that versioned table ``name`` shows: ``[[folder, [batch, ...]], ...]``."""
    return _segments(spark, name)


def snapshot_clone(spark: SparkSession, source: str, name: str, path: str, deep: bool = False) -> DataFrame:
    """Freeze versioned table ``source`` as table ``name``, which can be written to on its own.

    shallow: the clone reads the source's batches up to now (no data copy; later
    writes to the source are not seen). deep: the rows are copied under ``path``. A
    clone of the same name is replaced; ``path`` must be a new folder then.
    """
    table = spark.table(source)
    if deep:
        return create_versioned(table, name, path)
    return _point_versioned(spark, name, [s for s in _segments(spark, source) if s[1]] + [[path, []]], table.columns)


# --- merge -------------------------------------------------------------------------------

BLOOM_BITS = 16  # bits per target key; three of them set: about 0.5 % of new keys look known
MAX_BLOOM_BYTES = 64 * 1024 * 1024  # of the filter, which is broadcast
_BLOCK_BITS = 32 * 1024  # of one row of the filter: the bits of a key lie in one block


def _bloom_bits(on: list[str], blocks: int) -> tuple[Column, Column]:
    """(block of a key, its three bits within the block)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in on])
    g = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in on])
    bits = [F.pmod(F.shiftright(g, 15 * i), F.lit(_BLOCK_BITS)) for i in range(3)]
    return F.pmod(h, F.lit(blocks)), F.array(*bits)


def bloom_filter(keys: DataFrame, on: list[str], n: int) -> DataFrame:
    """A Bloom filter of the distinct keys as rows ``(__block, __bits)`` of 4 KB each, ``n`` keys sized at
    ``BLOOM_BITS`` bits; the bits are set map-side and merged per block."""
    blocks = max(1, -(-n * BLOOM_BITS // _BLOCK_BITS))
    block, bits = _bloom_bits(on, blocks)
    return (keys.select(block.alias("__block"), F.explode(bits).alias("__bit"))
            .groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__bits")))


def _may_be_known(on: list[str], blocks: int) -> Column:
    """Whether all three bits of a row's key are set in ``__bits`` (a missing block: no)."""
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("__bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.expr("1").cast("int").bitwiseAND(F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int"))) == 1

    return F.coalesce(F.forall(_bloom_bits(on, blocks)[1], is_set), F.lit(False))


def new_rows(target: DataFrame, source: DataFrame, on: list[str], prefilter: bool = False) -> DataFrame:
    """Rows of ``source`` whose key has no match in ``target``.

    An anti join of two shuffled sides: when one source key holds a large share of
    the rows, the adaptive skew-join rule splits its partition (nothing may stand
    between the exchanges and the join for that, so keys are not made distinct
    first). NULL keys never match, so they are new; duplicate new keys are all kept.

    ``prefilter``: source rows that a Bloom filter of the target's keys rules out are surely new and
    are not shuffled; only the rest is joined (the source is read twice for it). The filter is broadcast: a target
    whose filter would take more than ``MAX_BLOOM_BYTES`` is joined without one. Worth its pass over the
    target's keys when most of the source is new.
    """
    keys = target.select(*on)
    n = keys.count() if prefilter else 0  # from file metadata
    if not n or n * BLOOM_BITS > 8 * MAX_BLOOM_BYTES:
        return source.join(keys, on, "left_anti")
    blocks = max(1, -(-n * BLOOM_BITS // _BLOCK_BITS))
    bloom = stored(bloom_filter(keys, on, n))  # at most ``blocks`` rows of 4 KB
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(f"`{c}`").isNull()
    held = (source.withColumn("__block", _bloom_bits(on, blocks)[0]).join(F.broadcast(bloom), "__block", "left")
            .withColumn("__known", ~missing & _may_be_known(on, blocks)))
    surely_new = held.where(~F.col("__known")).select(*[f"`{c}`" for c in source.columns])
    rest = held.where("__known").select(*[f"`{c}`" for c in source.columns])
    return surely_new.unionAll(rest.join(keys, on, "left_anti").select(*[f"`{c}`" for c in source.columns]))


def merge_insert_only(spark: SparkSession, target_name: str, source: DataFrame, on: list[str] | str, prefilter: bool = False) -> int:
    """``MERGE INTO t USING s ON key WHEN NOT MATCHED THEN INSERT *``.

    Appends the unmatched rows to the target: a managed table, or a versioned
    table (a clone, for example), whose next batch they become; a batch that another writer adds to it
    meanwhile could hold the same keys, so the merge raises ``ConcurrentWrite`` then. Appending next to
    files the same plan reads is safe: the input file list is fixed when the plan
    is made, and the new files are committed at the end of the job. Returns the
    number of rows inserted (counted while writing, no extra pass). ``prefilter`` as in ``new_rows``.
    """
    on = [on] if isinstance(on, str) else list(on)
    versioned = _is_versioned(spark, target_name)
    seen = versions(spark, target_name) if versioned else None
    target = spark.table(target_name)
    obs = Observation("merge")
    ins = new_rows(target, source, on, prefilter).observe(obs, F.count(F.lit(1)).alias("n"))
    if versioned:
        append_versioned(ins, target_name, seen)
    else:
        append_by_name(ins, target_name)
    return int(obs.get["n"])


def _is_versioned(spark: SparkSession, name: str) -> bool:
    return bool(spark.sql(f"SHOW TBLPROPERTIES {qname(name)}").where(F.col("key") == _SEGMENTS).count())


# --- schema evolution ----------------------------------------------------------------

def union_evolving(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing from a part come back NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet folders written with growing schemas, read as one table."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


# --- metadata ----------------------------------------------------------------------------

def table_detail(spark: SparkSession, path: str) -> DataFrame:
    """Storage detail of a Parquet table folder: number of data files, total bytes,
    last modification time."""
    return (list_files(spark, path, "*.parquet")
            .agg(F.count(F.lit(1)).alias("num_files"),
                 F.sum("length").alias("size_in_bytes"),
                 F.max("modificationTime").alias("last_modified")))


def describe_schema(df: DataFrame) -> DataFrame:
    """``DESCRIBE``: one row per column ``(col_name, data_type)``."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "col_name string, data_type string")


def nothing_there(e: AnalysisException) -> bool:
    """Whether a read failed only because no data file has been written yet."""
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or str(e).startswith("Unable to infer schema")


# --- publish a new version only on success -------------------------------------------

def point_name(spark: SparkSession, name: str, path: str, comment: str | None = None,
               fmt: str = "parquet", schema: StructType | None = None) -> None:
    """Make ``name`` show the files at ``path``, in one catalog operation.

    ``CREATE OR REPLACE VIEW`` swaps atomically: a reader sees the old version or
    the new one, never no table. Year folders (``k=v/``) are discovered from the
    path, so partition pruning needs no partition metadata in the catalog.
    """
    c = f" COMMENT '{comment.replace(chr(39), chr(39) * 2)}'" if comment else ""
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {qname(name)}{c} AS SELECT * FROM {fmt}.`{path}`")
    except AnalysisException as e:
        if schema is None or not nothing_there(e):
            raise
        # An empty version has no data file to read a schema from: same columns, no rows.
        cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        spark.sql(f"CREATE OR REPLACE VIEW {qname(name)}{c} AS SELECT {cols} WHERE 1 = 0")


def publish(df: DataFrame, name: str, base_path: str, comment: str | None = None,
            partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a new version folder, then point ``name`` at it.

    If the write fails (for example a ``fail`` expectation raises inside the
    plan), ``name`` keeps showing the previous version: readers never see a
    half written or rejected update.
    """
    spark = df.sparkSession
    version = f"{base_path}/v-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version)
    point_name(spark, name, version, comment, schema=df.schema)
    return spark.table(name)


def drop_old_versions(spark: SparkSession, base_path: str, name: str, keep: int = 3) -> int:
    """Delete all but the newest ``keep`` versions ``publish`` made under ``base_path``,
    never the one ``name`` shows. Returns how many went."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base_path}/v-*")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(fs.globStatus(path) or [], key=lambda f: -f.getModificationTime())
    text = spark.sql(f"SHOW CREATE TABLE {qname(name)}").first()[0]
    old = [f.getPath() for f in found[keep:] if f.getPath().getName() not in text]
    for p in old:
        fs.delete(p, True)
    return len(old)

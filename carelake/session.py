"""Session construction and shared scratch space.

Jobs that materialise intermediate tables (CSV landing zones, stream checkpoints,
table versions) write them under the cluster's shared checkpoint folder: the
session's ``spark.checkpoint.dir``, or the folder its caller set as checkpoint
directory. Only a local session that has neither gets a fresh temporary folder; on a
cluster a missing folder is an error, as executors could not read the driver's disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "carelake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session tuned for the jobs in this library.

    The master is set only when it is given here or in ``CARELAKE_MASTER`` (a master
    set in code wins over ``spark-submit --master``); shuffle partitions and
    memory likewise stay as submitted unless asked for. AQE stays on: it coalesces
    small shuffle partitions, splits skewed join partitions and turns
    sort-merge joins into broadcast joins when the runtime size of a side is
    measured to be small.
    """
    master = master or os.environ.get("CARELAKE_MASTER")
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         # Post-shuffle partitions of about 128 MB and scan splits of 128 MB keep
         # every task's working set well inside an executor's memory.
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
         .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # No broadcast from planner estimates (compressed file sizes can be far
         # below in-memory sizes). A side is broadcast only when its size is
         # proven: counted and measured against a bound (operators.joins.join_small),
         # or measured after it materialised (adaptive threshold below).
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Batches handed to Python (the model hook) are cut by bytes as well as
         # rows, so a batch of very long notes stays bounded in worker memory.
         .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
         .config("spark.sql.parquet.filterPushdown", "true")
         # Checkpoints whose frames are no longer in use are deleted while the job goes on.
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions or (shuffle_partitions := os.environ.get("CARELAKE_SHUFFLE_PARTITIONS")):
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory := os.environ.get("CARELAKE_DRIVER_MEM"):
        b = b.config("spark.driver.memory", memory)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables: what the caller set as
    checkpoint directory, else the session's ``spark.checkpoint.dir``."""
    def plain(path: str) -> str:
        return path.removeprefix("file://").removeprefix("file:").rstrip("/")

    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    now = sc.getCheckpointDir()  # under root (Spark starts with that), or set by the caller or here before
    if now and not (root and plain(now).startswith(plain(root))):
        return now.rstrip("/")
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="carelake-ckpt-")
    if now is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root.

    Every call returns a fresh path, so a query that is run twice never reads
    or overwrites the files of an earlier run.
    """
    path = f"{checkpoint_root(spark)}/carelake/{name}-{uuid.uuid4().hex[:12]}"
    scratch_made(spark).append(path)
    return path


def scratch_made(spark: SparkSession) -> list[str]:
    """The scratch folders this application has asked for, in order."""
    return spark.sparkContext.__dict__.setdefault("_carelake_scratch", [])


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete these scratch folders; others under the same root may belong to other applications."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clean_scratch(spark: SparkSession, name: str | None = None) -> bool:
    """Delete the scratch folders under the checkpoint root (those of ``name``, or all).

    For the end of a job: results read from scratch folders are gone afterwards.
    """
    jvm, root = spark._jvm, f"{checkpoint_root(spark)}/carelake"
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if name is None:
        return fs.delete(path, True)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}-*")) or []
    return any([fs.delete(f.getPath(), True) for f in found])


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source (once per application).

    Functions that run in Python tasks are pickled by reference, so the workers
    must be able to import ``carelake``. The source goes out as a zip through
    Spark's own file distribution; it is written in the driver's temporary
    folder, which only the driver reads.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_carelake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="carelake-", suffix=".zip")
    with os.fdopen(fd, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("carelake", os.path.relpath(p, root)))
    sc.addPyFile(os.path.realpath(path))
    sc._carelake_shipped = True

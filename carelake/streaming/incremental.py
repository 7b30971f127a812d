"""Incremental, idempotent file loads (the ``COPY INTO`` pattern).

A file-source stream with the ``availableNow`` trigger processes every file
that arrived since the last run and then stops. The checkpoint records which
files were taken and the Parquet file sink commits each batch in its own
metadata log, so a re-run adds nothing, a new file is loaded exactly once, and a
run that dies half way (lost executors, lost driver) resumes without
duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


KEPT_REPORTS = 1000  # progress reports Spark keeps between two looks at them
LOOK_SECONDS = 0.25


@dataclass
class RunTotals:
    """What one run has done, added up batch by batch (no report is kept): input rows, micro-batches
    and, per observed set of metrics, the sum of each metric."""
    rows: int = 0
    batches: int = 0
    observed: dict[str, dict[str, int]] = field(default_factory=dict)
    _last: int | None = None

    def add(self, reports: list) -> None:
        """Take in the reports of batches not seen yet (they come in order)."""
        for p in reports:
            n = p["batchId"]
            if self._last is not None and n <= self._last:
                continue
            if self._last is not None and n != self._last + 1:
                raise RuntimeError(f"reports of batches {self._last + 1} to {n - 1} are gone: the rows are loaded, their number is unknown")
            self._last = n
            self.rows += int(p["numInputRows"])
            self.batches += 1
            for name, metrics in (p["observedMetrics"] or {}).items():
                sums = self.observed.setdefault(name, {})
                for k, v in metrics.asDict().items():
                    sums[k] = sums.get(k, 0) + int(v or 0)


def run_available_now(stream: DataFrame, target_dir: str, checkpoint_dir: str, partition_by: list[str] | None = None,
                      kept_reports: int = KEPT_REPORTS) -> RunTotals:
    """Write every not-yet-processed input of ``stream`` into a Parquet sink and stop; returns the
    totals of this run's micro-batches, however many there are.

    Spark keeps the last ``kept_reports`` progress reports; they are added up while the query
    runs, and a batch whose report was missed raises instead of being left out.
    """
    spark = stream.sparkSession
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    spark.conf.set(key, str(kept_reports))  # the stream copies the session conf when it starts, so it is restored after
    try:
        w = (stream.writeStream.format("parquet").option("path", target_dir)
             .option("checkpointLocation", checkpoint_dir).outputMode("append"))
        if partition_by:
            w = w.partitionBy(*partition_by)
        q = w.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, old)
    totals, done, wait = RunTotals(), False, LOOK_SECONDS if kept_reports >= KEPT_REPORTS else 0.01
    while not done:
        done = q.awaitTermination(wait)  # raises what stopped the query
        totals.add(q.recentProgress)
    return totals


def incremental_load(spark: SparkSession, source_dir: str, schema: StructType | str, target_dir: str,
                     checkpoint_dir: str, fmt: str = "csv", options: dict[str, str] | None = None,
                     transform=None, max_files_per_trigger: int | None = None) -> int:
    """Load the files of ``source_dir`` not loaded before into ``target_dir``.

    Returns the number of rows added by this run. ``transform`` (optional) maps
    the raw stream before it is written, e.g. a rename or projection.

    Schema evolution: when new files carry an extra column, run again with the
    widened ``schema`` on the same checkpoint; ``read_loaded`` merges the
    schemas, so rows loaded earlier show NULL in the new column.
    """
    opts = {"header": "true", "mode": "FAILFAST"} if fmt == "csv" else {}
    opts.update(options or {})
    reader = spark.readStream.format(fmt).schema(schema).options(**opts)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)
    return run_available_now(stream, target_dir, checkpoint_dir).rows


def start_continuous_load(spark: SparkSession, source_dir: str, schema: StructType | str, target_dir: str,
                          checkpoint_dir: str, every: str = "1 minute", fmt: str = "csv",
                          options: dict[str, str] | None = None, transform=None) -> StreamingQuery:
    """The same load as ``incremental_load``, kept running: new files are picked
    up every ``every``. Returns the running query (``stop()`` ends it); the
    checkpoint makes a restart continue where it stopped."""
    opts = {"header": "true", "mode": "FAILFAST"} if fmt == "csv" else {}
    opts.update(options or {})
    stream = spark.readStream.format(fmt).schema(schema).options(**opts).load(source_dir)
    if transform is not None:
        stream = transform(stream)
    return (stream.writeStream.format("parquet").option("path", target_dir)
            .option("checkpointLocation", checkpoint_dir).outputMode("append")
            .trigger(processingTime=every).start())


def read_loaded(spark: SparkSession, target_dir: str) -> DataFrame:
    """The loaded table. Reading through the sink's metadata log shows only
    committed batches; schemas of batches loaded with a widened schema merge."""
    return spark.read.option("mergeSchema", "true").parquet(target_dir)

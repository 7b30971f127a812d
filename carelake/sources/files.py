"""File scans: CSV, Parquet, whole-text notes and folder listings."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV scan. With a schema there is no inference pass over the files;
    without one the schema is inferred (an extra full read, as in the notebooks).
    ``mode="FAILFAST"`` raises on the first malformed record."""
    r = (spark.read.format("csv").option("header", str(header).lower())
         .option("sep", sep).option("mode", mode))
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", "true")
    return r.load(path)


def scan_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Parquet scan; optionally registered as a temporary view. Object-store
    credentials are session configuration supplied by the caller."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def blob_uri(container: str, account: str, path: str) -> str:
    """Address of a file in an Azure blob container (``wasbs://``)."""
    return f"wasbs://{container}@{account}.blob.core.windows.net/{path.lstrip('/')}"


def set_blob_sas(spark: SparkSession, container: str, account: str, token: str) -> None:
    """Give the session read access to one container with a shared-access token
    (the token is session configuration, never part of a path or a table)."""
    spark.conf.set(f"fs.azure.sas.{container}.{account}.blob.core.windows.net", token)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").option("sep", sep).csv(path)
    return path


def scan_notes(spark: SparkSession, path: str, keep_empty: bool = True) -> DataFrame:
    """One row per file: ``(path, note_id, text)``, the whole file as one value.

    Files are found at any depth; ``note_id`` is the file's name without its last
    extension, as text (``007.txt`` is note ``007``). No folder names are read as
    columns, so nothing is inferred from them. Each file is one task input. Spark's file scan skips
    zero-length files; with ``keep_empty`` they are the files of its listing that the
    scan does not have, and come back with an empty text (file names only; the listing lies
    on the driver as for any file scan, no file body is read twice). Many small notes belong in packs
    (``write_notes``), which are scanned here as whole files and cut by ``split_notes``.
    """
    def note(c: Column) -> Column:
        return F.regexp_replace(c, r"\.[^.]*$", "")

    scan = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    notes = scan.select(F.col("_metadata.file_path").alias("path"), note(F.col("_metadata.file_name")).alias("note_id"),
                        F.col("value").alias("text"))
    if not keep_empty:
        return notes
    listed = spark.createDataFrame([(f, unquote(f.rsplit("/", 1)[-1])) for f in scan.inputFiles()], "path string, name string")

    def same(c: Column) -> Column:  # one spelling of a local path's scheme
        return F.regexp_replace(c, "^file:/+", "file:/")

    listed = listed.select(same(F.col("path")).alias("path"), "name")
    there = list_files(spark, path).select(same(F.replace(F.col("path"), F.lit(" "), F.lit("%20"))).alias("path"))
    empty = listed.join(there, "path", "left_anti")
    return notes.unionAll(empty.select("path", note(F.col("name")), F.lit("").alias("text")))


# Many small notes are kept in packs: text files, one per task, in which a note is a
# record of its key and text. The two separators are control characters; where a
# text holds one (or the escape itself), it is written as an escape and two digits.
_RECORD, _UNIT, _ESCAPE = "\x1e", "\x1f", "\x1b"
_CODES = [(_ESCAPE, "00"), (_RECORD, "01"), (_UNIT, "02")]


def write_notes(df: DataFrame, path: str, key: str, text: str = "text", max_notes: int | None = None) -> str:
    """Write notes as packs: as many files as ``df`` has tasks, whatever the number of notes, or more
    of at most ``max_notes`` notes each (packs that are scanned as whole files should be bounded).

    Keys are stored as text. NULL texts are stored as missing, empty ones as empty.
    """
    def escaped(c: Column) -> Column:
        for ch, code in _CODES:
            c = F.replace(c, F.lit(ch), F.lit(_ESCAPE + code))
        return c

    record = F.concat(escaped(F.col(key).cast("string")),
                      F.coalesce(F.concat(F.lit(_UNIT), escaped(F.col(text))), F.lit("")))
    w = df.select(record.alias("value")).write.mode("overwrite").option("lineSep", _RECORD)
    (w.option("maxRecordsPerFile", str(max_notes)) if max_notes else w).text(path)
    return path


def _record(value: Column, key: str, key_type: str) -> list[Column]:
    """(key, text) of a record."""
    def plain(c: Column) -> Column:
        for ch, code in reversed(_CODES):
            c = F.replace(c, F.lit(_ESCAPE + code), F.lit(ch))
        return c

    at = F.instr(value, _UNIT)
    return [plain(F.when(at > 0, F.substring_index(value, _UNIT, 1)).otherwise(value)).cast(key_type).alias(key),
            plain(F.when(at > 0, value.substr(at + 1, F.length(value)))).alias("text")]


def read_notes(spark: SparkSession, path: str, key: str, key_type: str = "string") -> DataFrame:
    """``(key, text)`` of the notes ``write_notes`` stored; keys are text unless a type is declared. Records
    are read one by one: packs of any size."""
    df = spark.read.option("lineSep", _RECORD).text(path)
    return df.select(*_record(F.col("value"), key, key_type))


def split_notes(packs: DataFrame, key: str, key_type: str = "string") -> DataFrame:
    """``(key, text)`` of the notes in packs that were scanned as whole files (``scan_notes``)."""
    records = F.split("text", _RECORD)  # every record ends with the separator: nothing follows the last
    return (packs.select(F.explode(F.slice(records, 1, F.size(records) - 1)).alias("value"))
            .select(*_record(F.col("value"), key, key_type)))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Folder listing as a DataFrame ``(path, modificationTime, length)``.

    The binary-file source lists files in parallel; the content column is pruned,
    so no file body is read. Like every Spark file scan it skips zero-length
    files (table data files are never empty).
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", "modificationTime", "length"))

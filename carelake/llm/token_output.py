"""Token-id output: ORC files of token ids in document order, and reading them.

Method: ids go to ORC with integer run-length encoding; every stripe has row
indexes and Bloom filters on the document id, so readers work stripe by stripe in
parallel and skip stripes (and rows within them) by their metadata.

Documents are range-partitioned and sorted by id (ties: by text), so a file holds
one range of ids and its minimum and maximum prune. A writer task knows where its
documents start within its own file; the start over all files adds the totals of
the files before, one row per writer task.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import pretokens, vocab

BLOOM_FPP = 0.01
MEMO_BYTES = 128 << 20  # a miss costs a call of the library: more than the default
BATCH = 2000  # words given to the library in one call
SEPARATOR = "\ue000"  # a private-use character; words that hold it are encoded one by one


class _Library:
    """The tokenizers library on pre-tokens: many in one call, joined by a separator that its pre-tokenizer
    takes out. Tokens tile a pre-token's bytes, so their lengths tell where each one ends."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.plain, self.joined = Tokenizer.from_str(data.decode()), Tokenizer.from_str(data.decode())
        self.joined.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(SEPARATOR, "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        v = vocab.vocabulary(data)
        self.added = v.added
        self.length = np.zeros(v.size, np.int64)
        self.length[list(v.bytes_of)] = [len(b) for b in v.bytes_of.values()]

    def encode(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words laid end to end, number of ids of each)."""
        texts = words.cast(pa.string()).to_pylist()
        out, n = [], np.zeros(len(texts), np.int64)
        for i in range(0, len(texts), BATCH):
            part = texts[i:i + BATCH]
            whole = SEPARATOR.join(part)
            if whole.count(SEPARATOR) == len(part) - 1 and not any(a in whole for a in self.added):
                ids = np.array(self.joined.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.int32)
                ends = np.cumsum(np.asarray(pc.binary_length(words.slice(i, len(part)))).astype(np.int64))
                last = np.searchsorted(np.cumsum(self.length[ids]), ends)
                out.append(ids)
                n[i:i + len(part)] = np.diff(np.concatenate(([-1], last)))
            else:  # a word holds the separator
                lists = [e.ids for e in self.plain.encode_batch_fast(part, add_special_tokens=False)]
                out += [np.array(x, np.int32) for x in lists]
                n[i:i + len(part)] = [len(x) for x in lists]
        return np.concatenate(out), n


def _encoder(data: bytes) -> pretokens.WordMemo:
    def build():
        library = _Library(data)
        return pretokens.WordMemo(library.encode, library.added, limit=MEMO_BYTES)

    return vocab.held(("library", vocab.digest(data)), build)


def own(name: str, key: str) -> str:
    """The name of a column of this module beside a key: an underscore in front if they clash."""
    return "_" + name if name.lower() == key.lower() else name


def write_token_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 0, key: str = "doc_id",
                    text: str = "text", stripe_bytes: int = 64 << 20, compression: str = "snappy") -> str:
    """Write ``(part, <key>, local_start, n_tokens, ids)`` as ORC under ``folder``.

    Every text is encoded as the tokenizers library does without special tokens
    (each distinct pre-token of a worker's memo once, by the library), then ``end_id`` is appended.
    The key's own name wins: written columns it clashes with get an underscore in front. Texts of any length
    are encoded whole. A null or empty text holds the end id alone; null keys come first; rows with equal keys
    are all kept, ordered by text. Other columns are not written.
    """
    data = vocab.broadcast_file(docs.sparkSession, path)
    rows = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    rows = rows.repartitionByRange("__key", F.xxhash64("__text")).sortWithinPartitions("__key", "__text")
    kind = docs.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, part, start = _encoder(data.value), TaskContext.get().partitionId(), 0
        for batch in parts:
            for i, j, values, sizes in pretokens.encoded(memo, batch.column(1)):
                upto = np.cumsum(sizes)
                at = np.concatenate(([0], upto + np.arange(1, len(sizes) + 1)))
                ids = np.insert(values, upto, end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(j - i, part, np.int32)), batch.column(0).slice(i, j - i),
                     pa.array(start + at[:-1]), pa.array(np.diff(at)),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))],
                    names=["part", "k", "local_start", "n_tokens", "ids"])
                start += int(at[-1])

    out = rows.mapInArrow(run, f"part int, k {kind}, local_start bigint, n_tokens bigint, ids array<int>")
    named = out.select(F.col("part").alias(own("part", key)), F.col("k").alias(key),
                       *[F.col(c).alias(own(c, key)) for c in ("local_start", "n_tokens", "ids")])
    (named.write.option("compression", compression)
     .option("orc.bloom.filter.columns", key).option("orc.bloom.filter.fpp", str(BLOOM_FPP))
     .option("orc.create.index", "true").option("orc.stripe.size", str(stripe_bytes)).orc(folder))
    return folder


def read_token_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """The stored rows: ``(part, <key>, local_start, n_tokens, ids)``. Filters on the key
    reach the stripes' metadata."""
    return spark.read.orc(folder)


def part_starts(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(part, part_start)``: ids in all files before; one row per writer task."""
    totals = stored.groupBy(F.col(own("part", key)).alias("part")).agg(F.sum(own("n_tokens", key)).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))


def digests(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Per stored document, from the files: ``<key>, start, n_tokens, ids_crc32`` (see ``own``)."""
    stored = read_token_ids(spark, folder, key)
    part, local_start, ids = (own(c, key) for c in ("part", "local_start", "ids"))
    kind = stored.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column(3)
            at = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=["part", "k", "local_start", "n_tokens", "ids_crc32"])

    crc = (stored.select(F.col(part).alias("part"), F.col(key).alias("k"), F.col(local_start).alias("local_start"),
                         F.col(ids).alias("ids"))
           .mapInArrow(run, f"part int, k {kind}, local_start bigint, n_tokens bigint, ids_crc32 bigint"))
    return (crc.join(part_starts(stored, key), "part")
            .select(F.col("k").alias(key), (F.col("part_start") + F.col("local_start")).alias(own("start", key)),
                    F.col("n_tokens").alias(own("n_tokens", key)), F.col("ids_crc32").alias(own("ids_crc32", key))))

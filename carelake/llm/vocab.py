"""A byte-level BPE vocabulary, read from a tokenizer file on the driver.

The file is a parameter (never copied into the repository). Its bytes are
broadcast to the workers after a check of their size (``MAX_FILE_BYTES``: a
vocabulary has a fixed size, it does not grow with the corpus), and every Python worker
compiles the tables it needs once (``compiled``).
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

from carelake.session import ship_package

MAX_FILE_BYTES = 64 * 1024 * 1024


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_file(path: str | None = None) -> bytes:
    """The tokenizer file's bytes (size checked)."""
    with open(path or default_path(), "rb") as f:
        data = f.read(MAX_FILE_BYTES + 1)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError(f"tokenizer file {path} exceeds {MAX_FILE_BYTES} bytes")
    return data


def broadcast_file(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The tokenizer file's bytes as a broadcast."""
    ship_package(spark)
    return spark.sparkContext.broadcast(read_file(path))


def byte_chars() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for their own
    byte, the other bytes take the code points from 256 upwards in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in set(own)):
        out[chr(256 + i)] = b
    return out


class Vocabulary:
    """Token bytes, merge ranks and added tokens of one tokenizer file."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE tokenizer files are supported")
        if spec.get("normalizer") or pre.get("add_prefix_space") or model.get("ignore_merges"):
            raise ValueError("normalizers, prefix spaces and whole-word lookups are not supported")
        to_byte = byte_chars()
        self.id_of = {bytes(to_byte[c] for c in tok): i for tok, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        #: Added tokens are found in the raw text before anything else.
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        for text, i in self.added.items():
            self.bytes_of.setdefault(i, text.encode())
        self.size = max(self.bytes_of) + 1
        #: (left id, right id) -> (rank, merged id); and how each token was formed.
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.formed: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a = self.id_of[bytes(to_byte[c] for c in left)]
            b = self.id_of[bytes(to_byte[c] for c in right)]
            t = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            if (a, b) not in self.merge:
                self.merge[a, b] = (rank, t)
                self.formed.setdefault(t, (rank, a, b))

    def merged(self, word: bytes) -> list[int]:
        """Plain BPE (merge the lowest rank, leftmost first): for tests and for
        checking that a token encodes to itself."""
        ids = [self.id_of[bytes([b])] for b in word]
        while len(ids) > 1:
            best = min((self.merge[p] for p in zip(ids, ids[1:]) if p in self.merge), default=None)
            if best is None:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.merge.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay next to each other as they are.

        Runs the merges that formed both tokens backwards in time: the tokens
        facing each other at the seam are undone one at a time, the later formed
        first (a tie: the right one, as equal ranks merge from the left). The
        pair is broken exactly if two facing tokens would have merged across the
        seam before either of them was merged into what comes later.
        """
        until_a = until_b = 1 << 60
        while True:
            m = self.merge.get((a, b))
            if m is not None and m[0] < until_a and m[0] <= until_b:
                return False
            fa, fb = self.formed.get(a), self.formed.get(b)
            if fa is None and fb is None:
                return True
            if fb is None or (fa is not None and fa[0] > fb[0]):
                until_a, a = fa[0], fa[2]
            else:
                until_b, b = fb[0], fb[1]

    def self_encoding(self) -> list[int]:
        """The ids of tokens that plain BPE makes of their own bytes."""
        return [i for b, i in self.id_of.items()
                if len(b) == 1 or ((f := self.formed.get(i)) is not None and self.compatible(f[1], f[2]) is False)
                and self.merged(b) == [i]]


_HELD: list = [None, None]


def held(key: tuple, build):
    """What a worker process keeps between tasks: one tool at a time.

    Workers are reused by later stages; a stage's tool (tables and memo) replaces the
    one of the stage before, so their memory does not add up.
    """
    if _HELD[0] != key:
        _HELD[:] = [None, None]  # let go before building
        give_back()
        _HELD[:] = [key, build()]
    return _HELD[1]


def give_back() -> None:
    """Return freed memory to the system: a worker lives on through stages with other needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def vocabulary(data: bytes) -> Vocabulary:
    return Vocabulary(data)

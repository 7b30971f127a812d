"""Tokenizer tables in flat arrays, compiled once on the driver and mapped by the workers.

A tokenizer file has a fixed size; its tables do too. ``ship`` writes them as one file
in the driver's temporary folder and hands it to Spark's own file distribution; every
worker of an executor maps the executor's copy read-only, so its pages exist once.

Tables: the Aho-Corasick trie over all token bytes (a hash table of transitions, failure
links, the token that ends at a node, the next node on its failure chain that ends one), token
lengths and the next shorter token with the same start, the merges (a hash table from pairs
of ids to ranks), how each token was formed, the bytes of all tokens with offsets, and
the character classes of the pre-tokenizer.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from carelake.llm import pretokens, vocab
from carelake.session import ship_package

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _table(keys: list[int], values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """An open-addressing hash table of at most half its places (-1: free)."""
    bits = max(4, (2 * len(keys)).bit_length())
    key, value = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    todo = np.arange(len(keys))
    k, v = np.array(keys, np.int64), np.array(values, np.int32)
    at = _place(k, bits)
    while len(todo):
        # Of the keys that meet at a free place, the last written one stays; the rest go on.
        free = key[at[todo]] == -1
        key[at[todo[free]]] = k[todo[free]]
        value[at[todo[free]]] = v[todo[free]]
        todo = todo[key[at[todo]] != k[todo]]
        at[todo] = (at[todo] + 1) & ((1 << bits) - 1)
    value[_find(key, k)] = v
    return key, value


def _place(k: np.ndarray, bits: int) -> np.ndarray:
    return ((k.astype(np.uint64) * _ODD) >> np.uint64(64 - bits)).astype(np.int64)


def _find(table: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of each key in ``table``, -1 if it is not there."""
    mask = len(table) - 1
    at = _place(k, mask.bit_length())
    there = table[at]
    out = np.where(there == k, at, -1)
    todo = np.flatnonzero((there != k) & (there != -1))
    while len(todo):
        at[todo] = (at[todo] + 1) & mask
        there = table[at[todo]]
        hit = there == k[todo]
        out[todo[hit]] = at[todo[hit]]
        todo = todo[~hit & (there != -1)]
    return out


def compiled(data: bytes) -> dict[str, np.ndarray]:
    """The arrays of one tokenizer file."""
    v = vocab.vocabulary(data)
    by_bytes = {v.bytes_of[i]: i for i in v.self_encoding()}
    child: list[dict[int, int]] = [{}]
    token = [-1]
    for b, i in by_bytes.items():
        node = 0
        for x in b:
            nxt = child[node].get(x)
            if nxt is None:
                nxt = child[node][x] = len(child)
                child.append({})
                token.append(-1)
            node = nxt
        token[node] = i
    fail, out = [0] * len(child), [0] * len(child)
    todo = deque([0])
    while todo:
        node = todo.popleft()
        for x, c in child[node].items():
            f = fail[node]
            while f and x not in child[f]:
                f = fail[f]
            fail[c] = child[f].get(x, 0) if node else 0
            out[c] = c if token[c] >= 0 else out[fail[c]]
            todo.append(c)
    goto = [(node << 8 | x, c) for node, kids in enumerate(child) for x, c in kids.items()]
    length, shorter = np.zeros(v.size, np.int32), np.full(v.size, -1, np.int32)
    for b, i in by_bytes.items():
        length[i] = len(b)
        shorter[i] = next((by_bytes[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in by_bytes), -1)
    rank, left, right = (np.full(v.size, -1, np.int32) for _ in range(3))
    for t, (r, a, b) in v.formed.items():
        rank[t], left[t], right[t] = r, a, b
    parts = [v.bytes_of.get(i, b"") for i in range(v.size)]
    goto_key, goto_to = _table([k for k, _ in goto], [c for _, c in goto])
    merge_key, merge_rank = _table([a << 32 | b for a, b in v.merge], [r for r, _ in v.merge.values()])
    return {"goto_key": goto_key, "goto_to": goto_to, "fail": np.array(fail, np.int32), "token": np.array(token, np.int32),
            "out": np.array(out, np.int32), "length": length, "shorter": shorter, "merge_key": merge_key, "merge_rank": merge_rank,
            "rank": rank, "left": left, "right": right, "offsets": np.concatenate(([0], np.cumsum([len(p) for p in parts]))),
            "bytes": np.frombuffer(b"".join(parts), np.uint8), "classes": pretokens.tables()[0]}


class Shipped:
    """What a worker needs to map the tables: the file's name, where each array lies, the added tokens."""

    def __init__(self, name: str, index: dict, added: dict[str, int], key: bytes):
        self.name, self.index, self.added, self.key = name, index, added, key

    def load(self) -> dict[str, np.ndarray]:
        raw = np.asarray(np.memmap(SparkFiles.get(self.name), np.uint8, "r"))
        return {k: raw[at:at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in self.index.items()}


def ship(spark: SparkSession, path: str | None = None) -> Shipped:
    """The tables of a tokenizer file, given to all executors (once per application and file)."""
    ship_package(spark)
    sc, data = spark.sparkContext, vocab.read_file(path)
    key = vocab.digest(data)
    known = sc.__dict__.setdefault("_carelake_tables", {})
    if key not in known:
        index = {}
        fd, file = tempfile.mkstemp(prefix="carelake-tables-", suffix=".bin")
        with os.fdopen(fd, "wb") as f:
            for name, a in compiled(data).items():
                f.write(b"\0" * (-f.tell() % 64))
                index[name] = (a.dtype.str, f.tell(), len(a))
                f.write(a.tobytes())
        sc.addFile(os.path.realpath(file))
        known[key] = Shipped(os.path.basename(file), index, vocab.vocabulary(data).added, key)
    return known[key]

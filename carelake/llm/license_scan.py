"""License scans: which license notices a text carries, and where.

Texts and templates become words (runs of a-z and 0-9 after lower-casing ASCII)
and shingles of five words. A text is covered by overlapping windows of shingle
positions; their grid depends on the template's length class, so that any run as
long as the template lies inside one window, which is at most three times as long.
MinHash bands of windows and templates retrieve the candidates: the number of
bands follows from the smallest similarity a true match can have in its class,
so that it collides with probability ``RECALL`` at least. Candidates are
verified by exact containment: the share of the template's distinct shingles
found in the window.

A window without any template shingle cannot collide in any band (a band value
is the hash of a member), so signatures are computed only where one occurs:
found by one look-up per shingle. Templates are a bounded table that is
broadcast in slices of ``SLICE_BYTES``; the texts stay where they are.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.vocab import held
from carelake.session import ship_package

WIDTH = 5
CONTAINMENT = 0.8
RECALL = 0.9999
SLICE_BYTES = 16 * 1024 * 1024
MEMO_WORDS = 1_000_000

# Public license notices, as they are usually written.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 header", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("MIT", "Released under the MIT License."),
    ("MIT permission", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0 header", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version."""),
    ("BSD-3-Clause conditions", """Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0 header", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version."""),
    ("LGPL-2.1 header", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or
        (at your option) any later version."""),
    ("LGPL-3.0 header", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version."""),
    ("AGPL-3.0 header", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY"""),
    ("BSD-2-Clause bulleted", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"""),
    ("BSD-3-Clause bulleted", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written
        permission. THIS SOFTWARE IS PROVIDED BY"""),
    ("MIT disclaimer", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
        THE SOFTWARE."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"""),
]

_WORD = re.compile(rb"[a-z0-9]+")


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hash of each run of ``WIDTH`` words (fewer words: of all of them; none: nothing)."""
    n = max(1, len(hashes) - WIDTH + 1) if len(hashes) else 0
    out = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for k in range(min(WIDTH, len(hashes))):
        out = _mix(out + hashes[k:k + n])
    return out


def grid(m: int) -> tuple[int, int]:
    """(stride, length) of the windows for a template of ``m`` distinct shingles."""
    s = 1 << (m - 1).bit_length()
    return (1, 1) if s == 1 else (s // 2, s // 2 * 3)


def least_similarity(m: int) -> float:
    """The smallest Jaccard similarity of a window that contains ``CONTAINMENT`` of the template."""
    hit = math.ceil(CONTAINMENT * m - 1e-9)
    return hit / (grid(m)[1] + m - hit)


def bands(similarity: float, recall: float = RECALL) -> int:
    """Bands of one hash each that collide with probability ``recall`` at ``similarity``."""
    return 1 if similarity >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - similarity))


def _hash_k(x: np.ndarray, k: int) -> np.ndarray:
    return _mix(x ^ np.uint64(0xA0761D6478BD642F * (k + 1) & (2**64 - 1)))


@dataclass
class _Template:
    name: str
    shingles: np.ndarray  # distinct, sorted
    minima: np.ndarray  # one per band


class Templates:
    def __init__(self, rows: list[tuple[str, str]]):
        memo = _WordHash()
        self.classes: dict[tuple[int, int], list[_Template]] = {}
        known = []
        for name, text in rows:
            x = np.unique(shingles(np.array([memo[w] for w in words_of(text)], np.uint64)))
            if not len(x):
                continue
            n = bands(least_similarity(len(x)))
            t = _Template(name, x, np.array([_hash_k(x, k).min() for k in range(n)], np.uint64))
            self.classes.setdefault(grid(len(x)), []).append(t)
            known.append(x)
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.memo = memo

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int, int]]:
        """Per template with a verified window: (name, shingles found, shingles of the
        template, first word, words, windows), from its best window (ties: the first)."""
        words = words_of(text)
        if not words or not len(self.known):
            return []
        x = shingles(np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words)))
        at = np.flatnonzero(self.bitmap[(x >> np.uint64(44)).astype(np.int64)])
        if len(at):
            at = at[self.known[np.minimum(np.searchsorted(self.known, x[at]), len(self.known) - 1)] == x[at]]
        if not len(at):
            return []
        out = []
        for (stride, length), templates in self.classes.items():
            back = np.arange(length // stride)
            windows = np.unique(at[:, None] // stride - back)
            found: dict[str, tuple] = {}
            for w in windows[windows >= 0].tolist():
                part = x[w * stride:w * stride + length]
                minima = [_hash_k(part, k).min() for k in range(max(len(t.minima) for t in templates))]
                minima = np.array(minima, np.uint64)
                for t in templates:
                    if not (minima[:len(t.minima)] == t.minima).any():
                        continue  # no band in common
                    hit = np.isin(part, t.shingles)
                    n = len(np.unique(part[hit]))
                    if n < CONTAINMENT * len(t.shingles) - 1e-9:
                        continue
                    pos = np.flatnonzero(hit)
                    size = min(int(pos[-1] - pos[0]) + WIDTH, len(words))
                    old = found.get(t.name)
                    best = old[:5] if old and old[1] >= n else (t.name, n, len(t.shingles), w * stride + int(pos[0]), size)
                    found[t.name] = (*best, (old[5] if old else 0) + 1)
            out += found.values()
        return sorted(out)


def best_of_place(found: list[tuple]) -> list[tuple]:
    """Of the rows of ``Templates.scan`` for one text those without a better one at the same
    place: an overlapping row of higher containment or, at equal containment, of more shingles."""
    def rank(r: tuple) -> tuple:
        return r[1] / r[2], r[2]

    return [r for r in found if not any(rank(q) > rank(r) and q[3] < r[3] + r[4] and r[3] < q[3] + q[4] for q in found)]


def _best_rows(found: DataFrame) -> DataFrame:
    """``best_of_place`` over rows of several slices of templates: a text's rows (one per template it
    matches) meet by the text's number."""
    names = [c for c in found.columns if c != "row"]

    def better(q: Column, r: Column) -> Column:
        share = q["n_found"] / q["n_shingles"], r["n_found"] / r["n_shingles"]
        higher = (share[0] > share[1]) | ((share[0] == share[1]) & (q["n_shingles"] > r["n_shingles"]))
        return (higher & (q["first_word"] < r["first_word"] + r["n_words"]) & (r["first_word"] < q["first_word"] + q["n_words"]))

    all_ = found.groupBy("row").agg(F.collect_list(F.struct(*names)).alias("all"))
    kept = F.filter("all", lambda r: ~F.exists("all", lambda q: better(q, r)))
    return all_.select("row", F.explode(kept).alias("x")).select("row", "x.*")


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates ``(template_id, text)``."""
    return spark.createDataFrame([(n, " ".join(t.split())) for n, t in NOTICES], "template_id string, text string")


def scan(docs: DataFrame, templates: DataFrame | None = None, key: str = "doc_id", text: str = "text",
         best: bool = False) -> DataFrame:
    """``(<key>, template_id, containment, n_found, n_shingles, first_word, n_words, n_windows)``:
    one row per text and template found in it, from the template's best window. With ``best`` only
    the best row of each place stays (``best_of_place``): neighbours of a licence share most of its words.

    A null or empty text has no rows, nor has a template without words; a template of
    fewer than five words is one shingle. Texts of any length are read whole. Repeated rows give repeated
    rows, an empty table none; null keys are kept; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    templates = notices(spark) if templates is None else templates
    rows = templates.select(F.col("template_id").cast("string").alias("id"), F.col("text").cast("string").alias("t")).where("t is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length(F.coalesce("id", F.lit("")))), F.lit(0))).first()[0]
    slices = -(-total // SLICE_BYTES) or 1
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, template_id string, n_found bigint, n_shingles bigint, first_word bigint, n_words bigint, n_windows bigint"

    def one(part: list[tuple[str, str]]) -> DataFrame:
        data = spark.sparkContext.broadcast(part)
        own = hashlib.sha256(repr(part).encode()).hexdigest()  # a worker keeps the compiled templates by their content

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = held(("licenses", own), lambda: Templates(data.value))
            for batch in batches:
                found = [(i, *m) for i in range(batch.num_rows)
                         for m in (best_of_place if best and slices == 1 else list)(t.scan(batch.column(2)[i].as_py()))]
                cols = list(zip(*found)) if found else [()] * 7
                at = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(cols[1], pa.string()),
                     *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    names=["row", "id", "template_id", "n_found", "n_shingles", "first_word", "n_words", "n_windows"])

        return texts.mapInArrow(run, f"row bigint, {schema}")

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).cast("string").alias("t"))
    out = None
    for i in range(slices):
        mine = sorted((r["id"], r["t"]) for r in rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(slices)) == i).collect() if r["id"] is not None)
        out = one(mine) if out is None else out.unionAll(one(mine))
    if best and slices > 1:
        out = _best_rows(out)
    return out.select(F.col("id").alias(key), "template_id", (F.col("n_found") / F.col("n_shingles")).alias("containment"),
                      "n_found", "n_shingles", "first_word", "n_words", "n_windows")

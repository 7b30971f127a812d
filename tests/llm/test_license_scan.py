import re

import numpy as np

from carelake.llm import license_scan as L


def brute(text, templates):
    """Exact containment in every window of each template's grid."""
    words = re.findall("[a-z0-9]+", (text or "").lower())
    runs = [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    out = []
    for name, t in templates:
        w = re.findall("[a-z0-9]+", t.lower())
        of = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
        stride, length = L.grid(len(of))
        best, windows = None, 0
        for k in range(-(-len(runs) // stride)):
            part = runs[k * stride:k * stride + length]
            n = len(of & set(part))
            if n >= 0.8 * len(of) - 1e-9:
                windows += 1
                if best is None or n > best[1]:
                    pos = [i for i, r in enumerate(part) if r in of]
                    best = (name, n, len(of), k * stride + pos[0], min(pos[-1] - pos[0] + 5, len(words)))
        if best:
            out.append((*best, windows))
    return sorted(out)


def test_scan_against_brute_force(spark):
    rng = np.random.default_rng(2)
    templates = [(n, t) for n, t in L.NOTICES] + [("two words", "all rights"), ("none", "--")]
    texts = [None, "", "all rights", "x y z"]
    for n, t in L.NOTICES:
        words = t.split()
        pad = ["w%d" % i for i in rng.integers(0, 1000, int(rng.integers(0, 300)))]
        texts += [t, " ".join(pad + words + pad), t.upper().replace(" ", "\n  "), " ".join(words + pad + words)]
        near = list(words)
        near[len(near) // 2] = "changed"
        texts.append(" ".join(pad + near + pad))
        texts.append(" ".join(pad + words[:len(words) // 2] + pad))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, template_id string")
    table = spark.createDataFrame([*templates, (None, "without a name"), ("no text", None)], "template_id string, text string")
    got: dict = {}
    for r in L.scan(docs, table).collect():
        got.setdefault(r["doc_id"], []).append((r["template_id"], r["n_found"], r["n_shingles"], r["first_word"], r["n_words"], r["n_windows"]))
    real = [(n, t) for n, t in templates if n != "none"]
    assert {k: sorted(v) for k, v in got.items()} == {i: b for i, t in enumerate(texts) if (b := brute(t, real))}
    assert L.scan(docs.limit(0), table).count() == 0 and L.scan(docs, table.limit(0)).count() == 0


def test_band_settings_guarantee_recall():
    for m in range(1, 400):
        s = L.least_similarity(m)
        assert 1 - (1 - s) ** L.bands(s) >= L.RECALL or s == 1
        stride, length = L.grid(m)
        assert length >= m + stride - 1  # a run of m lies inside one window


def test_templates_in_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Released under the MIT License."), (2, "Licensed under CC BY-NC 4.0.")], "doc_id bigint, text string")
    want = sorted(map(tuple, L.scan(docs).collect()))
    monkeypatch.setattr(L, "SLICE_BYTES", 700)
    assert sorted(map(tuple, L.scan(docs).collect())) == want and len(want) == 2


GNU = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as " \
    "published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following " \
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the " \
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and " \
    "the following disclaimer in the documentation and/or other materials provided with the distribution. {}THIS SOFTWARE IS PROVIDED BY THE"
NEITHER = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products " \
    "derived from this software without specific prior written permission. "


def test_neighbouring_licences_are_told_apart():
    t = L.Templates([(n, x) for n, x in L.NOTICES])
    texts = {"GPL-2.0 header": GNU.format("program", ";", "", ";", "2"), "GPL-3.0 header": GNU.format("program", ":", "", ",", "3"),
             "LGPL-2.1 header": GNU.format("library", ";", "Lesser ", ";", "2.1"), "LGPL-3.0 header": GNU.format("program", ":", "Lesser ", ",", "3"),
             "AGPL-3.0 header": GNU.format("program", ":", "Affero ", ",", "3"), "BSD-2-Clause": BSD.format(""), "BSD-3-Clause": BSD.format(NEITHER),
             **{f"BSD-{n}-Clause bulleted": BSD.format(x).replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ") for n, x in ((2, ""), (3, NEITHER))},
             "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    for name, text in texts.items():
        found = t.scan("some words before " + text + " and some after")
        assert name in [r[0] for r in found], name
        assert [r[0] for r in L.best_of_place(found)] == [name], (name, found)


def test_best_rows_in_the_query_and_over_slices(spark, monkeypatch):
    three, two = GNU.format("program", ":", "", ",", "3"), GNU.format("program", ";", "", ";", "2")
    docs = spark.createDataFrame([(1, three), (2, two), (3, three + " and then " + two), (1, three), (None, "see " + two), (4, ""), (5, None)],
                                 "doc_id bigint, text string")
    want = sorted([(1, "GPL-3.0 header")] * 2 + [(2, "GPL-2.0 header"), (3, "GPL-2.0 header"), (3, "GPL-3.0 header")], key=str) \
        + [(None, "GPL-2.0 header")]
    one = L.scan(docs, best=True).select("doc_id", "template_id").collect()
    monkeypatch.setattr(L, "SLICE_BYTES", 700)
    many = L.scan(docs, best=True).select("doc_id", "template_id").collect()
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, many), key=str) == sorted(want, key=str)


def test_templates_of_an_earlier_call_never_answer(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five six")], "doc_id bigint, text string")
    tables = [spark.createDataFrame([("a", "alpha beta gamma delta epsilon zeta")], "template_id string, text string"),
              spark.createDataFrame([("b", "one two three four five six")], "template_id string, text string")]
    for k in range(12):
        assert [r["doc_id"] for r in L.scan(docs, tables[k % 2]).collect()] == [1 + k % 2]


def test_long_texts_and_repeated_rows(spark):
    notice = dict(L.NOTICES)["MIT"] if "MIT" in dict(L.NOTICES) else L.NOTICES[0][1]
    name = next(n for n, t in L.NOTICES if t == notice)
    text = "word " * 150_000 + notice + " word" * 150_000
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id bigint, text string")
    got = L.scan(docs, best=True).collect()
    assert [(r["doc_id"], r["template_id"]) for r in got] == [(1, name)] * 2 and all(149_990 < r["first_word"] < 150_010 for r in got)

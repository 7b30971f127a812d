"""The pipeline against a brute-force chain, and the registered queries' oracles."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from carelake.llm import langid, mixing, quality_rules, vocab
from carelake.llm.oracle import ORACLE
from carelake.llm.queries import QUERIES
from tests.conftest import SF0001
from tests.llm.helpers import components, fingerprint, statistics
from tests.oracle_check import compare, duck


def test_registered():
    names = [n.split("_")[0] for n in QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "quality rules", "SimHash near-dedup", "mixing", "BPE"]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_queries_match_their_sql(spark, key):
    r = compare(spark, SF0001, key, QUERIES[key], ORACLE[key], duck(SF0001))
    assert r["status"] == "ok" and r["rows"] > 0 and "types" not in r, r


def test_stages_against_brute_force(spark, scratch):
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        folder = scratch("stage")
        stage(spark, frames[-1], SF0001).write.parquet(folder)
        frames.append(spark.read.parquet(folder))
    assert all(f.columns == columns for f in frames[:-1])
    rows = [[r.asDict() for r in f.collect()] for f in frames]
    # language ID: as the operator judges
    m = langid.fit_on_rest(docs)
    judged = {r["doc_id"] for r in langid.identify(docs, m).where("NOT rejected").collect()}
    assert {r["doc_id"] for r in rows[1]} == judged
    # quality: base rules by brute force, then the learned list
    rules = quality_rules.fit(frames[1], spark.read.parquet(f"{SF0001}/labels.parquet"))
    listed = {r["doc_id"] for r in quality_rules.judge(frames[1], rules).where("rule = 0").collect()}
    want = {r["doc_id"] for r in rows[1] for s in [statistics(r["text"])]
            if s["n_words"] >= 10 and 100 * s["n_repeat_words"] <= 20 * s["n_words"]} & listed
    assert {r["doc_id"] for r in rows[2]} == want
    # near-duplicates: the smallest id of each component
    kept = sorted(rows[2], key=lambda r: r["doc_id"])
    low = components([fingerprint(r["text"]) for r in kept], 2)
    assert {r["doc_id"] for r in rows[3]} == {kept[i]["doc_id"] for i in set(low)}
    # mixing: the operator's copies
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(frames[3], importance=mixing.length_class()).report().collect()}
    assert Counter(r["doc_id"] for r in rows[4]) == Counter({k: v for k, v in copies.items() if v})
    # BPE: the library's ids
    library = Tokenizer.from_file(vocab.default_path())
    text = {r["doc_id"]: r["text"] for r in rows[4]}
    assert Counter(r["doc_id"] for r in rows[5]) == Counter(r["doc_id"] for r in rows[4])
    for r in rows[5]:
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_stages_on_an_empty_table_with_clashing_names(spark, scratch):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, fp int, score int")
    for name, stage in corpus_pipeline.STAGES:
        folder = scratch("stage")
        stage(spark, docs, SF0001).write.parquet(folder)
        docs = spark.read.parquet(folder)
        assert docs.count() == 0


def test_stages_on_nulls_and_repeated_rows(spark, scratch):
    base = spark.read.parquet(f"{SF0001}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None, None, None, None), (70001, None, "en", "src1", 0), (70002, "", None, None, 0),
                                 (None, "the words that this text has are of the and one", "en", None, 1)], base.schema)
    docs = base.unionAll(odd).unionAll(base.limit(5))
    n = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        folder = scratch("stage")
        stage(spark, docs, SF0001).write.parquet(folder)
        docs = spark.read.parquet(folder)
        n.append(docs.count())
        if name == "language ID":  # texts without letters go, whatever their id
            assert docs.where("text IS NULL OR text = ''").count() == 0
            assert docs.where("doc_id IS NULL").count() <= 1
        if name == "quality rules":
            assert docs.where("size(split(trim(text), '[ \\n\\t]+')) < 10").count() == 0
        if name == "SimHash near-dedup":  # of repeated rows one stays
            assert docs.count() == docs.dropDuplicates(["doc_id", "text"]).count() == docs.dropDuplicates(["text"]).count()
        if name == "mixing":
            assert docs.groupBy("doc_id").count().where("count > 2").count() == 0
    assert n[0] == 69 and 0 < n[3] <= n[2] <= n[1] < n[0] and n[5] == n[4] > 0

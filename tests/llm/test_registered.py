"""The registered queries on the smallest tables, and their stages' defined results."""

import zlib

import pytest

import __spark_entry__ as E
from carelake.llm.queries import QUERIES
from tests.conftest import SF0001

COLUMNS = {
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op5_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op8_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_token_output": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_langid": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_importance": ["doc_id", "n_features", "weight", "score", "rank"],
}


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_a_query_gives_one_row_per_document(spark, texts, name):
    df = QUERIES[name](spark, SF0001)
    assert set(COLUMNS[name]) <= set(df.columns)
    got = df.toPandas()
    assert sorted(got.doc_id) == sorted(texts)
    of = got.set_index("doc_id")
    if name == "op2_mixing":
        assert (got.taken <= 2 * got["size"]).all() and abs(got.taken.sum() - 1.5 * got["size"].sum()) < 0.05 * got["size"].sum()
    if name == "op4_sharding":
        assert all(of.text_crc32[i] == zlib.crc32((t or "").encode()) and of["size"][i] == len((t or "").encode()) + 16 for i, t in texts.items())
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard")) and got["shard"].between(0, 39).all()
    if name in ("op3_token_counts", "op5_bpe", "op9_token_output"):
        from tokenizers import Tokenizer

        from carelake.llm import vocab
        library = Tokenizer.from_file(vocab.default_path())
        n = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()}
        more = 1 if name == "op9_token_output" else 0
        assert all(of.n_tokens[i] == n[i] + more for i in texts)
        if more:
            ordered = of.sort_index()
            assert (ordered.start == ordered.n_tokens.cumsum() - ordered.n_tokens).all()
    if name == "op10_langid":
        assert all(of.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in texts) and got.score.between(0, 1).all()


def test_the_entry_module_lives_without_the_optional_package(monkeypatch, capsys):
    """Whatever import fails there, the other queries stay."""
    import builtins
    import sys
    real = builtins.__import__

    def missing(name, *args, **more):
        if name == "xxhash":
            raise ModuleNotFoundError("No module named 'xxhash'", name="xxhash")
        return real(name, *args, **more)

    for m in [m for m in sys.modules if m.startswith("carelake.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setattr(builtins, "__import__", missing)
    rest = E.queries()
    assert "gold_top10" in rest and not any(k.startswith("op") or k == "pipeline" for k in rest)
    assert set(E.oracle_sql()) == set(rest)
    assert "xxhash" in capsys.readouterr().err

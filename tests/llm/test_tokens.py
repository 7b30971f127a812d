"""Token counts, BPE and token output against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from carelake.llm import bpe, flat, pretokens, token_counts, token_output, vocab
from tests.llm.helpers import ODD_TEXTS

DOCS = "doc_id bigint, text string, n_tokens int, ids string, extra int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocab.default_path())


@pytest.fixture(scope="module")
def data():
    with open(vocab.default_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def tables(data):
    return flat.compiled(data)


@pytest.fixture(scope="module")
def memos(data, tables):
    added = vocab.vocabulary(data).added
    return ((pretokens.WordMemo(bpe.Encoder(tables).words, added, classes=tables["classes"]), bpe.Decoder(tables)),
            token_counts.memo(data), token_output._encoder(data))


def values_of(memo, texts):
    """The values of each text."""
    out = []
    for _, _, values, sizes in pretokens.encoded(memo, pa.array(texts, pa.string())):
        out += np.split(values, np.cumsum(sizes)[:-1])
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i, "x", None) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows + [rows[5], (None, "no key", 1, "y", 2)], DOCS)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_every_token_encodes_to_itself(data):
    v = vocab.vocabulary(data)
    assert len(v.self_encoding()) == len(v.id_of)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \n\t'strvemldaZ9!é²　\x85,<|>", max_size=30) | st.text(max_size=40), max_size=4))
def test_ids_and_counts_equal_the_library(library, memos, texts):
    (memo, decoder), counts, by_library = memos
    for t, x, n, y in zip(texts, *(values_of(m, texts) for m in (memo, counts, by_library))):
        want = ids_of(library, t)
        assert x.tolist() == want == y.tolist()
        assert int(n.sum()) == len(want)
        assert decoder.text(x) == library.decode(want, skip_special_tokens=False)


def test_results_do_not_depend_on_the_memo_or_the_states(library, data, tables, monkeypatch):
    texts = [t or "" for t in ODD_TEXTS]
    want = [ids_of(library, t) for t in texts]
    small = pretokens.WordMemo(bpe.Encoder(tables).words, vocab.vocabulary(data).added, limit=3)
    assert [x.tolist() for t in texts for x in values_of(small, [t])] == want
    monkeypatch.setattr(token_counts, "STATES", 5)
    few = token_counts.CountTransducer(data)
    assert all(few.count(w.encode()) == len(ids_of(library, w)) for w in ("internationalization", "aaaaaaaaaaaaaaaaaaaaaaaaa", "zqxj"))


#: Two words of one length that a linear 64-bit hash confuses.
ALIKE = ["oxumvuumwxwejpsmwbawdmmr", "zytwnbldtttfgnjekyqckatk"]


def test_words_are_told_apart_by_their_bytes(spark, library, memos, scratch):
    for memo in (memos[0][0], memos[2]):
        for texts in (ALIKE, ALIKE[::-1], [" ".join(ALIKE)], ["a\ue000b new\ue000 \ue000", "\ue000", "plain words"]):
            assert [x.tolist() for x in values_of(memo, texts)] == [ids_of(library, t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(ALIKE)), "doc_id bigint, text string").coalesce(1)
    want = {k: ids_of(library, t) for k, t in enumerate(ALIKE)}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs).collect()} == {k: len(v) for k, v in want.items()}
    got = {r["doc_id"]: r for r in bpe.encode_decode(docs).collect()}
    assert {k: r["ids"] for k, r in got.items()} == want
    assert all(r["decoded_sha256"] == hashlib.sha256(ALIKE[k].encode()).hexdigest() for k, r in got.items())
    stored = token_output.read_token_ids(spark, token_output.write_token_ids(docs, scratch("alike"))).collect()
    assert {r["doc_id"]: r["ids"][:-1] for r in stored} == want


def test_many_words_at_once_equal_one_at_a_time(library, tables):
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdeitnors "), rng.integers(1, 40))) for _ in range(3000)]
    words += ["ab" * 3000, "Z" * 70_000, "é" * 900, "".join(rng.choice(list("xyz\U0001f642é"), 5000)), "x"]
    e = bpe.Encoder(tables)
    raw = pa.array([w.encode() for w in words], pa.binary())
    values, n = e.words(raw)
    v = vocab.vocabulary(open(vocab.default_path(), "rb").read())
    for w, x in zip(words[:400], np.split(values, np.cumsum(n)[:-1])):
        assert x.tolist() == v.merged(w.encode())
    one = [e.words(raw.slice(k, 1)) for k in (0, 5, 3000, 3001, 3002, 3003, 3004)]
    many = np.split(values, np.cumsum(n)[:-1])
    assert all(np.array_equal(x, many[k]) for (x, _), k in zip(one, (0, 5, 3000, 3001, 3002, 3003, 3004)))
    assert [x.tolist() for x in (many[3000], many[3001], many[3002])] == [ids_of(library, words[k]) for k in (3000, 3001, 3002)]


def test_flat_pairs_equal_the_vocabulary(data, tables):
    rng = np.random.default_rng(1)
    v, e = vocab.vocabulary(data), bpe.Encoder(tables)
    a, b = rng.integers(0, 50_000, 4000), rng.integers(0, 50_000, 4000)
    first = e.compatible(a, b)
    assert first.tolist() == [v.compatible(int(x), int(y)) for x, y in zip(a, b)]
    assert np.array_equal(e.compatible(a, b), first)  # from the table


def test_pieces_of_a_long_text_are_cut_at_pre_tokens(library, memos, monkeypatch):
    monkeypatch.setattr(pretokens, "PIECE", 50)
    monkeypatch.setattr(pretokens, "ranges", lambda column, size=50: ((i, i + 1) for i in range(len(column))))
    texts = ["some words, and  more\n\n words 'll go  on " * 40, "x" * 500, " " * 300 + "y"]
    assert [x.tolist() for x in values_of(memos[0][0], texts)] == [ids_of(library, t) for t in texts]


def test_scan_of_chunk_maps_equals_one_pass():
    rng = np.random.default_rng(3)
    cls = rng.integers(0, pretokens.N_CLASSES, 40 * pretokens.CHUNK).astype(np.uint8)
    _, nxt, _ = pretokens.tables()
    state, want = pretokens.START, []
    for i, c in enumerate(cls.tolist()):
        if i % pretokens.CHUNK == 0:
            want.append(state)
        state = nxt[c * pretokens.N_STATES + state]
    assert pretokens.entry_states(cls).tolist() == want


def test_token_counts(docs, library):
    got = token_counts.token_counts(docs, limit=100).toPandas()
    assert list(got.columns) == ["doc_id", "ids", "extra", "n_bytes", "n_tokens", "over_limit"]
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got.itertuples():
        text = by_id[None if np.isnan(r.doc_id) else r.doc_id]
        n = len(ids_of(library, text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), n, n > 100)
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_encode_and_decode(docs, library):
    got = bpe.encode_decode(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        text = by_id[r["doc_id"]] or ""
        want = ids_of(library, text)
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(docs.limit(0)).count() == 0


def test_token_files_round_trip(spark, docs, library, scratch):
    folder = token_output.write_token_ids(docs, scratch("ids"))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
    want, at = [], 0
    for i, t in rows:
        ids = ids_of(library, t) + [0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted(map(tuple, token_output.digests(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    one = token_output.read_token_ids(spark, folder).where("doc_id = 7")
    assert one.collect()[0]["ids"] == ids_of(library, ODD_TEXTS[7]) + [0]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan


def test_token_files_of_an_empty_table(spark, docs, scratch):
    folder = token_output.write_token_ids(docs.limit(0), scratch("ids"))
    assert token_output.digests(spark, folder).count() == 0


@pytest.mark.parametrize("key", ["part", "ids", "n_tokens", "local_start", "start"])
def test_token_files_with_a_key_that_clashes(spark, library, scratch, key):
    docs = spark.createDataFrame([(5, "five words"), (2, "two"), (2, "two")], f"`{key}` bigint, text string")
    got = [tuple(r) for r in token_output.digests(spark, token_output.write_token_ids(docs, scratch("clash"), key=key), key=key).collect()]
    n = {k: len(ids_of(library, t)) + 1 for k, t in ((5, "five words"), (2, "two"))}
    assert sorted(r[:3] for r in got) == [(2, 0, n[2]), (2, n[2], n[2]), (5, 2 * n[2], n[5])]


def test_token_files_hold_bloom_filters_and_row_indexes(spark, scratch):
    """The ORC footer's stream kinds: row indexes (6) of every column, Bloom filters (8: UTF-8) of the key."""
    import glob

    from pyarrow import orc
    docs = spark.range(0, 60_000).selectExpr("id AS doc_id", "concat('some text ', id) AS text").coalesce(1)
    folder = token_output.write_token_ids(docs, scratch("bloom"))
    files = [f for f in glob.glob(f"{folder.removeprefix('file:')}/*.orc") if orc.ORCFile(f).nrows > 20_000]
    assert files or sum(orc.ORCFile(f).nrows for f in glob.glob(f"{folder}/*.orc")) == 60_000
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    reader_of = jvm.org.apache.orc.OrcFile
    for f in glob.glob(f"{folder}/*.orc"):
        r = reader_of.createReader(jvm.org.apache.hadoop.fs.Path(f), reader_of.readerOptions(conf))
        assert r.getRowIndexStride() == 10_000
        rows = r.rows()
        try:
            kinds = [[s.getKind().toString() for s in rows.readStripeFooter(x).getStreamsList()] for x in r.getStripes()]
        finally:
            rows.close()
        assert kinds and all("ROW_INDEX" in k and "BLOOM_FILTER_UTF8" in k for k in kinds)
    one = token_output.read_token_ids(spark, folder).where("doc_id = 41234").collect()
    assert len(one) == 1

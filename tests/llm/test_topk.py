import numpy as np
import pytest

from carelake.llm import topk


def brute(rows, k=5, every=50):
    out = []
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in ok]
    for a, (i, v) in enumerate(whole):
        if i is None or i % every:
            continue
        s = [(-sum(x * y for x, y in zip(v, w)), j if j is not None else 1 << 62, j) for b, (j, w) in enumerate(whole) if a != b and len(v) == len(w)]
        out += [(i, r, j, -x) for r, (x, _, j) in enumerate(sorted(s, key=lambda t: t[:2])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [7, 100_000])
def test_top_k_against_brute_force(spark, block):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=40).round(3).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # ties
    rows += [(600, None), (650, [None] * 40), (700, [float("nan")] * 40), (750, [float("inf")] * 40), (None, rows[1][1]), (800, [1.0, 2.0]),
             (850, [3.0, -1.0]), (900, []), (50, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, row int")
    got = topk.top_k(df, block_rows=block, query_rows=3 if block == 7 else 1024)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert topk.top_k(df.limit(0)).count() == 0


def test_bounds_never_drop_a_winner():
    rng = np.random.default_rng(0)
    x = np.floor(256 * np.concatenate([rng.normal(size=(3000, 64)), 5 * rng.normal(size=(20, 64))])).astype(np.int64)
    ids = rng.permutation(len(x))
    got = topk.best_of_block(x, ids, np.arange(len(x)), x[:30], np.arange(30), 5)
    for q, (at, score) in enumerate(got):
        s = x @ x[q]
        want = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        assert at.tolist() == want and score.tolist() == s[want].tolist()


def test_large_components_stay_exact():
    x = np.array([[2**40, 1], [2**40, 2], [-2**40, 5], [3, 4]], np.int64)
    (at, score), = topk.best_of_block(x, np.arange(4), np.arange(4), x[:1], np.array([0]), 2)
    assert at.tolist() == [1, 3] and [int(s) for s in score] == [2**80 + 2, 3 * 2**40 + 4]

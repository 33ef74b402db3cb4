import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import topk


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.integers(1, 6), st.integers(1, 5), st.integers(0, 10**6), st.integers(1, 4), st.integers(2, 64), st.sampled_from([1.0, 2.0**20, 2.0**40, 1e200]))
def test_search_is_exact(n, dims, k, seed, spread, cells, scale):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (n, dims)).astype(float) * scale
    ids = rng.permutation(n)
    queries, query_ids = vectors[:5], ids[:5]
    topk_scan, topk.SCAN_ROWS = topk.SCAN_ROWS, 16
    try:
        file, own = topk.ApproximationFile.over(topk.ApproximationFile.of(vectors, cells).to_bytes(ids))
        got = topk.search_block(queries, query_ids, file, vectors, own, k)
    finally:
        topk.SCAN_ROWS = topk_scan
    for q, own, found in zip(queries, query_ids, got):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(v, q)), int(i)) for v, i in zip(vectors, ids) if i != own)[:k]
        assert found == [(-s, i) for s, i in want]


def test_query_is_brute_force(spark, sf):
    import pandas as pd

    from tessera.llm.queries import op1_exact_top_k

    e = pd.read_parquet(f"{sf}/embeddings.parquet")
    v = np.floor(256 * np.stack(e.embedding).astype(np.float64))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in op1_exact_top_k(spark, sf).collect()}
    for i, own in enumerate(e.vec_id):
        if own % 50 == 0:
            best = sorted((-int(s), int(j)) for s, j in zip(v @ v[i], e.vec_id) if j != own)[:5]
            assert [got[own, k + 1] for k in range(5)] == [(j, -s) for s, j in best]


@given(st.lists(st.integers(-(2**200), 2**200) | st.integers(-300, 300), min_size=2, max_size=8))
def test_scores_sort_as_bytes(scores):
    assert [topk._score(x) for x in sorted(map(topk._order, scores))] == sorted(scores)
    assert all(topk._below(s) <= s for s in scores)


def test_many_groups_and_blocks(spark):
    """Floors of the first groups, ties across groups, copies, other lengths, scores beyond a long."""
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 3)]) for i in rng.permutation(400)] + [(i, [1.0, 1.0, 1.0]) for i in range(500, 700)] + [(i, [float(i), 1.0]) for i in range(50, 60)]
    rows += [(i, [1e20 + 1e9 * i, 0.0, 0.0, 1.0]) for i in range(95, 105)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.exact_top_k(df, every=10, group_rows=16, block_rows=4).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows]
    asked = {}
    for i, v in whole:
        if i % 10 == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))[:5]
        want = {k + 1: (j, max(-(2**63), min(2**63 - 1, -s))) for k, (s, j) in enumerate(best)}
        assert got[i] == want, i
    assert set(got) == set(asked)

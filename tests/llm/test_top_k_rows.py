"""Exact top-k: rows that share an id but not the vector."""

from sluice.llm import topk


def test_rows_of_one_id_are_rows_of_their_own(spark):
    rows = [(7, [5.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (10, [1.0, 0.0]), (10, [0.0, 1.0]), (3, [2.0, -1.0]), (20, [0.0, 0.0])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, every=10, scale=1, group_rows=2, block_queries=2)
    unique = sorted({(i, tuple(map(int, v))) for i, v in rows})
    want = []
    for q in unique:
        if q[0] % 10 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(q[1], c[1])), c[0]) for c in unique if c != q)[:3]
            want += [(q[0], r, i, -s) for r, (s, i) in enumerate(ranked, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert (10, 1, 7, 5) in want

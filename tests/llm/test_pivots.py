"""Nearest neighbours against all pairs: recall, exact scores, copies, vectors without a direction."""

import numpy as np
from pyspark.sql import functions as F

from wavemill.llm import pivot_index
from wavemill.llm.shared import table


def exact(rows, queries, k):
    ids = sorted(i for i, _ in rows)
    x = np.array([dict(rows)[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        score = x @ x[ids.index(q)]
        out[q] = sorted((-s, i) for s, i in zip(score, ids, strict=True) if i != q)[:k]
    return out


def test_recall_and_scores(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = {}
    for r in pivot_index.search(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    want = exact(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert set(found) == set(want)
    hits = sum(len({r["vec_id"] for r in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, got in found.items():
        assert [r["rank"] for r in got] == [1, 2, 3, 4, 5]
        for r in got:
            a, b = vectors[q], vectors[r["vec_id"]]
            assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-14


def test_copies_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(0, 120, 3)] + [(50, [1e200, 0.0, 0.0]), (100, [0.0, 0.0, -1e-200])]
    rows += [(1, [0.0, 0.0, 0.0]), (2, None), (4, [nan, 1.0, 1.0]), (5, [inf, 0.0, 1.0]), (7, [1.0, None, 1.0]),
             (None, [1.0, 1.0, 1.0]), (150, [1.0, 2.0]), (8, [1.0, 2.0, 0.0]), (8, [1.0, 2.0, 0.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in pivot_index.search(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 12)))
    assert set(got) == {0, 50, 100}
    assert got[0] == [(3, 1.0), (6, 1.0), (8, 1.0), (9, 1.0), (12, 1.0)]
    assert [i for i, _ in got[50]] == [0, 3, 6, 8, 9]
    assert got[100] == [(i, 0.0) for i in (0, 3, 6, 8, 9)] or {i for i, _ in got[100]} <= {0, 3, 6, 8, 9, 50}


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = pivot_index.search(df, lambda i: i % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in rows) == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert pivot_index.search(df.limit(0), lambda i: i % 50 == 0).count() == 0
    assert pivot_index.search(df.where(F.col("vec_id") == 3), lambda i: i % 50 == 0).count() == 0

"""op9: recall against brute force, ties, and rows that take no part."""

import numpy as np
import pyarrow.parquet as pq

from llm.shared import rows
from tallyline.llm import rp_forest as R

SCHEMA = "vec_id long, embedding array<double>, rank string"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v], "x")
                                  for i, v in zip(ids if ids is not None else range(len(vectors)), vectors)], SCHEMA)


def brute(ids, x, every, k):
    out = {}
    for q, v in zip(ids, x):
        if q % every == 0:
            scores = sum(v[d] * x[:, d] for d in range(x.shape[1]))
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df, **options):
    out = {}
    for r in sorted(R.nearest(df, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_on_the_table(spark):
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array(table.column("embedding").to_pylist(), float)
    ids = table.column("vec_id").to_numpy()
    got = found(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), probes=160)
    want = brute(ids, x, 20, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9
    assert all(dict(want_all := brute(ids, x, 20, len(x))[q]).items() >= dict(got[q]).items() for q in list(want)[:3])


def test_lengths_count(spark):
    """Largest inner product, not smallest angle: long vectors win."""
    x = np.random.default_rng(2).normal(size=(600, 8)) * np.random.default_rng(3).uniform(0.1, 5, (600, 1))
    got, want = found(frame(spark, x), k=5, leaf_rows=32), brute(np.arange(600), x, 20, 5)
    assert np.mean([len(dict(got[q]).keys() & dict(want[q]).keys()) / 5 for q in want]) >= 0.9


def test_recall_where_the_usual_leaves_are_a_small_part(spark):
    """Vectors without structure in small leaves, so that a query must visit many more leaves than in the other tests."""
    x = np.random.default_rng(5).normal(size=(12_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got, want = found(frame(spark, x), every=100, leaf_rows=16), brute(np.arange(12_000), x, 100, 20)
    assert np.mean([len(dict(got[q]).keys() & dict(want[q]).keys()) / 20 for q in want]) >= 0.9


def test_ties_and_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(R, "TILE_ROWS", 50)
    monkeypatch.setattr(R, "TILE_QUERIES", 3)
    x = np.vstack([np.tile([0.1, 0.2, 0.3], (300, 1)), np.random.default_rng(4).normal(size=(60, 3)) * 0.01])
    got = found(frame(spark, x), k=7)
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5, 6, 7] and [v for v, _ in got[40]] == [0, 1, 2, 3, 4, 5, 6]
    assert got == brute(np.arange(360), x, 20, 7)


def test_rows_that_take_no_part(spark):
    vectors = [[1, 0], [0, 0], None, [1, None], [float("nan"), 1], [float("inf"), 1], [2, 1], [1, 2, 3], []]
    df = frame(spark, vectors).union(spark.createDataFrame([(None, [9.0, 9.0], "x"), (6, [3.0, 0.0], "x")], SCHEMA))
    assert found(df, every=1) == {0: [(6, 3.0)], 6: [(0, 3.0)]}
    assert rows(R.nearest(df.where("vec_id = 2")), "query_id") == [] and rows(R.nearest(df.where("false")), "query_id") == []

"""Clusters against plain rounds over all centroids, bounds against distances."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from delaykit.llm import simplex_clusters
from delaykit.llm.catalogue import SQL

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
                      + [T.StructField(n, T.StringType()) for n in ("v", "apex", "cluster", "n", "mark")])


def frame(spark, rows):
    return spark.createDataFrame([(i, v) + ("x",) * 5 for i, v in rows], SCHEMA)


def vectors(seed, n, spread=1.0, dimension=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dimension)) * spread
    rows = [(i, (centres[i % 5] + rng.normal(size=dimension)).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 3)]


def bad(dimension=64):
    one = [0.5] * dimension
    return [(900, None), (901, []), (902, one[1:]), (903, [None] + one[1:]), (904, [float("nan")] + one[1:]),
            (905, [float("-inf")] + one[1:]), (906, [1e30] + one[1:]), (None, one), (None, one), (907, [-0.0] * dimension)]


def plain(rows, k=8, rounds=10, dimension=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dimension and all(x is not None and abs(float(np.float32(x))) < 131072 for x in v):
            kept.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    ordered = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in ordered[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    total = sum(d for d, _ in own)
    return sorted(
        ((i, c, d, sum(e for e, f in own if f == c), total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for (i, _), (d, c) in zip(kept, own)), key=str)


@pytest.mark.parametrize("rows", [vectors(1, 60) + bad(), vectors(2, 5), vectors(3, 90, 0.01), [(i, [1.0] * 64) for i in range(20)], bad()[:6], []])
def test_as_plain(spark, rows):
    got = simplex_clusters.clusters(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_other_parameters(spark):
    rows = vectors(4, 50, 1.0, 3)
    got = simplex_clusters.clusters(frame(spark, rows), k=4, rounds=3, dimension=3).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 4, 3, 3)


def test_bounds_enclose_and_filter():
    rng = np.random.default_rng(5)
    points = (rng.normal(size=(8, 64)) * 1000).astype(np.int64)
    near = points[rng.integers(0, 8, 300)] + (rng.normal(size=(300, 64)) * 200).astype(np.int64)
    simplex = simplex_clusters.Simplex(points)
    own, centres = simplex.apexes(near), simplex.apexes(points)
    assert own.shape[1] == simplex_clusters.PIVOTS
    true = np.sqrt(((near[:, None] - points[None]) ** 2).sum(2))
    flat = ((own[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(2)
    low = np.sqrt(flat + (own[:, None, -1] - centres[None, :, -1]) ** 2)
    high = np.sqrt(flat + (own[:, None, -1] + centres[None, :, -1]) ** 2)
    assert (low <= true + 1e-3).all() and (high >= true - 1e-3).all()
    may = simplex_clusters.candidates(own, centres)
    assert may[np.arange(300), true.argmin(1)].all() and may.mean() < 0.5


def test_equal_and_flat_pivots_are_left_out():
    points = np.array([[0, 0, 0], [0, 0, 0], [8000, 0, 0], [4000, 0, 0], [0, 5000, 0]])
    assert len(simplex_clusters.Simplex(points).pivots) == 3


def test_sql(spark):
    rows = vectors(6, 40)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    random.Random(1).shuffle(rows)
    got = simplex_clusters.clusters(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.execute(SQL["op12_simplex_clusters"]).fetchall(), key=str)

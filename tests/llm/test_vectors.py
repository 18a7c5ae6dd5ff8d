"""Near copies of embeddings against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brevetlake.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.93):
    """vec_id to n_links, component_id and kept; every vec_id must be there once."""
    ok = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    parent, degree = {i: i for i, _, _ in rows}, dict.fromkeys([i for i, _, _ in rows], 0)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    groups = {}
    for i, v, label in ok:
        groups.setdefault((label, len(v)), []).append((i, v / np.abs(v).max()))
    for members in groups.values():
        x = np.array([v for _, v in members])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= cosine, 1)), strict=True):
            a, b = members[a][0], members[b][0]
            degree[a] += 1
            degree[b] += 1
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (degree[i], root(i), root(i) == i) for i, _, _ in rows}


def found(spark, rows, extra=False, **settings):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("cls", "size", "pass", "key", "comp", "copies", "block", "at", "n", "own"):
            df = df.withColumn(name, F.lit("clash"))
    got = vectors.near_copies(df, **settings).collect()
    assert len(got) == len(rows)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def sample(seed, n=400, dims=32, groups=25, noise=(0.02, 0.08), labels=3, mean=0.0):
    rng = np.random.default_rng(seed)
    shift = mean * rng.standard_normal(dims)
    vectors = [rng.standard_normal(dims) + shift for _ in range(n)]
    for _ in range(groups):
        base, spread = rng.standard_normal(dims) + shift, rng.uniform(*noise)
        vectors += [(base + spread * np.linalg.norm(base) * rng.standard_normal(dims)) * rng.uniform(0.1, 10) for _ in range(rng.integers(2, 9))]
    order = rng.permutation(len(vectors))
    return [(int(7 * k), [float(x) for x in vectors[j]], int(rng.integers(labels))) for k, j in enumerate(order)]


@pytest.mark.parametrize("mean", [0.0, 1.5])
def test_near_copies(spark, mean):
    rows = sample(1, mean=mean)
    inf, nan = math.inf, math.nan
    odd = [None, [], [0.0] * 4, [1.0, None, 2.0], [nan, 1.0], [inf, 1.0], [-inf, 1.0], [1e300, 1e300], [1e300, 1e300], [1e-300, 1e-300], [3.0], [5.0], [-5.0]]
    rows += [(100_000 + k, v, 1) for k, v in enumerate(odd)] + [(200_000 + k, rows[0][1], None) for k in range(2)]
    rows += [(300_000 + k, rows[k][1], rows[k][2]) for k in range(40)]  # exact copies
    rows += [(400_000 + k, [2 * x for x in rows[k][1]], rows[k][2]) for k in range(20)]
    assert found(spark, rows, extra=True) == brute(rows)


@pytest.mark.parametrize(("noise", "block"), [(0.01, 64), (0.045, 64), (0.045, 16)])
def test_large_groups(spark, noise, block):
    """One group that is tight enough to be counted without comparing, and one that is compared in blocks; windows far smaller than either."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal(32)
    rows = sample(3, n=200, groups=5, labels=1)
    rows += [(50_000 + k, [float(x) for x in base + noise * np.linalg.norm(base) * rng.standard_normal(32)], 0) for k in range(300)]
    want = brute(rows)
    assert max(n for n, _, _ in want.values()) > 60
    assert found(spark, rows, window=16, block=block) == want


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine just above the threshold, among many others in small windows."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(1500):
        a, b = rng.standard_normal(48), rng.standard_normal(48)
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = 0.9301 if k % 2 else 0.9299
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 0)]
    got = found(spark, rows, window=32)
    linked = {i // 2 for i, (n, _, _) in got.items() if n}
    assert all(k % 2 for k in linked)
    assert len(linked) >= 0.99 * 750
    assert all(n <= 1 for n, _, _ in got.values())


def test_passes():
    assert vectors.passes_for(0, 1.0) == vectors.passes_for(100, 1.0) == vectors.LEAST_PASSES
    few, many = vectors.passes_for(10**5, 1.0), vectors.passes_for(10**9, 1.0)
    assert few < many < 400
    assert vectors.passes_for(10**5, 0.5) > few


def test_repeated_and_missing_ids(spark):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0]
    df = vectors.near_copies(spark.createDataFrame([(5, a, 1), (5, b, 1), (7, b, 1), (None, a, 1), (None, [0.0, 0.0, 1.0], 1), (9, a, 2)], SCHEMA))
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in df.collect()) == [(0, 0, 0, True), (0, 1, 5, False), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 0, 9, True)]


def test_empty_table(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None, 1), (2, [1.0], None)]) == {1: (0, 1, True), 2: (0, 2, True)}


def test_query_of_a_table_with_large_groups(spark):
    """A label with a fifth of all rows and a group of a thousand near copies."""
    folder = "/root/testdata/check_h"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op12_embedding_dedup(spark, folder).collect()}
    assert got == brute(rows)

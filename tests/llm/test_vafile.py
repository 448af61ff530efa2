"""Vector-approximation search against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import vafile as V

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, is_query, k=20, scale=64):
    vecs = []
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        vecs.append((i, [math.floor(float(np.float32(x)) * scale) for x in v]))
    out = []
    for n, (q, qv) in enumerate(vecs):
        if is_query(q):
            near = sorted((-sum(a * b for a, b in zip(qv, v)), i) for m, (i, v) in enumerate(vecs) if m != n and len(v) == len(qv))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, every=20, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = V.top_k(df, F.pmod(F.col("id"), F.lit(every)) == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 0.1
    return [(centres[i % 6] + rng.normal(size=d) * 0.1).astype(np.float32).tolist() for i in range(n)]


def test_matches_all_pairs(spark):
    v = vectors(900, 24, 1)
    v[300:400] = [v[5]] * 100  # a group of copies, larger than k
    rows = [(i * 3, x, "s") for i, x in enumerate(v)]
    assert run(spark, rows) == brute(rows, lambda q: q % 20 == 0)


def test_small_blocks_and_coarse_cells(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 64)
    monkeypatch.setattr(V, "QUERY_BLOCK_ROWS", 8)
    rows = [(i, x, None) for i, x in enumerate(vectors(500, 10, 2))]
    for bits in (1, 3):
        assert run(spark, rows, every=7, k=5, bits=bits) == brute(rows, lambda q: q % 7 == 0, k=5)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], "a"), (0, [1.0, 0.5], "a"), (20, [0.25, -1.0], "b"), (1, [1.0, 0.5], "c"), (1, [-3.0, 0.0], "c"), (2, None, "d"), (3, [], "d"),
            (40, [nan, 1.0], "e"), (60, [inf, 1.0], "e"), (80, [None, 1.0], "e"), (None, [1.0, 1.0], "f"), (100, [1.0, 2.0, 3.0], "g"), (101, [1.0, 0.0, 0.0], "g"), (120, [7.0], "h")]
    assert run(spark, rows) == brute(rows, lambda q: q % 20 == 0)
    assert run(spark, []) == []
    assert run(spark, [(i, [0.0, 0.0], "z") for i in range(50)]) == brute([(i, [0.0, 0.0]) for i in range(50)], lambda q: q % 20 == 0)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-90, 90, (400, 12)).astype(np.float64)
    cells = V.fit_cells(x[:50], x.min(axis=0), x.max(axis=0), bits=3)
    low, high = cells.bounds(cells.encode(x))
    assert (low <= x).all() and (x <= high).all()
    q = rng.integers(-90, 90, (30, 12)).astype(np.float64)
    lower, upper = V.score_bounds(q, low, high)
    assert (lower <= q @ x.T).all() and (q @ x.T <= upper).all()


def test_large_vectors_take_part(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 64)
    rows = [(i, [(-1.0) ** i * (1 << 22), float(i * 37 % 101), 1.0], None) for i in range(300)]  # scores beyond 2**53
    rows += [(300 + i, [float(i), 2.0, float(i * 11 % 7)], None) for i in range(100)] + [(400, [float(1 << 24), 3.0, 0.25], None)]
    assert run(spark, rows, every=7, k=5) == brute(rows, lambda q: q % 7 == 0, k=5)
    equal = [(i, [float(1 << 24), i / 64], None) for i in range(200)]  # bounds that round to one number
    assert run(spark, equal, every=7, k=5) == brute(equal, lambda q: q % 7 == 0, k=5)


def test_beyond_64_bits_is_an_error(spark):
    for x in (1e30, float(1 << 30)):
        with pytest.raises(Exception, match="beyond 64 bits"):
            run(spark, [(i, [x, 1.0], None) for i in range(3)], every=1)
    a = np.array([[1 << 40, 1 << 40, 3]])
    assert V.inner_products(a, a * [1, -1, 1]).tolist() == [9]

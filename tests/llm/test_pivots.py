import math
import random

import numpy as np
import pytest

from moodtide.llm import pivots

SCHEMA = "vec_id long, embedding array<float>, label int, score int, distance string, vector string"


def brute(rows, every=50, k=5):
    held = []
    for vec_id, vector in rows:
        if vector and all(v is not None and math.isfinite(v) for v in vector):
            held.append((vec_id, [math.floor(256 * float(np.float32(v))) for v in vector]))
    out = set()
    for q, a in held:
        if q is not None and q % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for c, b in held if c != q]
            out |= {(q, rank, None if c[1] else c[2], -c[0]) for rank, c in enumerate(sorted(scored)[:k], 1)}
    return out


def found(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, 1, 2, "d", "v") for i, v in rows], SCHEMA).repartition(4)
    return {tuple(r) for r in pivots.top_k(df, **settings).collect()}


def vectors(n, width=8, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(width)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(400) + [(1000 + i, vectors(1)[0][1]) for i in range(50)]  # many ties with vector 0
    assert found(spark, rows) == brute(rows)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(pivots, "CHUNK_ROWS", 70)
    monkeypatch.setattr(pivots, "RUN", 4)
    rows = vectors(600, seed=1)
    assert found(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4) + [(100, None), (150, []), (200, [1.0, nan, 0.0, 0.0]), (250, [inf, 0.0, 0.0, 0.0]), (300, [None, 1.0, 1.0, 1.0])]
    rows += [(350, [2.0, 2.0]), (None, [3.0, 3.0, 3.0, 3.0]), (50, [1.0, 1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0, 1.0]), (400, [0.0] * 4), (-50, [-1.0] * 4)]
    got = found(spark, [(i, v) for i, v in rows if i != 50 or v != rows[50][1]])
    assert got == brute([(i, v) for i, v in rows if i != 50 or v != rows[50][1]])


@pytest.mark.parametrize("rows", [[], vectors(1), vectors(3), [(50, None)]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_repeated_queries(spark):
    """Rows equal in id and vector are one query, other vectors of the id are queries of their own."""
    rows = vectors(60, 4, seed=2)
    other = [9.0, -9.0, 9.0, 9.0]
    df = spark.createDataFrame([(i, v, 1, 2, "d", "v") for i, v in [*rows, rows[50], rows[50], (50, other)]], SCHEMA)
    got = sorted(tuple(r) for r in pivots.top_k(df.repartition(3)).collect() if r["query_id"] == 50)

    def best(vector):
        a = [math.floor(256 * float(np.float32(v))) for v in vector]
        held = [(i, [math.floor(256 * float(np.float32(v))) for v in b]) for i, b in rows if i != 50]
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in held)[:5]
        return [(50, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]

    assert got == sorted(best(rows[50][1]) + best(other))


def test_extreme_ids_and_components(spark):
    """The largest id is an id; vectors whose scores need not be exact take no part."""
    top = 2**63 - 1
    rows = [(0, [1.0, 1.0]), (top, [5.0, 5.0]), (None, [5.0, 5.0]), (3, [1e30, 1.0]), (4, [-3e38, 0.0]), (5, [2.0, 2.0])]
    got = {(r["rank"], r["vec_id"], r["score"]) for r in pivots.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert got == {(1, top, 655360), (2, None, 655360), (3, 5, 262144)}


def test_bounds_hold():
    rng = np.random.default_rng(4)
    rows, pivot = rng.integers(-300, 300, (200, 16)).astype(float), rng.integers(-300, 300, (6, 16)).astype(float)
    far = pivots.distances(rows, pivot)
    bound = np.abs(far[:, None] - far[None]).max(2)
    true = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(2))
    assert (bound <= true + 1e-6).all()


def test_far_pivot_hides_no_row(monkeypatch):
    """Distances near 1e8 lose units in single precision; scores differ by 10."""
    monkeypatch.setattr(pivots, "RUN", 4)
    rows, query, pivot = np.arange(90_000.0, 100_000.0)[:, None], np.array([[10.0]]), np.array([[-1e8]])
    queries = np.array([-1]), query, pivots.distances(query, pivot), np.array([-np.inf])
    held = np.arange(len(rows)), rows, pivots.distances(rows, pivot)
    ((_, _, scores),) = pivots.search_block(queries, held, 5)
    assert scores.tolist() == [999_990.0, 999_980.0, 999_970.0, 999_960.0, 999_950.0]

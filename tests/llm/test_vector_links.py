import math
import random

import numpy as np
import pytest

from moodtide.llm import common, vector_links

SCHEMA = "vec_id long, embedding array<{}>, label int, vector string, class int, n string, links int"


def brute(rows):
    sound = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    units = {}
    for k in sound:
        v = np.zeros(40)
        v[: len(rows[k][1])] = rows[k][1]
        v /= np.abs(v).max()
        units[k] = v / np.sqrt((v**2).sum())
    near = {k: [m for m in sound if m != k and units[k] @ units[m] >= 0.9] for k in sound}
    out = []
    for k, (vec_id, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for m in near.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        component = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((vec_id, len(near.get(k, [])), component, vec_id == component))
    return sorted(out, key=repr)


def found(spark, rows, kind="float", **settings):
    df = spark.createDataFrame([(i, v, 1, "v", 2, "n", 3) for i, v in rows], SCHEMA.format(kind)).repartition(4)
    return sorted((tuple(r) for r in vector_links.vector_links(df, **settings).collect()), key=repr)


def single(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def vectors(n, width=16, seed=0):
    rng = random.Random(seed)
    return [(i, single([rng.gauss(0, 1) for _ in range(width)])) for i in range(n)]


def groups(start, centres, size, spread, seed, width=16):
    rng = random.Random(seed)
    out = []
    for g in range(centres):
        centre = [rng.gauss(0, 1) for _ in range(width)]
        out += [(start + g * size + k, single([x + rng.gauss(0, spread) for x in centre])) for k in range(size)]
    return out


INF, NAN = float("inf"), float("nan")
ODD = [
    (900, None), (901, []), (902, [0.0] * 16), (903, [1.0, NAN]), (904, [INF, 1.0]), (905, [None, 1.0]), (906, [1.0]), (907, [2.0, 0.0]), (908, [-0.0, 1.0]),
    (909, [0.0, 1.0]), (None, [0.0, 1.0]), (None, [7.0, -9.0]), (910, [3e38, 3e38]), (911, [1e-40, 1e-40]), (912, [1.0, 1.0]), (912, [1.0, 1.0]), (913, [-1.0, -1.0]),
]


def test_equals_brute_force(spark):
    rows = vectors(300) + groups(1000, 20, 8, 0.1, 1) + groups(2000, 10, 20, 0.3, 2) + [(3000 + i, vectors(1)[0][1]) for i in range(30)]
    rows += [(i, single(v)) for i, v in ODD]
    assert found(spark, rows) == brute(rows)


def test_small_cells_and_tiles_and_hot_keys(spark, monkeypatch):
    for name, value in {"CELL_ROWS": 10, "RESIDENTS": 3, "VISITORS": 5}.items():
        monkeypatch.setattr(vector_links, name, value)
    monkeypatch.setattr(common.looked_up, "__defaults__", (3,))
    rows = vectors(60, seed=3) + groups(1000, 3, 25, 0.25, 4) + groups(1500, 1, 60, 0.05, 5) + [(3000 + i, vectors(1)[0][1]) for i in range(9)]
    assert found(spark, rows, "double") == brute(rows)


@pytest.mark.parametrize("rows", [[], vectors(1), [(1, None)], [(5, [1.0]), (3, [2.0])], [(None, [1.0]), (None, [1.0])]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_recall_at_the_threshold():
    """Pairs at the linking cosine, none of which the margin was fitted on, meet in a cell."""
    rng = np.random.default_rng(7)
    rows = rng.standard_normal((4000, 32))
    rows /= np.sqrt((rows**2).sum(1, keepdims=True))
    away = rng.standard_normal(rows.shape)
    away -= (away * rows).sum(1, keepdims=True) * rows
    others = 0.9 * rows + np.sqrt(0.19) * away / np.sqrt((away**2).sum(1, keepdims=True))
    grid = vector_links.Grid(*(vector_links.fit_codes(rows[:2000, s], 12, rng) for s in (slice(0, 16), slice(16, 32))))
    grid.fit_margin(rows[:2000], 0.9, vector_links.RECALL, rng)
    met = np.minimum(grid.excess(rows[2000:], others[2000:]), grid.excess(others[2000:], rows[2000:])) <= grid.margin
    assert met.mean() >= 0.99

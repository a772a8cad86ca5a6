import math
import re
from collections import defaultdict

import numpy as np
import pytest

from moodtide.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes):
    """Level filling by repetition: what a full source cannot take goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        held = sum(weight[s] for s in names if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / held > 2 * sizes[s]] if held else []
        if not over:
            return full | {s: left * weight[s] / held for s in names if s not in full}
        full |= {s: 2.0 * sizes[s] for s in over}
        left = 1.5 * sum(sizes.values()) - sum(full.values())


def check(rows, got):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size_of(r["text"])
    expected = targets_of(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], expected[r["source"]], abs_tol=1e-6)
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert len(got) == len(rows)
    return expected, taken


def test_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = mixing.mix(docs).collect()
    expected, taken = check(docs.collect(), got)
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(2, 0.02 * target)
    key = lambda rows: sorted((r["doc_id"], r["copies"]) for r in rows)
    assert key(mixing.mix(docs.repartition(7)).collect()) == key(got)


def test_rates_are_exponential_tilts(spark):
    """Before rounding: one tilt per source meets its target, as bisection finds it too."""
    rng = np.random.default_rng(5)
    sizes = {s: rng.integers(1, 400, 80) for s in (1, 2, 3)}
    counts = spark.createDataFrame([(s, int(z), 1) for s, zs in sizes.items() for z in zs], "source_no int, size long, docs long")
    counts = counts.groupBy("source_no", "size").sum("docs").withColumnRenamed("sum(docs)", "docs")
    aims = {1: 0.4, 2: 1.7, 3: 2.0}
    rows = [(s, int(z.sum()), float(aims[s] * z.sum()), float(z.mean()), int(z.min())) for s, z in sizes.items()]
    sources = spark.createDataFrame(rows, "source_no int, source_size long, target double, mean double, least long")
    for r in mixing.solve_tilts(counts, sources).collect():
        z = sizes[r["source_no"]] / sizes[r["source_no"]].mean()
        words = lambda tilt: (sizes[r["source_no"]] * np.minimum(2, np.exp(np.minimum(tilt * z, 700)))).sum()
        assert math.isclose(words(r["tilt"]), r["target"], rel_tol=1e-8)
        if r["target"] < 2 * sizes[r["source_no"]].sum():
            low, high = -1000.0, 1000.0
            for _ in range(200):
                low, high = ((low + high) / 2, high) if words((low + high) / 2) < r["target"] else (low, (low + high) / 2)
            assert math.isclose(r["tilt"], low, rel_tol=1e-5, abs_tol=1e-7)


def test_messy_documents(spark, messy):
    rows = messy.collect()
    expected, taken = check(rows, mixing.mix(messy).collect())
    assert expected[None] >= 0 and taken[None] <= 2 * 80
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns
    given = defaultdict(int)
    for r in mixed.collect():
        given[tuple(r)] += 1
    assert set(given) <= {tuple(r) for r in rows}
    # Empty texts are kept once; as many of the three equal rows of document 8 as the mix takes.
    assert given[next(tuple(r) for r in rows if r["doc_id"] == 6)] == 1
    eight = sum(r["copies"] for r in mixing.mix(messy).collect() if r["doc_id"] == 8)
    assert given[next(tuple(r) for r in rows if r["doc_id"] == 8)] == eight


def test_hot_source_and_equal_sizes(spark):
    rows = [(i, "a b c", "hot") for i in range(3000)] + [(i + 9000, "x " * (i % 7 + 1), f"s{i % 5}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected, taken = check(docs.collect(), mixing.mix(docs).collect())
    assert all(abs(taken[s] - t) <= 4 for s, t in expected.items())


def test_equal_rows_meet_the_target(spark):
    """Three sources of rows of ten words; the rows of one are equal in id and text."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a") for _ in range(300)] + [(i, f"{i} {text[4:]}", s) for s in "bc" for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    expected, taken = check(docs.collect(), got)
    assert all(abs(taken[s] - t) <= 10 for s, t in expected.items())
    mine = [r["copies"] for r in got if r["source"] == "a"]
    assert max(mine) - min(mine) <= 1
    held = mixing.mixed_documents(docs).groupBy("source").count().collect()
    assert {r["source"]: 10 * r["count"] for r in held} == dict(taken)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")], [(1, "one", "a")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(docs.collect(), mixing.mix(docs).collect())
    assert mixing.mixed_documents(docs).columns == docs.columns

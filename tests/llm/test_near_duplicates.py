import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from moodtide.llm import near_duplicates as near
from tests.llm.conftest import edited, prose


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_groups(rows, limit=0.8):
    """Smallest id of each group, by all pairs."""
    held = [shingles(t) for _, t in rows]
    n, df = len(rows), Counter(k for s in held for k in s)
    idf = {k: 1 + math.log((1 + n) / (1 + v)) / math.log(1 + n) for k, v in df.items()}
    total = [sum(c * idf[k] for k, c in s.items()) for s in held]
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            both = sum(min(c, held[j][k]) * idf[k] for k, c in held[i].items() if k in held[j])
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or both and both / (total[i] + total[j] - both) >= limit:
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i in range(n):
        ids[find(i)].append(rows[i][0])
    least = {g: min((d for d in v if d is not None), default=None) for g, v in ids.items()}
    return sorted(((rows[i][0], least[find(i)], len(ids[find(i)])) for i in range(n)), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["class_id"], r["group_rows"]) for r in near.near_duplicate_groups(df).collect()), key=repr)


def test_documents_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found(docs) == brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_messy_documents_equal_brute_force(spark, messy):
    assert found(messy) == brute_groups([(r["doc_id"], r["text"]) for r in messy.collect()])


def test_hot_groups_equal_brute_force(spark, monkeypatch):
    """Many copies, a large group of near copies at all similarities, and a passage in most texts."""
    monkeypatch.setattr(near, "SMALL", 6)
    monkeypatch.setattr(near, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near, "CHUNK_CHARS", 20_000)
    monkeypatch.setattr(near, "PART_CHARS", 50_000)
    rng, base, shared = random.Random(9), prose(90, 50), prose(60, 51)
    rows = [(i, base) for i in range(60)]
    for i in range(120):
        parts = base.split(" ")
        for at in rng.sample(range(90), rng.choice([1, 1, 2, 3, 4, 6])):
            parts[at] = f"other{rng.randint(0, 6)}"
        rows.append((100 + i, " ".join(parts)))
    rows += [(300 + i, shared + " " + prose(60, 1000 + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert found(df) == brute_groups(rows)


def test_one_of_each_group(spark, messy):
    kept = near.one_of_each_group(messy)
    assert kept.columns == messy.columns
    groups = brute_groups([(r["doc_id"], r["text"]) for r in messy.collect()])
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(texts) == len(set(texts)) and texts.count((8, "one two")) == 1
    firsts = {g[1] for g in groups if g[1] is not None}
    assert {d for d, _ in texts if d is not None} == firsts
    again = near.one_of_each_group(kept)
    assert again.count() == kept.count()


def test_no_documents(spark, no_documents):
    assert near.near_duplicate_groups(no_documents).isEmpty() and near.one_of_each_group(no_documents).isEmpty()


@pytest.mark.parametrize("weights", [(1.0, 1.0), (1.0, 4.0)])
def test_samples_agree_as_often_as_texts_are_similar(weights):
    """Consistent weighted sampling: equal samples in the share of the weighted similarity."""
    rng = np.random.default_rng(1)
    common = rng.integers(1, 2**63, 300, dtype=np.uint64)
    a, b = (np.concatenate((common, rng.integers(1, 2**63, n, dtype=np.uint64))) for n in (60, 40))
    sampler = near.Sampler(1.0, samples=1500)
    log_weight = np.log(weights[1]) * np.ones(100)
    special = np.arange(100)  # of the common shingles
    drawn = [sampler.samples(h, np.array([0]), special, log_weight)[0] for h in (a, b)]
    both = 200 + 100 * weights[1]
    expected = both / (both + 100)
    assert abs((drawn[0] == drawn[1]).mean() - expected) < 4 * math.sqrt(expected * (1 - expected) / 1500)


def test_packed_hashes():
    low = np.random.default_rng(2).integers(0, 2**near.LOW_BITS, 1000, dtype=np.uint64)
    assert (near.unpack(near.pack(low)) == low).all() and len(near.pack(low)) == 5000
    counts = np.array([1, 5, 1, 70_000], "<u4")
    assert near.counts_from(near.counts_bytes(counts), 4).tolist() == counts.tolist()


def test_small_changes_link(spark):
    text = prose(400, 77)
    rows = [(1, text), (2, edited(text, 200)), (3, text.upper().replace(" ", "  ")), (4, prose(400, 78)), (5, text[: len(text) // 2])]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1), (5, 5, 1)]


def test_limits_below_the_bands_are_refused(messy):
    with pytest.raises(ValueError, match="not from 0.7"):
        near.near_duplicate_groups(messy, 0.7)


def test_higher_limit_equals_brute_force(spark, messy):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    got = [(r["doc_id"], r["class_id"], r["group_rows"]) for r in near.near_duplicate_groups(messy, 0.95).collect()]
    assert sorted(got, key=repr) == brute_groups(rows, 0.95)

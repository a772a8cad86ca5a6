import math
import re
from collections import Counter

import pytest

from moodtide.llm import ranked
from tests.llm.conftest import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(documents, items, k=50):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    counts = [(doc_id, c, sum(c.values())) for doc_id, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item_id, text in {(i, t or "") for i, t in items}:
        scored = []
        for doc_id, c, n in counts:
            m, score = 50 + 50 * n * n_docs // n_terms, 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, r, None if d[1] else d[2], -d[0]) for r, d in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, documents, items, k=50):
    d = spark.createDataFrame([(*r, "clash", 1) for r in documents], "doc_id long, text string, item string, shard int").repartition(4)
    b = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in ranked.ranked_search(d, b, k).collect()), key=repr)


DOCUMENTS = [(i, prose(20 + i % 7 * 30, i)) for i in range(60)]
ITEMS = [(1, prose(15, 1)), (2, prose(400, 2)), (2, prose(30, 3)), (2, prose(30, 3)), (None, "The AN er"), (3, None), (4, " ,. "), (5, "nowhereword")]
ODD = [
    (100, None), (101, ""), (102, " \n.,\0"), (None, prose(30, 8)), (None, prose(30, 8)), (103, "Ünï É straße THE an-er_Er 中文 ing\x85st \xa0the"),
    (104, prose(8_000, 9)), (7, prose(30, 10)), (7, prose(30, 10)), (105, "the " * 5_000),
]


def test_equals_brute_force(spark):
    assert found(spark, DOCUMENTS + ODD, ITEMS) == brute(DOCUMENTS + ODD, ITEMS)


def test_small_shards_blocks_and_pieces(spark, monkeypatch):
    for name, value in {"SHARD_DOCS": 3, "SEEDS": 1, "BLOCK_BYTES": 300, "PIECE_BYTES": 7, "BLOCK_POSTINGS": 5}.items():
        monkeypatch.setattr(ranked, name, value)
    assert found(spark, DOCUMENTS + ODD, ITEMS, 4) == brute(DOCUMENTS + ODD, ITEMS, 4)


def test_ties_go_to_the_smallest_ids(spark):
    copies = [(1000 - i, prose(40, 1)) for i in range(200)]
    assert found(spark, DOCUMENTS + copies, ITEMS, 5) == brute(DOCUMENTS + copies, ITEMS, 5)


@pytest.mark.parametrize("documents, items", [([], ITEMS), (DOCUMENTS, []), ([], []), ([(1, None)], ITEMS)])
def test_empty_tables(spark, documents, items):
    assert found(spark, documents, items) == []


def test_bounds_are_reached_by_no_document(spark):
    """No score lies above its shard's bound, and most shards are not visited for a rare word."""
    documents = DOCUMENTS + [(500, "rareword " * 30)]
    items = [(1, "rareword")]
    assert found(spark, documents, items, 1) == brute(documents, items, 1)

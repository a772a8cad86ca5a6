import re
from collections import Counter

from moodtide.llm import decontaminate as dec
from pyspark.sql import functions as F
from tests.llm.conftest import prose


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def runs(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(documents, items):
    """Best window of each length over every place of every document."""
    out = {}
    for doc, text in set(documents):
        held = runs(words(text))
        for item, body in set(items):
            wanted, size = runs(words(body)), len(words(body))
            for start in range(max(0, len(held) - len(wanted)) + 1):
                window = held[start : start + len(wanted)]
                both = sum((Counter(window) & Counter(wanted)).values())
                value = both / (len(window) + len(wanted) - both) if both else 0
                if value >= 0.8:
                    key = (doc, text, item, body)
                    out[key] = max(out.get(key, (0, 0, 0)), (value, -start, size))
    return sorted(((k[0], k[2], round(v[0], 9), -v[1], v[2]) for k, v in out.items()), key=repr)


def found(spark, documents, items):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    got = dec.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    return sorted(((r["doc_id"], r["item_id"], round(r["similarity"], 9), r["word_start"], r["n_words"]) for r in got), key=repr)


ITEMS = [
    (1, prose(20, 1)), (2, prose(40, 2)), (2, prose(33, 3)), (3, "too short item"), (4, None), (5, ""), (None, prose(25, 4)), (6, "a b " * 8),
    (7, prose(20, 1)), (1, prose(20, 1)),
]


def with_change(text, at, change):
    w = text.split(" ")
    return " ".join(w[:at] + change + w[at + (0 if change else 1) :])


def test_equals_brute_force(spark):
    filler = [prose(40, 100 + i) for i in range(12)]
    documents = [(i, f) for i, f in enumerate(filler)]
    documents += [
        (20, filler[0] + " " + ITEMS[0][1] + " " + filler[1]), (21, ITEMS[1][1]), (22, ITEMS[1][1].upper() + "! " + filler[2]),
        (23, filler[3] + " " + with_change(ITEMS[1][1], 20, ["new"]) + " " + filler[4]), (24, with_change(ITEMS[1][1], 1, [])),
        (25, with_change(with_change(ITEMS[1][1], 10, ["p"]), 30, ["q"])), (26, with_change(ITEMS[1][1], 39, ["x", "y", "z"])),
        (27, " ".join(ITEMS[2][1].split(" ")[3:])), (28, " ".join(ITEMS[2][1].split(" ")[:20])), (29, "a b " * 30), (30, None), (31, ""), (32, "one two"),
        (None, ITEMS[6][1] + " " + ITEMS[0][1]), (33, ITEMS[6][1]), (33, ITEMS[6][1]), (33, filler[5] + ITEMS[0][1]),
    ]
    assert found(spark, documents, ITEMS) == brute(documents, ITEMS)


def test_hot_passage(spark):
    documents = [(i, prose(12, i) + " " + (ITEMS[1][1] if i % 2 else "") + " " + prose(9, -i)) for i in range(300)]
    got = found(spark, documents, ITEMS)
    assert [g[:3] for g in got] == sorted(((i, 2, 1.0) for i in range(1, 300, 2)), key=repr)


def test_blocks_find_all_within_the_radius(spark):
    rng = __import__("random").Random(4)
    prints = [rng.getrandbits(64) for _ in range(12)]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    items = spark.createDataFrame([(10, i, signed(p)) for i, p in enumerate(prints)], "_size int, _item long, _print long")
    windows, expected = [], set()
    for n in range(300):
        p = rng.choice(prints)
        for bit in rng.sample(range(64), rng.randint(0, 30)):
            p ^= 1 << bit
        windows.append((10, n, signed(p)))
        expected |= {(n, i) for i, q in enumerate(prints) if (p ^ q).bit_count() <= dec.RADIUS}
    table = spark.createDataFrame(windows, "_size int, _content long, _print long")
    got = {(r["_content"], r["_item"]) for r in dec.within_radius(table, items).collect()}
    assert got == expected


def test_fingerprints(spark):
    values = [[3, 5, -1], [7], [1 << 40, (1 << 40) | 1, 0, 0]]
    rows = [(i, v) for i, vs in enumerate(values) for v in vs]
    got = {r["k"]: r["_print"] for r in dec.fingerprints(spark.createDataFrame(rows, "k int, _run long"), "k").collect()}
    for i, vs in enumerate(values):
        expected = sum(1 << b for b in range(64) if 2 * sum((v >> b) & 1 for v in vs) > len(vs))
        assert got[i] % 2**64 == expected


def test_messy_documents(spark, messy):
    items = spark.createDataFrame([(1, messy.filter("doc_id = 4").first()["text"], "x")], "item_id long, text string, doc_id string")
    kept = dec.without_benchmark(messy, items)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 1
    assert kept.filter("doc_id = 4").isEmpty() and kept.filter(F.col("doc_id").isNull()).count() == 2


def test_empty_tables(spark, messy, no_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.contaminated(messy, none).isEmpty()
    assert dec.without_benchmark(messy, none).count() == messy.count()
    assert dec.without_benchmark(no_documents, spark.createDataFrame(ITEMS, "item_id long, text string")).isEmpty()

import hashlib
import random
import zlib

import pytest

from moodtide.llm import common, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, low long, n string, depth int, ka string, block string"


def brute(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            md5 = hashlib.md5((text or "").encode()).hexdigest()
            own.setdefault(conv_id, []).append(((turn is not None, turn or 0), role or "", md5, text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt = (own.get(base, [])[:h] + turns[h:]) if h else turns
        for d in range(len(rebuilt) + 1):
            nodes.setdefault(tuple(rebuilt[:d]), []).append((c, d == len(rebuilt)))
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in below)
        saved = sum((len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0) for p in below)
        ends = ",".join(str(c) for c in sorted(c for c, end in members if end))
        low = min(c for c, _ in members)
        parent = min(c for c, _ in nodes[prefix[:-1]]) if prefix else None
        out.append((low, len(prefix), parent, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "n", 2, "k", "b") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=repr)


def conversations(n, seed, longest=12, words=3):
    rng = random.Random(seed)
    return [
        (c, turn, rng.choice(["user", "assistant"]), f"t{rng.randrange(words)}")
        for c in rng.sample(range(-20, 200), n) for turn in range(rng.randint(1, longest))
    ]


ODD = [
    (1, None, "user", "x"), (1, 3, None, None), (1, 3, None, None), (1, 2, "user", "é中🎉"), (None, 1, "user", "lost"), (7, 1, "", ""), (7, 0, None, ""),
    (12, 5, "user", "w " * 20_000), (12, 5, "user", "v"), (12, 5, "assistant", "v"), (-7, 1, "user", "t0"),
]


def test_equals_brute_force(spark):
    rows = conversations(40, 1) + ODD
    assert found(spark, rows) == brute(rows)


def test_small_blocks_chunks_and_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    monkeypatch.setattr(prefix_trie, "ENDS_BITS", 1)
    monkeypatch.setattr(common.looked_up, "__defaults__", (2,))
    rows = conversations(15, 2, 40, 2) + [(500 + i, t, "user", f"same{t}") for i in range(30) for t in range(6)]
    rows += [(1000 + i, 0, "user", "same0") for i in range(20)] + [(400, t, "user", f"own{t}") for t in range(50)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "a")], [(3, 0, None, None)], [(4, 1, "user", "a")] * 3])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)

"""Prefix trie of conversations, by digests of fixed-length blocks of turns.

1. Turns are numbered: they are sorted by ranges of (conversation, turn), numbered within each range, and the few
   conversations that span several ranges get the sizes of the earlier ones added. A conversation may be of any length.
2. Conversations are rebuilt (``rebuilt_turns``) and cut into blocks of ``BLOCK`` turns. The digest of a prefix that
   ends with a block combines the digests of its blocks, each made with its place, so it is a running aggregate.
3. Conversations are grouped by successive block digests: one row for each different block after the same blocks.
   Where only one block follows, all its turns are nodes with the members of the block. Where siblings diverge, the
   blocks (not the conversations) are cut into turns and grouped again. A last block that is short is a sibling too.
4. Sums over subtrees take as many rounds as the longest conversation has binary digits: in each, a node gives what
   it holds to the ancestor 1, 2, 4, ... levels up and learns the ancestor twice as far.

Keys of prefixes are 128 bits of hashes over MD5 digests: equal keys count as equal prefixes. Keys that hold very many
rows, as those of a common first turn, are looked up by broadcast (``looked_up``); a conversation is handled in chunks
of ``CHUNK`` turns, and the ids of those that end at one node are joined in ranges and hashed as a stream.

Defined cases: NULL roles and texts are empty; turns are ordered by number (NULL first), then role, then MD5 of the
text; repeated rows are turns of their own; rows without a conversation id belong to no conversation; an empty table
has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.llm.common import looked_up, text_of
from moodtide.storage import store

BLOCK = 4
CHUNK = 4096
# Rebuilding: the group of conversations that share turns, and the largest number of shared turns plus one.
GROUP = 5
SHARED = 9
ENDS_BITS = 12


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place from 1), a, b (digest), bytes of every turn."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        text_of("role").alias("role"),
        F.md5(text_of("text")).alias("digest"),
        F.octet_length(text_of("text")).cast("long").alias("bytes"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id",
        F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().alias("place"),
        F.xxhash64(F.lit(1), "role", "digest").alias("a"),
        F.xxhash64(F.lit(2), "digest", "role").alias("b"),
        "bytes",
    )
    ranged = store(ranged, "ranged_turns")
    parts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range at most: a conversation in several ranges fills all but its first and last.
    before = parts.withColumn("before", F.sum("n").over(earlier)).filter("before IS NOT NULL").drop("n")
    within = Window.partitionBy("conv_id", "range").orderBy("place")
    local = ranged.withColumn("local", F.row_number().over(within).cast("long"))
    i = (F.col("local") + F.coalesce("before", F.lit(0))).alias("i")
    return local.join(F.broadcast(before), ["conv_id", "range"], "left").select("conv_id", i, "a", "b", "bytes")


def shared_turns(conv_id: str = "conv_id") -> Column:
    """How many first turns a conversation takes from the first one of its group."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string")), F.lit(SHARED)).cast("long")


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n, first (turns of the group's first conversation), shift of its own turns, length when rebuilt."""
    sizes = turns.groupBy("conv_id").agg(F.max("i").alias("n"))
    turn = F.struct("i", "a", "b", "bytes")
    heads = turns.filter(F.col("i") < SHARED).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("head"))
    base = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")
    joined = sizes.select("*", base, shared_turns().alias("h")).join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
    empty = F.array().cast("array<struct<i:bigint,a:bigint,b:bigint,bytes:bigint>>")
    first = F.slice(F.coalesce("head", empty), F.lit(1), F.col("h").cast("int")).alias("first")
    taken = joined.select("conv_id", "n", "h", first)
    return taken.select(
        "conv_id",
        "n",
        "first",
        (F.size("first") - F.col("h")).alias("shift"),
        (F.size("first") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
    )


def rebuilt_turns(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, length, pos (from 1), a, b, bytes of every turn of the rebuilt conversations."""
    chunk = F.floor(F.col("i") / CHUNK).alias("chunk")
    chunks = conversations.select(
        "conv_id", "shift", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / CHUNK))).alias("chunk")
    )
    own = turns.filter(F.col("i") > shared_turns()).select("*", chunk).join(chunks, ["conv_id", "chunk"])
    own = own.select("conv_id", "length", (F.col("i") + F.col("shift")).alias("pos"), "a", "b", "bytes")
    first = conversations.select("conv_id", "length", F.explode("first").alias("t"))
    return own.unionByName(first.select("conv_id", "length", F.col("t.i").alias("pos"), "t.a", "t.b", "t.bytes"))


def block_digests(turns: DataFrame) -> DataFrame:
    """conv_id, block, length, turns, and the digest of the prefix before (pa, pb) and with the block (qa, qb)."""
    block = F.floor((F.col("pos") - 1) / BLOCK).alias("block")
    blocks = turns.groupBy("conv_id", "length", block).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "bytes"))).alias("turns"))
    chunk = F.floor(F.col("block") / (CHUNK // BLOCK)).alias("chunk")
    blocks = store(
        blocks.select(
            "*", chunk, F.xxhash64("block", "turns.a").alias("xa"), F.xxhash64("turns.b", "block").alias("xb")
        ),
        "turn_blocks",
    )
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("conv_id", "chunk").agg(F.bit_xor("xa").alias("ya"), F.bit_xor("xb").alias("yb"))
    before = sums.select(
        "conv_id", "chunk", F.bit_xor("ya").over(earlier).alias("ca"), F.bit_xor("yb").over(earlier).alias("cb")
    ).filter("chunk > 0")
    upto = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    summed = blocks.withColumns({"za": F.bit_xor("xa").over(upto), "zb": F.bit_xor("xb").over(upto)})
    joined = summed.join(before, ["conv_id", "chunk"], "left")
    for lane in "ab":
        whole = F.col(f"z{lane}").bitwiseXOR(F.coalesce(f"c{lane}", F.lit(0)))
        joined = joined.withColumn(f"q{lane}", whole).withColumn(f"p{lane}", whole.bitwiseXOR(F.col(f"x{lane}")))
    return joined.select("conv_id", "block", "length", "turns", "pa", "pb", "qa", "qb")


def prefix_key(t: Column) -> tuple[Column, Column]:
    """Key of the node after the first ``t`` turns of a block: 0 is the prefix before, a whole block the one with it."""
    part = F.slice("turns", F.lit(1), t)
    a = F.xxhash64("pa", "pb", t, part["a"])
    b = F.xxhash64("pb", "pa", part["b"], t)
    start, full = t == 0, t == BLOCK
    return (
        F.when(start, F.col("pa")).when(full, F.col("qa")).otherwise(a),
        F.when(start, F.col("pb")).when(full, F.col("qb")).otherwise(b),
    )


def turn_nodes(groups: DataFrame) -> DataFrame:
    """The turns of grouped blocks: key, key of the parent, depth, members, smallest member, bytes of the last text."""
    each = groups.withColumn("t", F.explode(F.sequence(F.lit(1), F.size("turns"))))
    (ka, kb), (ua, ub) = prefix_key(F.col("t")), prefix_key(F.col("t") - 1)
    last = F.element_at("turns", F.col("t"))["bytes"].alias("bytes")
    depth = (F.col("block") * BLOCK + F.col("t")).alias("depth")
    return each.select(ka.alias("ka"), kb.alias("kb"), ua.alias("ua"), ub.alias("ub"), depth, "n", "low", last)


def trie_nodes(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes: ka, kb, ua, ub (parent, NULL for the root), depth, n, low, bytes."""
    place = ["block", "pa", "pb"]
    groups = blocks.groupBy(*place, "qa", "qb").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("low"), F.first("turns").alias("turns")
    )
    groups = store(groups, "different_blocks")
    following = groups.groupBy(*place).agg(F.count("*").alias("following"))
    groups = store(looked_up(groups, place, following), "placed_blocks")
    alone = turn_nodes(groups.filter("following = 1"))
    diverging = turn_nodes(groups.filter("following > 1"))
    refined = diverging.groupBy("ka", "kb", "ua", "ub", "depth").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.first("bytes").alias("bytes")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = conversations.agg(F.count("*").alias("n"), F.min("conv_id").alias("low")).filter("n > 0").select(
        zero.alias("ka"), zero.alias("kb"), none.alias("ua"), none.alias("ub"), zero.alias("depth"), "n", "low", zero.alias("bytes")
    )
    return alone.unionByName(refined).unionByName(root)


def subtree_sums(nodes: DataFrame, names: list[str]) -> DataFrame:
    """ka, kb and the sums of ``names`` over the subtree of every node. ``nodes``: ka, kb, ua, ub, depth, names."""
    deepest = nodes.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("depth")).first()["depth"]
    state, step = nodes, 1
    while step <= deepest:
        given = state.filter(F.col("ua").isNotNull()).groupBy("ua", "ub").agg(*(F.sum(c).alias(f"more_{c}") for c in names))
        given = given.withColumnsRenamed({"ua": "ka", "ub": "kb"})
        grown = state.join(given, ["ka", "kb"], "left").select(
            "ka", "kb", "ua", "ub", "depth", *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in names)
        )
        step *= 2
        far = state.select(F.col("ka").alias("ua"), F.col("kb").alias("ub"), F.col("ua").alias("fa"), F.col("ub").alias("fb"))
        deep = looked_up(grown.filter(F.col("depth") >= step), ["ua", "ub"], far)
        none = F.lit(None).cast("long")
        deep = deep.select("ka", "kb", F.col("fa").alias("ua"), F.col("fb").alias("ub"), "depth", *names)
        flat = grown.filter(F.col("depth") < step).select("ka", "kb", none.alias("ua"), none.alias("ub"), "depth", *names)
        state = store(deep.unionByName(flat), "subtree_sums")
    return state.select("ka", "kb", *names)


def ends_digests(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """ka, kb, ends_sha256 of the nodes at which conversations end."""
    last = blocks.filter(F.col("block") == F.floor((F.col("length") - 1) / BLOCK))
    ka, kb = prefix_key(F.size("turns"))
    zero = F.lit(0).cast("long")
    ends = last.select(ka.alias("ka"), kb.alias("kb"), "conv_id").unionByName(
        conversations.filter("length = 0").select(zero.alias("ka"), zero.alias("kb"), "conv_id")
    )
    stretch = F.shiftright("conv_id", ENDS_BITS).alias("stretch")
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    stretches = ends.groupBy("ka", "kb", stretch).agg(ids)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if key != (row["ka"], row["kb"]):
                    if key is not None:
                        done.append((*key, held.hexdigest()))
                    key, held = (row["ka"], row["kb"]), hashlib.sha256(row["ids"].encode())
                else:
                    held.update(b"," + row["ids"].encode())
            yield rows(done)
        if key is not None:
            yield rows([(*key, held.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[], [], []]
        arrays = [pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["ka", "kb", "ends_sha256"])

    dealt = stretches.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "stretch")
    return dealt.mapInArrow(digest, "ka long, kb long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (bytes that members after the first repeat within the subtree), ends_sha256."""
    turns = store(numbered_turns(conversations), "numbered_turns")
    rebuilt = store(rebuilt_conversations(turns), "rebuilt")
    blocks = store(block_digests(rebuilt_turns(turns, rebuilt)), "block_digests")
    nodes = store(trie_nodes(blocks, rebuilt), "trie_nodes")

    key = ["ka", "kb"]
    children = nodes.filter(F.col("ua").isNotNull()).groupBy("ua", "ub").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children.withColumnsRenamed({"ua": "ka", "ub": "kb"}), key, "left").fillna(0, ["n_children"])
    nodes = store(nodes, "counted_nodes")
    held = nodes.select(
        *key, "ua", "ub", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved_tokens"),
    )
    sums = subtree_sums(held, ["n_leaves", "saved_tokens"])
    parents = nodes.select(F.col("ka").alias("ua"), F.col("kb").alias("ub"), F.col("low").alias("parent_conv_id"))
    named = looked_up(nodes, ["ua", "ub"], parents)
    whole = named.join(sums, key).join(ends_digests(blocks, rebuilt), key, "left")
    return whole.select(
        F.col("low").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

A document is contaminated by a benchmark item when one of its windows, as many words long as the
item, has a weighted similarity of at least 0.8 with it: five-word shingles weighted by how often
they occur, sum of the smaller weights over sum of the larger ones.

1. Windows. A window can only match an item if they share a shingle. Shared shingles (document
   position p, item position q) put the window at p - q; where an insertion or deletion leaves
   several such places, every place between neighbouring ones is taken too. A window left of the
   first place gains by moving right, one right of the last by moving left, so no better window is
   left out. Windows at the ends are moved inside; a document shorter than the item is one window.
2. SimHash. Windows with equal content are one window, however many documents hold it. Each
   shingle adds its occurrence to 64 bit counts; the fingerprint holds the majorities.
3. Multi-index. Fingerprints are cut into ``BLOCKS`` blocks. Two that differ in at most ``RADIUS``
   bits differ in at most RADIUS // BLOCKS bits of some block, so items are entered under every
   value that close, and windows are looked up by their own blocks: all pairs within the radius are
   found. Only items as long as the window was made for are looked up.
4. The exact similarity decides.

DataFrame functions only. Words are lower-case runs of letters and digits, shingles 64-bit hashes.

Defined cases: NULL and empty texts, and texts or items under five words, hold no shingle and match
nothing; repeated documents are found alike, rows equal in id and text once; items equal in id and
text count once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.llm.common import SHINGLE_WORDS, measured_bytes, row_key, text_of, without_rows, words
from moodtide.storage import store

SIMILARITY = 0.8
BITS = 64
RADIUS = 20
BLOCKS = 8
BROADCAST_BYTES = 64 * 1024 * 1024


def shingles(text: Column) -> Column:
    """Hashes of all five-word runs, in order."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        last = F.size(h) - SHINGLE_WORDS
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(SHINGLE_WORDS))))

    # A one-element array names the hashes once, so that they are not computed per run.
    return F.flatten(F.transform(F.array(hashes), runs))


def broadcast_if_small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """A broadcast hint for a stored table that is measured to fit; else the join shuffles."""
    return F.broadcast(df) if measured_bytes(df, row_bytes) <= BROADCAST_BYTES else df


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Items with at least one shingle: item_id, _item (row hash), _size (words), _runs."""
    rows = benchmark.select("item_id", F.xxhash64("item_id", text_of("text")).alias("_item"), shingles(text_of("text")).alias("_runs"))
    held = rows.filter(F.size("_runs") > 0).dropDuplicates(["_item"])
    return held.withColumn("_size", F.size("_runs") + SHINGLE_WORDS - 1)


def window_places(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, _row, _size, _start: where documents share shingles with items, by item length."""
    entries = store(
        items.select("_item", "_size", F.posexplode("_runs").alias("_at", "_run")), "benchmark_runs"
    )
    runs = documents.select("doc_id", row_key().alias("_row"), F.posexplode(shingles(text_of("text"))).alias("_pos", "_run"))
    hits = runs.join(broadcast_if_small(entries, F.lit(32)), "_run")
    places = hits.select("doc_id", "_row", "_item", "_size", (F.col("_pos") - F.col("_at")).alias("_start")).distinct()
    along = Window.partitionBy("doc_id", "_row", "_item").orderBy("_start")
    following = F.lead("_start").over(along)
    near = following.isNotNull() & (following - F.col("_start") <= F.col("_size"))
    starts = F.sequence("_start", F.when(near, following - 1).otherwise(F.col("_start")))
    return places.select("doc_id", "_row", "_size", starts.alias("_starts")).select(
        "doc_id", "_row", "_size", F.explode("_starts").alias("_start")
    ).distinct()


def window_contents(documents: DataFrame, places: DataFrame) -> DataFrame:
    """doc_id, _row, _size, _start and the shingle hashes of each window."""
    per_document = store(
        places.groupBy("doc_id", "_row").agg(F.collect_list(F.struct("_size", "_start")).alias("_places")), "window_places"
    ).select(F.col("doc_id").alias("_doc"), F.col("_row").alias("_hash"), "_places")
    here = broadcast_if_small(per_document, F.size("_places") * 16 + 48)
    texts = documents.select("doc_id", row_key().alias("_row"), "text")
    found = texts.join(here, texts["doc_id"].eqNullSafe(here["_doc"]) & (texts["_row"] == here["_hash"]))
    once = found.select("doc_id", "_row", "_places", shingles(text_of("text")).alias("_runs"))
    windows = once.select("doc_id", "_row", "_runs", F.inline("_places"))
    wanted = F.col("_size") - SHINGLE_WORDS + 1
    first = F.greatest(F.least(F.col("_start"), F.size("_runs") - wanted), F.lit(0))
    return windows.select(
        "doc_id", "_row", "_size", first.alias("_start"), F.slice("_runs", first + 1, wanted).alias("_window")
    )


def fingerprints(runs: DataFrame, *keys: str) -> DataFrame:
    """64-bit SimHash per key, from rows (keys, _run): one row per occurrence of a shingle.

    Bit counts are summed three to a number, in lanes of 21 bits: 64 sums are too many for one
    compiled aggregate.
    """
    lane, sums = 21, -(-BITS // 3)

    def bit(number: int) -> Column:
        return F.shiftright("_run", number).bitwiseAND(F.lit(1))

    def packed(first: int) -> Column:
        held = [number for number in range(first, BITS, sums)]
        return reduce(Column.__add__, (F.shiftleft(bit(n).cast("long"), lane * i) for i, n in enumerate(held)))

    counted = runs.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.sum(packed(i)).alias(f"_b{i}") for i in range(sums)))

    def majority(number: int) -> Column:
        count = F.shiftright(f"_b{number % sums}", lane * (number // sums)).bitwiseAND(F.lit(2**lane - 1))
        return F.when(2 * count > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), number)).otherwise(F.lit(0).cast("long"))

    return counted.select(*keys, reduce(Column.bitwiseOR, map(majority, range(BITS))).alias("_print"))


def blocks(fingerprint: Column) -> Column:
    width = BITS // BLOCKS
    parts = (F.shiftright(fingerprint, b * width).bitwiseAND(F.lit(2**width - 1)) for b in range(BLOCKS))
    return F.array(*(F.struct(F.lit(b).alias("_block"), part.alias("_value")) for b, part in enumerate(parts)))


def near_values(value: Column) -> Column:
    """All block values that differ from ``value`` in at most RADIUS // BLOCKS bits."""
    width = BITS // BLOCKS
    flips = [m for m in range(2**width) if m.bit_count() <= RADIUS // BLOCKS]
    return F.transform(F.array(*map(F.lit, flips)), lambda m: value.bitwiseXOR(m.cast("long")))


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs (_size, _content, _item) of fingerprints that differ in at most RADIUS bits."""
    looked_up = windows.select("_size", "_content", "_print", F.inline(blocks(F.col("_print"))))
    entered = items.select("_size", "_item", F.col("_print").alias("_item_print"), F.inline(blocks(F.col("_print"))))
    entered = store(entered.withColumn("_value", F.explode(near_values(F.col("_value")))), "hamming_blocks")
    close = F.bit_count(F.col("_print").bitwiseXOR(F.col("_item_print"))) <= RADIUS
    pairs = looked_up.join(broadcast_if_small(entered, F.lit(48)), ["_size", "_block", "_value"]).filter(close)
    return pairs.select("_size", "_content", "_item").distinct()


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, _row, item_id, similarity, word_start, n_words: the best window per document and item."""
    items = store(benchmark_items(benchmark), "benchmark_items")
    places = window_places(documents, items)
    content = F.xxhash64("_window").alias("_content")
    windows = store(window_contents(documents, places).select("*", content), "windows")
    distinct = store(
        windows.groupBy("_size", "_content").agg(F.first("_window").alias("_window")), "distinct_windows"
    )
    window_runs = distinct.select("_size", "_content", F.explode("_window").alias("_run"))
    item_runs = items.select("_size", "_item", F.explode("_runs").alias("_run"))
    pairs = within_radius(fingerprints(window_runs, "_size", "_content"), fingerprints(item_runs, "_size", "_item"))
    alike = window_similarity(pairs, distinct, items).filter(F.col("similarity") >= similarity)
    matched = store(alike.join(items.select("_item", "item_id"), "_item"), "matches")
    best = F.max(F.struct("similarity", (-F.col("_start")).alias("_back"))).alias("_best")
    found = windows.drop("_window").join(broadcast_if_small(matched, F.lit(64)), ["_size", "_content"])
    return found.groupBy("doc_id", "_row", "_item", "item_id", "_size").agg(best).select(
        "doc_id",
        "_row",
        "item_id",
        F.col("_best.similarity").alias("similarity"),
        (-F.col("_best._back")).cast("long").alias("word_start"),
        F.col("_size").cast("long").alias("n_words"),
    )


def window_similarity(pairs: DataFrame, windows: DataFrame, items: DataFrame) -> DataFrame:
    """Exact weighted similarity of each pair: shared occurrences over all occurrences."""
    counted = lambda rows, *keys: rows.groupBy(*keys, "_run").agg(F.count("*").alias("_times"))
    item_counts = counted(items.select("_item", F.explode("_runs").alias("_run")), "_item")
    held = pairs.join(windows, ["_size", "_content"]).withColumn("_all", F.size("_window"))
    window_counts = counted(
        held.select("_size", "_content", "_item", "_all", F.explode("_window").alias("_run")),
        "_size", "_content", "_item", "_all",
    )
    shared = window_counts.join(item_counts.withColumnRenamed("_times", "_item_times"), ["_item", "_run"])
    both = shared.groupBy("_size", "_content", "_item", "_all").agg(
        F.sum(F.least("_times", "_item_times")).alias("_both")
    )
    union = F.col("_all") + F.col("_size") - SHINGLE_WORDS + 1 - F.col("_both")
    return both.select("_size", "_content", "_item", (F.col("_both") / union).alias("similarity"))


def without_benchmark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item contaminates."""
    bad = contaminated(documents, benchmark).select("doc_id", "_row").distinct()
    return without_rows(documents, store(bad, "contaminated"))

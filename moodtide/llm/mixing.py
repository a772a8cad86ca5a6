"""Mixing sources to target weights by entropy balancing.

Sizes are words. Every source gets a target (weights in turn, filled up to a limit), and every
document a rate: of all rates between 0 and ``MOST`` that meet the targets, those closest to "one copy
each" in relative entropy. They are exponential tilts of the document's size,

    rate = min(MOST, exp(tilt * size / mean size)),   one tilt per source,

and the tilts solve the convex dual, by Newton steps on the logarithm of the words taken. A rate
depends on source and size only, so each step is one aggregation of the counts by (source, size).

Rates become whole copies without drawing lots: sizes of a source are visited from the largest down,
each takes the nearest whole number of copies and hands its error on to the next, so a source misses
its target by about its smallest document at most. Inside one size the extra copies go to the lowest
hashes of id and text; rows equal in id, text and source are dealt with as one row with a count, so that
they take no more than their part. Reruns agree.

Defined cases: NULL and empty texts have size 0 and are kept once; a NULL source is a source of its
own, the last one; rows equal in id, text and source are documents of their own, whose copies differ by
one at most; a source without words has target 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from moodtide.llm.common import packed, row_key
from moodtide.storage import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
STEPS = 60
CLOSE = 1e-10
# Documents of one size that are ranked together; larger groups are dealt into so many cells.
CELL_ROWS = 512
BROADCAST_ROWS = 500_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Target per source of a table (source, source_size), which has one row per source.

    A source takes ``level * weight`` words up to its limit, with one level for all that leaves no
    words over. Visited by limit per weight, the level rises while sources hit their limit and falls
    after that, so it is the largest value on the way.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((number - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    weighed = sources.select("*", number.alias("source_no"), weight.cast("double").alias("weight")).select(
        "*", (MOST * F.col("source_size")).cast("double").alias("limit")
    )
    before = Window.orderBy(F.col("limit") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    spent, used = (F.coalesce(F.sum(name).over(before), F.lit(0.0)) for name in ("limit", "weight"))
    words, weight_sum = share * F.sum("source_size").over(everything), F.sum("weight").over(everything)
    level = F.max("level").over(everything)
    return (
        weighed.withColumn("level", (words - spent) / (weight_sum - used))
        .withColumn("target", F.least("limit", level * F.col("weight")))
        .drop("level", "limit", "weight")
    )


def counts_by_size(units: DataFrame) -> DataFrame:
    return units.groupBy("source", "size").agg(F.sum("n").alias("docs"))


def tilted(tilt: Column, size: Column, mean: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.least(tilt * size / mean, F.lit(700.0))))


def solve_tilts(counts: DataFrame, sources: DataFrame, steps: int = STEPS) -> DataFrame:
    """Newton steps for all sources at once, each kept inside the bracket found so far.

    ``counts``: source_no, size, docs. ``sources``: source_no, source_size, target, mean, least.
    """
    size, mean = F.col("size"), F.col("mean")
    full = F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)
    # At the limit every document takes all it may; without words or target there is nothing to tilt.
    start = F.when(F.col("target") <= 0, F.lit(0.0)).when(full, 1.01 * F.log(F.lit(float(MOST))) * mean / F.col("least"))
    state = store(
        sources.select(
            "source_no",
            "target",
            "mean",
            F.coalesce(start, F.lit(0.0)).alias("tilt"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            start.isNotNull().alias("done"),
        ),
        "tilts",
    )
    held = F.col("docs") * size
    for _ in range(steps):
        if state.filter(~F.col("done")).isEmpty():
            break
        rate = tilted(F.col("tilt"), size, mean)
        sums = (
            counts.join(state.filter(~F.col("done")), "source_no")
            .groupBy("source_no")
            .agg(
                F.sum(held * rate).alias("taken"),
                F.sum(F.when(rate < MOST, held * rate * size / mean).otherwise(0.0)).alias("slope"),
            )
        )
        tilt, target, taken = F.col("tilt"), F.col("target"), F.col("taken")
        low = F.when(taken < target, tilt).otherwise(F.col("low"))
        high = F.when(taken < target, F.col("high")).otherwise(tilt)
        newton = tilt + F.log(target / taken) * taken / F.col("slope")
        # Where the step leaves the bracket: its middle, or further out while one side is open.
        further = F.when(taken < target, F.greatest(2 * tilt, tilt + 1)).otherwise(F.least(2 * tilt, tilt - 1))
        bounded = (F.col("low") > float("-inf")) & (F.col("high") < float("inf"))
        inside = (newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton - tilt) <= 64)
        step = F.when(inside, newton).when(bounded, (F.col("low") + F.col("high")) / 2).otherwise(further)
        close = F.abs(taken - target) <= CLOSE * target
        moved = state.join(sums, "source_no", "left").withColumn("low", F.when(taken.isNull(), F.col("low")).otherwise(low))
        moved = moved.withColumn("high", F.when(taken.isNull(), F.col("high")).otherwise(high))
        halted = F.col("done") | F.coalesce(close, F.lit(True))
        state = store(
            moved.select(
                "source_no", "target", "mean", F.when(halted, tilt).otherwise(step).alias("tilt"), "low", "high",
                halted.alias("done"),
            ),
            "tilts",
        )
    return state


COPIES = "source_no int, size long, docs long, copies long"


def whole_copies(rates: DataFrame) -> DataFrame:
    """Copies of all documents of one (source, size): the group holds one row per distinct size of a source."""

    def diffuse(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False)
        copies, over = [], 0.0
        for size, docs, rate in zip(group["size"], group["docs"], group["rate"], strict=True):
            wanted = docs * rate
            whole = int(min(max(round(wanted - (over / size if size else 0.0)), 0), MOST * docs))
            over += (whole - wanted) * size
            copies.append(whole)
        return group.assign(copies=copies)[["source_no", "size", "docs", "copies"]]

    return rates.groupBy("source_no").applyInPandas(diffuse, COPIES)


def deal_copies(units: DataFrame, plan: DataFrame) -> DataFrame:
    """Copies of all rows of a unit (rows equal in id, text and source; ``n`` of them): rows of one group get the same
    number of copies, and the rest of the group's one more in order of a hash."""
    hashed = F.xxhash64("doc_id", "_row")
    cells = F.ceil(F.col("docs") / CELL_ROWS)
    small = plan.count() <= BROADCAST_ROWS
    placed = units.join(F.broadcast(plan) if small else plan, ["source_no", "size"]).select(
        "*", F.pmod(hashed, cells).alias("cell"), (F.col("copies") % F.col("docs")).alias("extra")
    )
    placed = placed.withColumn("each", F.floor(F.col("copies") / F.col("docs")))
    group = ["source_no", "size"]
    upto = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    held = placed.groupBy(*group, "cell").agg(F.sum("n").alias("held"), F.first("extra").alias("extra"), F.first("docs").alias("docs"))
    share = lambda rows: F.floor(F.col("extra") * (rows / F.col("docs")))
    summed = F.sum("held").over(upto)
    quota = held.select(*group, "cell", (share(summed) - share(summed - F.col("held"))).alias("quota"))
    order = Window.partitionBy(*group, "cell").orderBy(F.xxhash64("_row", "doc_id"), "doc_id", "_row")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = F.greatest(F.lit(0), F.least("n", F.col("quota") - before))
    return placed.join(quota, [*group, "cell"]).withColumn("copies", (F.col("each") * F.col("n") + more).cast("long"))


def dealt_units(documents: DataFrame, weights: Sequence[int], share: float) -> DataFrame:
    """doc_id, source, _row, n (equal rows), size, source_size, target, copies of all n together."""
    sized = documents.select("doc_id", "source", row_key().alias("_row"), word_count().alias("size"))
    units = store(sized.groupBy("doc_id", "source", "_row", "size").agg(F.count("*").alias("n")), "sizes")
    counts = store(counts_by_size(units), "size_counts")
    held = F.sum(F.col("size") * F.col("docs")).alias("source_size")
    worded = F.sum(F.when(F.col("size") > 0, F.col("docs")))
    sources = counts.groupBy("source").agg(
        held, (F.sum(F.col("size") * F.col("docs")) / worded).alias("mean"), F.min(F.nullif("size", F.lit(0))).alias("least")
    )
    sources = store(targets(sources, weights, share), "targets")
    named = sources.select(F.col("source").alias("_source"), "source_no")
    numbered = F.col("source").eqNullSafe(F.col("_source"))
    counts = store(counts.join(named, numbered).select("source_no", "size", "docs"), "numbered_counts")
    tilts = solve_tilts(counts, sources).select("source_no", "tilt", "mean")
    rate = F.when(F.col("size") > 0, tilted(F.col("tilt"), F.col("size"), F.col("mean"))).otherwise(1.0)
    rates = counts.join(tilts, "source_no").withColumn("rate", rate)
    plan = store(whole_copies(rates.select("source_no", "size", "docs", "rate")), "copies")
    small = sources.count() <= BROADCAST_ROWS
    placed = units.join(F.broadcast(named) if small else named, numbered).drop("_source")
    dealt = deal_copies(placed, plan)
    extras = sources.select("source_no", "source_size", "target")
    return dealt.join(F.broadcast(extras) if small else extras, "source_no").select(
        "doc_id", "source", "_row", "n", "size", "source_size", "target", "copies"
    )


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """doc_id, source, _row (hash of the text), size, source_size, target, copies: one row per document."""
    dealt = dealt_units(documents, weights, share).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("i") <= F.col("copies") % F.col("n")).cast("long")
    return dealt.select("doc_id", "source", "_row", "size", "source_size", "target", own.alias("copies"))


def mixed_documents(documents: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The rows of the mix: every document as often as it has copies.

    What copies of equal rows do not divide by their number comes from one of the rows.
    """
    key = ["doc_id", "source", "_row"]
    dealt = store(dealt_units(documents, weights, share).select(*key, "n", "copies"), "dealt_units")
    rows = packed(documents).withColumn("source", F.col("_document.source"))

    def same_key(named: DataFrame):
        on = F.lit(True)
        for name in key:
            on = on & F.col(name).eqNullSafe(named[f"_{name}_"])
        return on

    def taken(rows: DataFrame, times: DataFrame) -> DataFrame:
        named = times.filter("times > 0").select(*(F.col(name).alias(f"_{name}_") for name in key), "times")
        copies = F.explode(F.sequence(F.lit(1).cast("long"), "times"))
        return rows.join(named, same_key(named)).select("_document", copies).select("_document.*")

    mixed = taken(rows, dealt.withColumn("times", F.floor(F.col("copies") / F.col("n"))))
    uneven = store(dealt.withColumn("times", F.col("copies") % F.col("n")).filter("times > 0"), "uneven_units")
    few = uneven.count()
    if few == 0:
        return mixed
    named = uneven.select(*(F.col(name).alias(f"_{name}_") for name in key))
    named = F.broadcast(named) if few <= BROADCAST_ROWS else named
    return mixed.unionByName(taken(rows.join(named, same_key(named), "left_semi").dropDuplicates(key), uneven))

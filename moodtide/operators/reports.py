"""Counts, shares, pivots and top lists.

Every grouping combines on the map side, so a class, place, day or tag that holds a large part of
the rows costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from moodtide.functions.dates import day_string, parse_day
from moodtide.functions.numbers import epoch_seconds
from moodtide.functions.text import not_blank, tag_pieces
from moodtide.operators.filters import filtered, members, require_columns, with_key
from moodtide.schemas import CATEGORIES, NEGATIVE, NEUTRAL, POSITIVE

CLASS = "sentiment_category"
SCORE = "sentiment_score"


# Counts by class.


def class_distribution(scored: DataFrame, *keys: str) -> DataFrame:
    """Rows and mean score per class (and key), largest first; the mean of unknown is NULL."""
    return (
        scored.groupBy(*keys, CLASS)
        .agg(F.count("*").alias("count"), F.avg(SCORE).alias("avg_score"))
        .orderBy(*keys, F.desc("count"), CLASS)
    )


def class_counts(scored: DataFrame, *keys: str, times: str | None = None) -> DataFrame:
    """Records per key and class, unordered.

    ``times`` names a column with the number of records a row stands for, in tables that were
    counted before a join.
    """
    require_columns(scored, [*keys, CLASS])
    records = F.count("*") if times is None else F.sum(times)
    return scored.groupBy(*keys, CLASS).agg(records.alias("count"))


def platform_class_counts(scored: DataFrame) -> DataFrame:
    return class_counts(scored, "platform").orderBy("platform", "count", CLASS)


def class_by_day(scored: DataFrame, zone: str | None = None) -> DataFrame:
    dated = scored.withColumn("date", day_string(F.col("create_time"), zone))
    return class_counts(dated, "date").orderBy("date", CLASS)


def class_by_location(scored: DataFrame, times: str | None = None) -> DataFrame:
    """Records per place and class, largest first; those without a place are left out."""
    placed = with_key(scored, "ip_location")
    return class_counts(placed, "ip_location", times=times).orderBy(F.desc("count"), "ip_location", CLASS)


# Comments.


def comments_per_day(comments: DataFrame, zone: str | None = None) -> DataFrame:
    """Comments per day; days without any are not filled in."""
    day = day_string(epoch_seconds(F.col("create_time")), zone)
    return (
        comments.groupBy(day.alias("comment_date")).agg(F.count("*").alias("num_comments")).orderBy("comment_date")
    )


def note_comment_stats(notes: DataFrame, comments: DataFrame) -> DataFrame:
    """Declared and actual comment counts per note, most commented first.

    The same rows as a left join followed by a grouping, but both sides are grouped before the join:
    a note with very many comments, or very many copies, reaches the join as a single row.
    """
    copies = notes.groupBy("note_id", "title", "liked_count", "comment_count").agg(F.count("*").alias("copies"))
    actual = comments.groupBy("note_id").agg(F.count("comment_id").alias("actual"))
    return (
        copies.join(actual, "note_id", "left")
        .select(
            "note_id",
            "title",
            F.coalesce("liked_count", F.lit(0)).alias("liked_count"),
            F.coalesce("comment_count", F.lit(0)).alias("note_declared_comment_count"),
            (F.col("copies") * F.coalesce("actual", F.lit(0))).alias("actual_comment_count"),
        )
        .orderBy(F.desc("actual_comment_count"), "note_id", "title")
    )


def orphan_comments(notes: DataFrame, comments: DataFrame) -> DataFrame:
    """How many comments, under how many note ids, have no note and so miss from the note statistics."""
    return (
        comments.groupBy("note_id")
        .agg(F.count("*").alias("n"))
        .join(notes.select("note_id").distinct(), "note_id", "left_anti")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_comments"), F.count("*").alias("missing_notes"))
    )


# Tags.


def tag_frequency(notes: DataFrame) -> DataFrame:
    """Occurrences per lower-case tag, most frequent first; repeats within a note all count."""
    return (
        with_key(notes, "tag_list")
        .select(F.explode(tag_pieces(F.col("tag_list"))).alias("piece"))
        .select(F.lower(F.trim("piece")).alias("tag"))
        .filter(not_blank(F.col("tag")))
        .groupBy("tag")
        .agg(F.count("*").alias("tag_count"))
        .orderBy(F.desc("tag_count"), "tag")
    )


# Totals, shares and pivots over the count tables.


def class_shares(distribution: DataFrame) -> DataFrame:
    """Total, count and percent per class in one row; unknown counts in the total only."""
    shown = (POSITIVE, NEGATIVE, NEUTRAL)
    counts = distribution.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(F.col(CLASS) == name, F.col("count"))), F.lit(0)).alias(name) for name in shown],
    )
    return counts.withColumns(
        {f"{name}_percent": F.coalesce(F.try_divide(F.col(name), "total") * 100, F.lit(0.0)) for name in shown}
    )


def class_pivot(counts: DataFrame, index: str) -> DataFrame:
    """One row per index value, one column per class, 0 where a combination is absent."""
    require_columns(counts, [index, CLASS, "count"])
    return (
        counts.groupBy(index)
        .pivot(CLASS, CATEGORIES)
        .agg(F.sum("count"))
        .fillna(0, subset=CATEGORIES)
        .orderBy(index)
    )


def day_class_pivot(counts: DataFrame) -> DataFrame:
    """Class counts per day, ordered by the parsed date."""
    return class_pivot(counts.withColumn("date", parse_day(F.col("date"))), "date")


def location_totals(by_location: DataFrame, category: str | None = None) -> DataFrame:
    """Rows per place, all classes or one, largest first."""
    return (
        filtered(by_location, **{CLASS: category})
        .groupBy("ip_location")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "ip_location")
    )


def top_location_classes(by_location: DataFrame, n: int, category: str | None = None) -> DataFrame:
    """Class counts of the ``n`` places with most rows. Takes the whole count table, not a cut one."""
    chosen = filtered(by_location, **{CLASS: category})
    return members(chosen, location_totals(chosen).limit(n), "ip_location")


# Row counts, distinct values, samples.


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per named table."""
    parts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def counts_with_valid(name: str, df: DataFrame, valid: Column) -> DataFrame:
    """Rows of a table and of its valid part, as two rows, from one scan."""
    counts = df.agg(F.count("*").alias("all"), F.count_if(valid).alias("valid"))
    pair = F.array(
        F.struct(F.lit(name).alias("name"), F.col("all").alias("rows")),
        F.struct(F.lit(f"valid_{name}").alias("name"), F.col("valid").alias("rows")),
    )
    return counts.select(F.inline(pair))


def counting(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a by-product of whatever action runs on the returned frame."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    """Distinct values of several columns as (name, value) rows, from one scan."""
    pairs = [F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value")) for name in names]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*").distinct()


def ordered(df: DataFrame, **directions: str) -> DataFrame:
    """Sort by named columns, each ``asc`` or ``desc``."""
    return df.orderBy([F.desc(name) if way == "desc" else F.asc(name) for name, way in directions.items()])


def sample_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)


def top_rows(report: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` largest rows; ``ties`` make the choice among equals repeatable."""
    return report.orderBy(F.desc(by), *ties).limit(n)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))

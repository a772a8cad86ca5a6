"""Counts, joins, pivots, top lists and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.bindings import (
    CLASS_SQL,
    COMMENTS_SQL,
    LOCATED_SQL,
    NOTES_SQL,
    ORDER_NOTES_SQL,
    SCORED_SQL,
    TAGS_SQL,
    ZONE,
    comments,
    event_millis,
    located_counts,
    notes,
    order_comments,
    order_notes,
    r6,
    rounded,
    scored_events,
    table,
    tagged_parts,
)
from catalogue.registry import register
from moodtide.functions.classes import opinion_class
from moodtide.functions.numbers import clamp_score as clamped
from moodtide.operators import cube, filters, reports
from moodtide.schemas import POST_SAMPLE_ROWS, TOP_TAG_ROWS
from moodtide.sources import views
from moodtide.storage import store

TOP_LOCATIONS = 5
TOP_TAGS = 20
TOP_NOTES = 20


@register(f"""
SELECT event_id, score, {CLASS_SQL.format('score')} AS sentiment_category
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN floor(value / 10) / 10 END AS score FROM events)
""")
def class_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Scores in steps of a tenth, so that many rows sit exactly on the limits."""
    score = F.when(F.col("event_type") != "error", F.floor(F.col("value") / 10) / 10)
    rows = table(spark, folder, "events").select("event_id", score.alias("score"))
    return rows.withColumn("sentiment_category", opinion_class(F.col("score")))


@register("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN CAST(0 AS DOUBLE)
                 ELSE greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), value / 50 - 0.5)) END AS score
FROM events
""")
def clamp_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores below 0, above 1, not a number, and missing."""
    kind = F.col("event_type")
    raw = F.when(kind == "signup", F.lit(float("nan"))).when(kind != "error", F.col("value") / 50 - 0.5)
    return table(spark, folder, "events").select("event_id", clamped(raw).alias("score"))


@register(f"""WITH {SCORED_SQL}
SELECT sentiment_category, count(*) AS "count", {r6('avg(sentiment_score)')} AS avg_score FROM scored GROUP BY 1""")
def class_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.class_distribution(scored_events(spark, folder)), "avg_score")


LEFT_JOIN_SQL = f"""WITH {ORDER_NOTES_SQL}, order_comments AS (
  SELECT l_orderkey || '-' || l_linenumber AS comment_id, CAST(l_orderkey AS VARCHAR) AS note_id FROM lineitem
)
SELECT n.note_id, n.title, coalesce(n.liked_count, 0) AS liked_count,
       coalesce(n.comment_count, 0) AS note_declared_comment_count, count(c.comment_id) AS actual_comment_count
FROM order_notes n LEFT JOIN order_comments c ON n.note_id = c.note_id
GROUP BY n.note_id, n.title, n.liked_count, n.comment_count"""


def _order_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    repaired = filters.repair_counts(order_notes(spark, folder), "liked_count", "comment_count")
    return repaired, order_comments(spark, folder)


@register(LEFT_JOIN_SQL)
def note_comment_stats(spark: SparkSession, folder: str) -> DataFrame:
    return reports.note_comment_stats(*_order_tables(spark, folder))


@register(LEFT_JOIN_SQL)
def note_comment_stats_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same through registered names and SQL text."""
    views.register(*_order_tables(spark, folder), "catalogue_notes", "catalogue_comments")
    return views.note_comment_stats_sql(spark, "catalogue_notes", "catalogue_comments")


@register(f"SELECT * FROM ({LEFT_JOIN_SQL}) ORDER BY actual_comment_count DESC, note_id LIMIT {TOP_NOTES}")
def top_notes(spark: SparkSession, folder: str) -> DataFrame:
    stats = reports.note_comment_stats(*_order_tables(spark, folder))
    return reports.top_rows(stats, TOP_NOTES, "actual_comment_count", "note_id")


@register(f"""WITH {NOTES_SQL}, {COMMENTS_SQL}
SELECT count(*) AS orphan_comments, count(DISTINCT note_id) AS missing_notes
FROM valid_comments c WHERE NOT EXISTS (SELECT 1 FROM valid_notes n WHERE n.note_id = c.note_id)""")
def orphan_children(spark: SparkSession, folder: str) -> DataFrame:
    return reports.orphan_comments(
        filters.valid_notes(notes(spark, folder)), filters.valid_comments(comments(spark, folder))
    )


@register("""
SELECT strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d') AS comment_date, count(*) AS num_comments
FROM events GROUP BY 1
""")
def comments_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return reports.comments_per_day(table(spark, folder, "events").select(event_millis().alias("create_time")), ZONE)


@register(f"""WITH {SCORED_SQL}
SELECT "date", sentiment_category, count(*) AS "count" FROM scored GROUP BY ALL""")
def class_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_by_day(scored_events(spark, folder), ZONE)


def _by_location(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_by_location(located_counts(spark, folder), times="records")


def _stored_by_location(spark: SparkSession, folder: str) -> DataFrame:
    """The small count table, written once because the top list reads it twice."""
    return store(_by_location(spark, folder), "by_location")


@register(f'WITH {LOCATED_SQL} SELECT ip_location, sentiment_category, "count" FROM by_location')
def class_by_location(spark: SparkSession, folder: str) -> DataFrame:
    return _by_location(spark, folder)


@register(f"WITH {TAGS_SQL} SELECT tag, tag_count FROM tags")
def tag_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return reports.tag_frequency(tagged_parts(spark, folder))


@register(f"""WITH {TAGS_SQL}
SELECT tag, tag_count FROM (SELECT * FROM tags ORDER BY tag_count DESC, tag LIMIT {TOP_TAG_ROWS})
ORDER BY tag_count DESC, tag LIMIT {TOP_TAGS}""")
def top_tags(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_rows(reports.tag_frequency(tagged_parts(spark, folder)), TOP_TAGS, "tag_count", "tag")


def _share_sql(name: str) -> str:
    part = f"count(*) FILTER (sentiment_category = '{name}')"
    return f"{part} AS {name}, {r6(f'coalesce({part} / count(*) * 100, 0)')} AS {name}_percent"


@register(f"""WITH {SCORED_SQL}
SELECT count(*) AS total, {_share_sql('positive')}, {_share_sql('negative')}, {_share_sql('neutral')} FROM scored""")
def class_totals_share(spark: SparkSession, folder: str) -> DataFrame:
    shares = reports.class_shares(reports.class_distribution(scored_events(spark, folder)))
    return rounded(shares, "positive_percent", "negative_percent", "neutral_percent")


@register(f"""WITH {LOCATED_SQL}
SELECT ip_location, CAST(sum("count") AS BIGINT) AS "count" FROM by_location GROUP BY 1""")
def location_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.location_totals(_by_location(spark, folder))


@register(f"""WITH {LOCATED_SQL}, top_places AS (
  SELECT ip_location FROM by_location GROUP BY 1 ORDER BY sum("count") DESC, ip_location LIMIT {TOP_LOCATIONS}
)
SELECT ip_location, sentiment_category, "count" FROM by_location
WHERE ip_location IN (SELECT ip_location FROM top_places)""")
def top_location_classes(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_location_classes(_stored_by_location(spark, folder), TOP_LOCATIONS)


@register(f"""WITH {LOCATED_SQL}
SELECT ip_location, sentiment_category, "count" FROM by_location WHERE sentiment_category = 'negative'
ORDER BY "count" DESC, ip_location LIMIT {TOP_LOCATIONS}""")
def top_negative_locations(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_location_classes(_stored_by_location(spark, folder), TOP_LOCATIONS, "negative")


PIVOT_SQL = ", ".join(
    f"count(*) FILTER (sentiment_category = '{name}') AS {name}"
    for name in ("positive", "negative", "neutral", "unknown")
)


@register(f"WITH {SCORED_SQL} SELECT platform, {PIVOT_SQL} FROM scored GROUP BY platform")
def platform_class_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_pivot(reports.platform_class_counts(scored_events(spark, folder)), "platform")


@register(f'WITH {SCORED_SQL} SELECT CAST("date" AS DATE) AS "date", {PIVOT_SQL} FROM scored GROUP BY 1')
def day_class_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return reports.day_class_pivot(reports.class_by_day(scored_events(spark, folder), ZONE))


@register(f"""WITH {SCORED_SQL}
SELECT event_id, platform, {r6('sentiment_score')} AS sentiment_score, sentiment_category
FROM scored WHERE sentiment_category = 'positive' AND platform = 'click'""")
def filtered_records(spark: SparkSession, folder: str) -> DataFrame:
    chosen = filters.filtered(scored_events(spark, folder), sentiment_category="positive", platform="click", user_id=None)
    return rounded(chosen.select("event_id", "platform", "sentiment_score", "sentiment_category"), "sentiment_score")


@register(f"""WITH {SCORED_SQL}
SELECT DISTINCT 'sentiment_category' AS name, sentiment_category AS value FROM scored
UNION ALL SELECT DISTINCT 'platform', platform FROM scored""")
def distinct_filter_values(spark: SparkSession, folder: str) -> DataFrame:
    return reports.distinct_values(scored_events(spark, folder), "sentiment_category", "platform")


@register(f"""WITH {NOTES_SQL}, {COMMENTS_SQL}
SELECT 'notes' AS name, count(*) AS "rows" FROM notes
UNION ALL SELECT 'valid_notes', count(*) FROM valid_notes
UNION ALL SELECT 'comments', count(*) FROM comments
UNION ALL SELECT 'valid_comments', count(*) FROM valid_comments""")
def record_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = reports.counts_with_valid("notes", notes(spark, folder), filters.is_valid_note())
    return counted.unionByName(
        reports.counts_with_valid("comments", comments(spark, folder), filters.is_valid_comment())
    )


@register(f"""WITH {SCORED_SQL}
SELECT event_id, platform, {r6('sentiment_score')} AS sentiment_score, sentiment_category
FROM scored ORDER BY create_time, event_id LIMIT {POST_SAMPLE_ROWS}""")
def sample_records(spark: SparkSession, folder: str) -> DataFrame:
    first = reports.sample_rows(scored_events(spark, folder), POST_SAMPLE_ROWS, "create_time", "event_id")
    return rounded(first.select("event_id", "platform", "sentiment_score", "sentiment_category"), "sentiment_score")


@register(f"""WITH {SCORED_SQL}
SELECT platform, sentiment_category, count(*) AS "rows" FROM scored GROUP BY ALL ORDER BY platform, "rows" DESC""")
def ordered_report(spark: SparkSession, folder: str) -> DataFrame:
    counts = reports.class_counts(scored_events(spark, folder), "platform")
    return reports.ordered(reports.renamed(counts, {"count": "rows"}), platform="asc", rows="desc")


def _placed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Scored events with a place made of the user: missing and blank for some."""
    user = F.col("user_id") % 7
    place = F.when(user == 0, " ").when(user > 1, F.concat(F.lit("place "), user.cast("string")))
    return scored_events(spark, folder).withColumn("ip_location", place)


@register(f"""WITH {SCORED_SQL}, placed AS (
  SELECT *, CASE WHEN user_id % 7 = 0 THEN ' ' WHEN user_id % 7 > 1 THEN 'place ' || user_id % 7 END AS ip_location,
         platform AS series FROM scored
)
SELECT CASE grouping_id(sentiment_category, platform, "date", ip_location, series)
         WHEN 15 THEN 'class' WHEN 7 THEN 'platform' WHEN 11 THEN 'day' WHEN 13 THEN 'place' ELSE 'series' END AS report,
       sentiment_category, platform, "date", ip_location, series, count(*) AS "count", count(sentiment_score) AS scored,
       {r6('avg(sentiment_score)')} AS avg_score, {r6('stddev_samp(sentiment_score)')} AS score_std
FROM placed GROUP BY GROUPING SETS ((sentiment_category), (platform, sentiment_category), ("date", sentiment_category),
                                    (ip_location, sentiment_category), (series, "date"))""")
def report_cube(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of five reports from one pass over the scored events."""
    counts = cube.report_cube(_placed_events(spark, folder), list(cube.KEYS), "platform", ZONE)
    return rounded(counts, "avg_score", "score_std")


@register(f"""WITH {SCORED_SQL}, placed AS (
  SELECT *, CASE WHEN user_id % 7 = 0 THEN ' ' WHEN user_id % 7 > 1 THEN 'place ' || user_id % 7 END AS ip_location FROM scored
)
SELECT 'class' AS report, sentiment_category AS key, sentiment_category AS category, count(*) AS amount, {r6('avg(sentiment_score)')} AS score
FROM placed GROUP BY ALL
UNION ALL SELECT 'platform', platform, sentiment_category, count(*), NULL FROM placed GROUP BY ALL
UNION ALL SELECT 'day', "date", sentiment_category, count(*), NULL FROM placed GROUP BY ALL
UNION ALL SELECT 'place', ip_location, sentiment_category, count(*), NULL FROM placed WHERE trim(ip_location) <> '' GROUP BY ALL
UNION ALL SELECT 'series', platform, "date", count(*), {r6('avg(sentiment_score)')} FROM placed WHERE sentiment_score IS NOT NULL GROUP BY ALL""")
def reports_from_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Every report as it is read off the stored cube, against plain groupings."""
    counts = store(cube.report_cube(_placed_events(spark, folder), list(cube.KEYS), "platform", ZONE), "report_cube")
    kind = reports.CLASS
    parts = [
        ("class", cube.class_distribution(counts), kind, kind, "count", F.col("avg_score")),
        ("platform", cube.platform_class_counts(counts), "platform", kind, "count", None),
        ("day", cube.class_by_day(counts), "date", kind, "count", None),
        ("place", cube.class_by_location(counts), "ip_location", kind, "count", None),
        ("series", cube.daily_series(counts), "series", "date", "post_count", F.col("avg_sentiment")),
    ]
    none = F.lit(None).cast("double")
    shown = [
        df.select(
            F.lit(name).alias("report"), F.col(key).alias("key"), F.col(category).alias("category"), F.col(amount).alias("amount"),
            F.round(none if score is None else score, 6).alias("score"),
        )
        for name, df, key, category, amount, score in parts
    ]
    result = shown[0]
    for part in shown[1:]:
        result = result.unionByName(part)
    return result

"""The two flows over the test tables: all reports written, read back and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.bindings import COMMENTS_SQL, ZONE, comments, notes, polarity_model, posts, r6, table
from catalogue.registry import register
from catalogue.text_queries import POST_SCORES_SQL, UNION_SCORES_SQL
from moodtide.operators import filters
from moodtide.plans.notes import analyse_notes
from moodtide.plans.posts import analyse_posts
from moodtide.schemas import DETAIL_SAMPLE_ROWS, POST_SAMPLE_ROWS, REPORTS, TOP_LOCATION_ROWS, TOP_TAG_ROWS
from moodtide.sources import files, writers
from moodtide.storage import scratch_path

COUNTED = {"count", "num_comments", "actual_comment_count", "tag_count"}
POST_REPORTS = ["sentiment_distribution", "platform_sentiment", "sentiment_sample"]


def _totals(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """One row per report: rows, and the sum of its count column (0 without one)."""
    tables, missing = files.read_reports(spark, path, names)
    if missing:
        raise ValueError(f"reports {missing} were not written")
    parts = []
    for name, report in tables.items():
        counted = next((F.col(c) for c in report.columns if c in COUNTED), F.lit(0).cast("long"))
        total = F.coalesce(F.sum(counted), F.lit(0)).alias("total")
        parts.append(report.agg(F.lit(name).alias("report"), F.count("*").alias("rows"), total))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@register(f"""WITH {POST_SCORES_SQL}, kept AS (SELECT * FROM opinions WHERE text IS NOT NULL AND text <> '')
SELECT 'sentiment_distribution' AS report, count(DISTINCT sentiment_category) AS "rows", count(*) AS total FROM kept
UNION ALL SELECT 'platform_sentiment', count(DISTINCT (platform, sentiment_category)), count(*) FROM kept
UNION ALL SELECT 'sentiment_sample', least({POST_SAMPLE_ROWS}, count(*)), 0 FROM kept""")
def posts_flow(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "posts_flow")
    analyse_posts(posts(spark, folder), polarity_model(spark, folder), path)
    return _totals(spark, path, POST_REPORTS)


DAY_SQL = "strftime(make_timestamp(create_time * 1000000), '%Y-%m-%d')"


@register(f"""WITH {UNION_SCORES_SQL}, comment_counts AS (
  SELECT note_id, count(*) AS n FROM valid_comments GROUP BY 1
), tags AS (
  SELECT lower(trim(piece)) AS tag, count(*) AS n
  FROM (SELECT unnest(string_split(trim(tag_list), ',')) AS piece FROM valid_notes WHERE trim(tag_list) <> '')
  WHERE trim(piece) <> '' GROUP BY 1
), top_tags AS (SELECT * FROM tags ORDER BY n DESC, tag LIMIT {TOP_TAG_ROWS}
), places AS (
  SELECT ip_location, sentiment_category, count(*) AS n FROM opinions WHERE trim(ip_location) <> '' GROUP BY ALL
), training AS (
  SELECT floor(count(DISTINCT {DAY_SQL}) * (1 - CAST(0.2 AS DOUBLE))) AS days FROM opinions WHERE sentiment_score IS NOT NULL
), top_places AS (SELECT * FROM places ORDER BY n DESC, ip_location, sentiment_category LIMIT {TOP_LOCATION_ROWS}
)
SELECT 'note_comment_stats' AS report, count(*) AS "rows", CAST(coalesce(sum(n), 0) AS BIGINT) AS total
FROM valid_notes LEFT JOIN comment_counts USING (note_id)
UNION ALL SELECT 'comment_daily_distribution', count(DISTINCT {DAY_SQL}), count(*)
FROM (SELECT create_time // 1000 AS create_time FROM valid_comments)
UNION ALL SELECT 'tag_frequency', count(*), CAST(sum(n) AS BIGINT) FROM tags
UNION ALL SELECT 'top_tags_for_wordcloud', count(*), CAST(sum(n) AS BIGINT) FROM top_tags
UNION ALL SELECT 'combined_sentiment_distribution', count(DISTINCT sentiment_category), count(*) FROM opinions
UNION ALL SELECT 'combined_sentiment_over_time', count(DISTINCT ({DAY_SQL}, sentiment_category)), count(*) FROM opinions
UNION ALL SELECT 'combined_sentiment_by_location', count(*), CAST(sum(n) AS BIGINT) FROM places
UNION ALL SELECT 'combined_sentiment_by_location_sample', count(*), CAST(sum(n) AS BIGINT) FROM top_places
UNION ALL SELECT 'combined_sentiment_sample_details', least({DETAIL_SAMPLE_ROWS}, count(*)), 0 FROM opinions
UNION ALL SELECT 'sentiment_trend_predictions', CASE WHEN days >= 3 THEN 30 ELSE 0 END, 0 FROM training
UNION ALL SELECT 'sentiment_trend_evaluation', CASE WHEN days >= 3 THEN 1 ELSE 0 END, 0 FROM training""")
def notes_flow(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "notes_flow")
    analyse_notes(notes(spark, folder), comments(spark, folder), polarity_model(spark, folder), path, zone=ZONE)
    return _totals(spark, path, [name for name in REPORTS if name not in POST_REPORTS])


# Where the key, class, count and score of each report stand; NULL where it has none.
SHOWN = {
    "note_comment_stats": ("note_id", "title", "actual_comment_count", None),
    "comment_daily_distribution": ("comment_date", None, "num_comments", None),
    "tag_frequency": ("tag", None, "tag_count", None),
    "top_tags_for_wordcloud": ("tag", None, "tag_count", None),
    "combined_sentiment_distribution": (None, "sentiment_category", "count", "avg_score"),
    "combined_sentiment_over_time": ("date", "sentiment_category", "count", None),
    "combined_sentiment_by_location": ("ip_location", "sentiment_category", "count", None),
    "combined_sentiment_by_location_sample": ("ip_location", "sentiment_category", "count", None),
    "combined_sentiment_sample_details": ("id", "sentiment_category", "create_time", "sentiment_score"),
}


@register(f"""WITH {UNION_SCORES_SQL}, comment_counts AS (
  SELECT note_id, count(*) AS n FROM valid_comments GROUP BY 1
), tags AS (
  SELECT lower(trim(piece)) AS tag, count(*) AS n
  FROM (SELECT unnest(string_split(trim(tag_list), ',')) AS piece FROM valid_notes WHERE trim(tag_list) <> '')
  WHERE trim(piece) <> '' GROUP BY 1
), places AS (
  SELECT ip_location, sentiment_category, count(*) AS n FROM opinions WHERE trim(ip_location) <> '' GROUP BY ALL
), values_ AS (
  SELECT 'note_comment_stats' AS report, note_id AS key, title AS category, coalesce(n, 0) AS amount, CAST(NULL AS DOUBLE) AS score
  FROM valid_notes LEFT JOIN comment_counts USING (note_id)
  UNION ALL SELECT 'comment_daily_distribution', {DAY_SQL}, NULL, count(*), NULL
  FROM (SELECT create_time // 1000 AS create_time FROM valid_comments) GROUP BY 2
  UNION ALL SELECT 'tag_frequency', tag, NULL, n, NULL FROM tags
  UNION ALL SELECT 'top_tags_for_wordcloud', tag, NULL, n, NULL FROM (SELECT * FROM tags ORDER BY n DESC, tag LIMIT {TOP_TAG_ROWS})
  UNION ALL SELECT 'combined_sentiment_distribution', NULL, sentiment_category, count(*), {r6('avg(sentiment_score)')} FROM opinions GROUP BY 3
  UNION ALL SELECT 'combined_sentiment_over_time', {DAY_SQL}, sentiment_category, count(*), NULL FROM opinions GROUP BY 2, 3
  UNION ALL SELECT 'combined_sentiment_by_location', ip_location, sentiment_category, n, NULL FROM places
  UNION ALL SELECT 'combined_sentiment_by_location_sample', ip_location, sentiment_category, n, NULL
  FROM (SELECT * FROM places ORDER BY n DESC, ip_location, sentiment_category LIMIT {TOP_LOCATION_ROWS})
  UNION ALL SELECT 'combined_sentiment_sample_details', id, sentiment_category, create_time, {r6('sentiment_score')}
  FROM (SELECT * FROM opinions ORDER BY type, id, create_time, text LIMIT {DETAIL_SAMPLE_ROWS})
)
SELECT report, key, category, CAST(amount AS BIGINT) AS amount, score FROM values_""")
def notes_flow_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of every report of the notes flow but the forecast's, read back."""
    path = scratch_path(spark, "notes_flow_values")
    analyse_notes(notes(spark, folder), comments(spark, folder), polarity_model(spark, folder), path, zone=ZONE)
    tables, missing = files.read_reports(spark, path, list(SHOWN))
    if missing:
        raise ValueError(f"reports {missing} were not written")
    result = None
    for name, columns in SHOWN.items():
        shown = [F.lit(None) if c is None else F.col(c) for c in columns]
        kinds = ("string", "string", "long", "double")
        key, category, amount, score = (c.cast(kind) for c, kind in zip(shown, kinds, strict=True))
        part = tables[name].select(
            F.lit(name).alias("report"), key.alias("key"), category.alias("category"), amount.alias("amount"), F.round(score, 6).alias("score")
        )
        result = part if result is None else result.unionByName(part)
    return result


@register(f"""WITH {COMMENTS_SQL}
SELECT false AS analysed, count(*) AS valid_rows FROM valid_comments WHERE create_time < 0""")
def notes_flow_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A filter that leaves nothing: the flow says so and writes no report."""
    path = scratch_path(spark, "notes_flow_empty")
    no_notes = notes(spark, folder).filter(F.col("time") < 0)
    no_comments = comments(spark, folder).filter(F.col("create_time") < 0)
    done = analyse_notes(no_notes, no_comments, polarity_model(spark, folder), path, zone=ZONE)
    if files.read_reports(spark, path) is not None:
        raise ValueError("a report was written for no rows")
    counted = filters.valid_comments(no_comments).agg(F.count("*").alias("valid_rows"))
    return counted.select(F.lit(done).alias("analysed"), "valid_rows")


SAMPLE = 300


@register(rf"""
SELECT CAST(doc_id % 50 AS VARCHAR) AS id,
       CASE doc_id % 6 WHEN 0 THEN text WHEN 1 THEN '  ' || text || chr(9) WHEN 2 THEN '\N' WHEN 3 THEN ''
            WHEN 4 THEN '\\N "' || lang || '"' || chr(10) || '\' END AS text
FROM documents ORDER BY id, text NULLS FIRST LIMIT {SAMPLE}""")
def sample_export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """An ordered sample through CSV and back: repeated ids, outer spaces, quotes, line breaks, NULL marks."""
    case, text = F.col("doc_id") % 6, F.col("text")
    shown = (
        F.when(case == 0, text)
        .when(case == 1, F.concat(F.lit("  "), text, F.lit("\t")))
        .when(case == 2, "\\N")
        .when(case == 3, "")
        .when(case == 4, F.concat(F.lit('\\\\N "'), "lang", F.lit('"\n\\')))
    )
    rows = table(spark, folder, "documents").select((F.col("doc_id") % 50).cast("string").alias("id"), shown.alias("text"))
    path = scratch_path(spark, "sample_export")
    writers.write_sample(rows, path, SAMPLE, "id", "text")
    return files.read_csv(spark, path, rows.schema, multi_line=True)

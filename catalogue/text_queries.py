"""Cleaning, record and scoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.bindings import (
    CLASS_SQL,
    COMMENTS_SQL,
    NOTES_SQL,
    ORDER_NOTES_SQL,
    TEXT_UNION_SQL,
    ZONE,
    comments,
    event_millis,
    labelled_texts,
    notes,
    order_notes,
    polarity_model,
    posts,
    r6,
    rounded,
    table,
)
from catalogue.registry import register
from moodtide.functions.dates import day_string
from moodtide.functions.numbers import epoch_seconds
from moodtide.functions.text import clean_text as cleaned, join_text, not_blank
from moodtide.operators import filters, polarity, records, reports
from moodtide.storage import store_texts

# The same character classes as the Spark side; only the name of the Han script differs.
SPACE_SQL = r"\x09-\x0d\x1c-\x20\x85\p{Z}"


def clean_sql(text: str) -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace(coalesce({text}, ''), 'https?://[^{SPACE_SQL}]+', '', 'g'),"
        rf" '@[\p{{L}}\p{{N}}_]+', '', 'g'), '[{SPACE_SQL}]+', ' ', 'g'))"
    )


def tokens_sql(text: str) -> str:
    spaced = rf"regexp_replace({clean_sql(text)}, '(\p{{Han}})', ' \1 ', 'g')"
    return rf"string_split_regex(lower({spaced}), '[^\p{{L}}\p{{N}}]+')"


MODEL_SQL = f"""
labelled AS (
  SELECT l.quality AS label, unnest({tokens_sql('d.text')}) AS token FROM documents d JOIN labels l USING (doc_id)
), token_counts AS (
  SELECT token, sum(label) AS c1, sum(1 - label) AS c0 FROM labelled WHERE token <> '' GROUP BY token
), totals AS (
  SELECT sum(c1) AS n1, sum(c0) AS n0, count(*) AS v FROM token_counts
), model AS (
  SELECT token, ln((c1 + 1) / (n1 + v)) - ln((c0 + 1) / (n0 + v)) AS weight, CAST(c1 + c0 AS BIGINT) AS occurrences
  FROM token_counts, totals
)"""


def scores_sql(source: str, key: str) -> str:
    """Score and class per row of ``source``, which has the columns of ``key`` and a text."""
    return f"""
pieces AS (SELECT {key}, unnest({tokens_sql('text')}) AS token FROM {source}),
sums AS (SELECT {key}, sum(weight) / count(*) AS z FROM pieces JOIN model USING (token) GROUP BY ALL),
opinions AS (
  SELECT *, {CLASS_SQL.format('sentiment_score')} AS sentiment_category
  FROM (
    SELECT s.*, CASE WHEN z IS NOT NULL THEN 1 / (1 + exp(-greatest(-500, least(500, z)))) END AS sentiment_score
    FROM {source} s LEFT JOIN sums USING ({key})
  )
)"""


POST_SCORES_SQL = f"""{MODEL_SQL}, posts AS (
  SELECT doc_id AS id, text, source AS platform, lang, n_chars FROM documents
), {scores_sql('posts', 'id')}"""


@register("""
SELECT doc_id, source, md5(body) AS body_md5
FROM (SELECT *, CASE WHEN source = 'src1' THEN '' WHEN source = 'src3' THEN '  ' WHEN source <> 'src2' THEN text END
        AS body FROM documents)
WHERE body IS NOT NULL AND body <> ''
""")
def nonempty_posts(spark: SparkSession, folder: str) -> DataFrame:
    source = F.col("source")
    body = F.when(source == "src1", "").when(source == "src3", "  ").when(source != "src2", F.col("text"))
    rows = table(spark, folder, "documents").withColumn("text", body)
    return filters.nonempty_posts(rows).select("doc_id", "source", F.md5("text").alias("body_md5"))


@register(f"WITH {ORDER_NOTES_SQL} SELECT note_id, liked_count, comment_count FROM order_notes")
def repair_counts(spark: SparkSession, folder: str) -> DataFrame:
    repaired = filters.repair_counts(order_notes(spark, folder), "liked_count", "comment_count")
    return repaired.select("note_id", "liked_count", "comment_count")


@register(f"""WITH {NOTES_SQL}
SELECT note_id, title, md5("desc") AS desc_md5, "time" FROM valid_notes""")
def valid_notes(spark: SparkSession, folder: str) -> DataFrame:
    return filters.valid_notes(notes(spark, folder)).select("note_id", "title", F.md5("desc").alias("desc_md5"), "time")


@register(f"""WITH {COMMENTS_SQL}
SELECT comment_id, note_id, create_time, md5(content) AS content_md5 FROM valid_comments""")
def valid_comments(spark: SparkSession, folder: str) -> DataFrame:
    return filters.valid_comments(comments(spark, folder)).select(
        "comment_id", "note_id", "create_time", F.md5("content").alias("content_md5")
    )


@register("""
SELECT event_id, epoch_us(ts) // 1000000 AS seconds,
       strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d') AS "day"
FROM events
""")
def epoch_to_date(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .select("event_id", epoch_seconds(event_millis()).alias("seconds"))
        .withColumn("day", day_string(F.col("seconds"), ZONE))
    )


@register("""
SELECT p_partkey, concat_ws(' ', title, description) AS text
FROM (SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_name END AS title,
             CASE WHEN p_size < 10 THEN '' WHEN p_size <= 45 THEN p_type END AS description FROM part)
WHERE trim(concat_ws(' ', title, description)) <> ''
""")
def assemble_text(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    title = F.when(size <= 40, F.col("p_name"))
    description = F.when(size < 10, "").when(size <= 45, F.col("p_type"))
    joined = table(spark, folder, "part").select("p_partkey", join_text(title, description).alias("text"))
    return joined.filter(not_blank(F.col("text")))


@register(f"""WITH {TEXT_UNION_SQL}
SELECT id, md5(text) AS text_md5, create_time, ip_location, note_id, type FROM texts""")
def text_union(spark: SparkSession, folder: str) -> DataFrame:
    union = _text_union(spark, folder)
    return union.select("id", F.md5("text").alias("text_md5"), "create_time", "ip_location", "note_id", "type")


def _text_union(spark: SparkSession, folder: str) -> DataFrame:
    return records.text_union(
        filters.valid_notes(notes(spark, folder)), filters.valid_comments(comments(spark, folder))
    )


@register(f"""
SELECT doc_id, {clean_sql('noisy')} AS text
FROM (SELECT d.doc_id, 'see https://a.b/c?d=1 @user_1 ' || coalesce(p.url, '') || ' ' || d.text || ' @' || d.source
        AS noisy FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id)
""")
def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "url")
    noisy = F.concat(
        F.lit("see https://a.b/c?d=1 @user_1 "), F.coalesce("url", F.lit("")), F.lit(" "), "text", F.lit(" @"), "source"
    )
    documents = table(spark, folder, "documents").join(urls, "doc_id", "left")
    return documents.select("doc_id", cleaned(noisy).alias("text"))


@register(f"WITH {MODEL_SQL} SELECT token, {r6('weight')} AS weight, occurrences FROM model")
def opinion_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(polarity.fit_polarity_model(labelled_texts(spark, folder)), "weight")


@register(f"""WITH {POST_SCORES_SQL}
SELECT id, {r6('sentiment_score')} AS sentiment_score, sentiment_category FROM opinions""")
def opinion_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = polarity.score_records(posts(spark, folder), polarity_model(spark, folder), key=["id"])
    return rounded(scored, "sentiment_score")


@register(f"""WITH {POST_SCORES_SQL}
SELECT id, platform, lang, n_chars, md5(text) AS text_md5,
       {r6('sentiment_score')} AS sentiment_score, sentiment_category
FROM opinions""")
def scored_posts(spark: SparkSession, folder: str) -> DataFrame:
    scored = polarity.score_text(posts(spark, folder), polarity_model(spark, folder), key=["id"])
    return rounded(scored, "sentiment_score").select(
        "id", "platform", "lang", "n_chars", F.md5("text").alias("text_md5"), "sentiment_score", "sentiment_category"
    )


@register(f"""WITH {POST_SCORES_SQL}
SELECT sentiment_category, count(*) AS "count", {r6('avg(sentiment_score)')} AS avg_score
FROM opinions WHERE text IS NOT NULL AND text <> '' GROUP BY 1""")
def opinion_class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.nonempty_posts(posts(spark, folder))
    scored = polarity.score_records(kept, polarity_model(spark, folder), key=["id"])
    return rounded(reports.class_distribution(scored), "avg_score")


@register(f"""WITH {POST_SCORES_SQL}
SELECT platform, sentiment_category, count(*) AS "count" FROM opinions GROUP BY ALL""")
def platform_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    scored = polarity.score_records(
        posts(spark, folder), polarity_model(spark, folder), key=["id"], keep=["platform"]
    )
    return reports.platform_class_counts(scored)


UNION_SCORES_SQL = f"{MODEL_SQL}, {TEXT_UNION_SQL}, {scores_sql('texts', 'type, id')}"


def _scored_union(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    texts, model = _text_union(spark, folder), polarity_model(spark, folder)
    return polarity.score_records(texts, model, key=["type", "id"], keep=keep)


@register(f"""WITH {UNION_SCORES_SQL}
SELECT type, sentiment_category, count(*) AS "count", {r6('avg(sentiment_score)')} AS avg_score
FROM opinions GROUP BY ALL""")
def union_class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(reports.class_distribution(_scored_union(spark, folder), "type"), "avg_score")


@register(f"""WITH {UNION_SCORES_SQL}
SELECT strftime(make_timestamp(create_time * 1000000), '%Y-%m-%d') AS "date", sentiment_category, count(*) AS "count"
FROM opinions GROUP BY ALL""")
def union_class_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_by_day(_scored_union(spark, folder, "create_time"), ZONE)


@register(f"""WITH {UNION_SCORES_SQL}
SELECT ip_location, sentiment_category, count(*) AS "count"
FROM opinions WHERE ip_location IS NOT NULL AND trim(ip_location) <> '' GROUP BY ALL""")
def union_class_by_location(spark: SparkSession, folder: str) -> DataFrame:
    return reports.class_by_location(_scored_union(spark, folder, "ip_location"))


@register(f"""WITH {POST_SCORES_SQL}
SELECT id, {r6('sentiment_score')} AS sentiment_score, sentiment_category FROM opinions""")
def opinion_score_split(spark: SparkSession, folder: str) -> DataFrame:
    """The way for models too large to travel whole: a small head by broadcast, the rest by a salted join."""
    model = polarity_model(spark, folder)
    scored = polarity.score_records(posts(spark, folder), model, key=["id"], broadcast_limit=0, head_rows=500)
    return rounded(scored, "sentiment_score")


@register(f"""
SELECT doc_id, {r6('sentiment_score')} AS sentiment_score, {CLASS_SQL.format('sentiment_score')} AS sentiment_category
FROM (
  SELECT doc_id, CASE WHEN body <> '' THEN least(1, 4 * (length(body) - length(replace(body, 'e', ''))) / length(body))
         END AS sentiment_score
  FROM (SELECT doc_id, {clean_sql('text')} AS body FROM documents)
)""")
def plugged_in_scorer(spark: SparkSession, folder: str) -> DataFrame:
    """A caller's own function over Arrow batches: four times the share of the letter e."""

    def load():
        return lambda texts: 4 * texts.str.count("e") / texts.str.len()

    scored = polarity.score_with(table(spark, folder, "documents"), load)
    narrow = rounded(scored.select("doc_id", "sentiment_score", "sentiment_category"), "sentiment_score")
    return store_texts(narrow, "scores")

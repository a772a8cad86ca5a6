"""What the test tables stand for: posts, notes, comments, scored records, tag lists.

Each binding exists twice, as a DataFrame and as SQL text for a WITH clause. The messy cases
(NULL, blank, padded, unreadable) are derived from column values, over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moodtide.functions.numbers import clamp_score
from moodtide.operators.polarity import classify, fit_polarity_model
from moodtide.storage import store


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Posts: documents, with their source as platform.


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), "text", F.col("source").alias("platform"), "lang", "n_chars"
    )


def labelled_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with the quality label standing in for polarity."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")


def polarity_model(spark: SparkSession, folder: str) -> DataFrame:
    return store(fit_polarity_model(labelled_texts(spark, folder)), "polarity_model")


# Notes: documents with missing and blank parts. Comments: conversation turns.

# Fixed value: 2024-01-01T00:00:00Z in epoch milliseconds.
FIRST_MILLIS = 1704067200000


def notes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a sound note, and once more with parts missing, blank or unreadable."""
    source, lang = F.col("source"), F.col("lang")
    documents = table(spark, folder, "documents")
    sound = documents.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("note_id"),
        F.concat_ws(" ", source, lang).alias("title"),
        F.col("text").alias("desc"),
        (FIRST_MILLIS + F.col("doc_id") * 61007).alias("time"),
        F.col("n_chars").cast("string").alias("liked_count"),
        F.col("doc_id").cast("string").alias("comment_count"),
        lang.alias("ip_location"),
        F.concat_ws(",", lang, source).alias("tag_list"),
    )
    damaged = documents.select(
        F.when(source != "src5", F.col("doc_id").cast("string")).alias("note_id"),
        F.when(lang == "fr", "  ").when(lang != "de", F.concat_ws(" ", source, lang)).alias("title"),
        F.when(source == "src1", "").when(source != "src2", F.col("text")).alias("desc"),
        F.when(source != "src3", FIRST_MILLIS + F.col("doc_id") * 61007).alias("time"),
        F.when(source == "src7", "").otherwise(F.col("n_chars").cast("string")).alias("liked_count"),
        F.when(source == "src8", "1.2w").otherwise(F.col("doc_id").cast("string")).alias("comment_count"),
        F.when(source == "src6", " ").when(source != "src4", lang).alias("ip_location"),
        F.concat_ws(",", F.upper(lang), F.concat(F.lit(" "), source, F.lit(" ")), F.lit("")).alias("tag_list"),
    )
    return sound.unionByName(damaged)


NOTES_SQL = f"""
notes AS (
  SELECT CASE WHEN source <> 'src5' THEN CAST(doc_id AS VARCHAR) END AS note_id,
         CASE WHEN lang = 'fr' THEN '  ' WHEN lang <> 'de' THEN source || ' ' || lang END AS title,
         CASE WHEN source = 'src1' THEN '' WHEN source <> 'src2' THEN text END AS "desc",
         CASE WHEN source <> 'src3' THEN {FIRST_MILLIS} + doc_id * 61007 END AS "time",
         CASE WHEN source = 'src6' THEN ' ' WHEN source <> 'src4' THEN lang END AS ip_location,
         upper(lang) || ', ' || source || ' ,' AS tag_list
  FROM documents
  UNION ALL
  SELECT 'd' || doc_id, source || ' ' || lang, text, {FIRST_MILLIS} + doc_id * 61007, lang, lang || ',' || source
  FROM documents
), valid_notes AS (
  SELECT * FROM notes
  WHERE note_id IS NOT NULL AND "time" IS NOT NULL
    AND ((title IS NOT NULL AND trim(title) <> '') OR ("desc" IS NOT NULL AND trim("desc") <> ''))
)"""


def comments(spark: SparkSession, folder: str) -> DataFrame:
    role, turn = F.col("role"), F.col("turn")
    return table(spark, folder, "conversations").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string")).alias("comment_id"),
        F.col("conv_id").cast("string").alias("note_id"),
        F.when(role == "system", "  ").otherwise(F.col("text")).alias("content"),
        F.when(turn != 3, FIRST_MILLIS + F.col("conv_id") * 3600000 + turn * 1999).alias("create_time"),
        F.when(role == "user", "en").otherwise("").alias("ip_location"),
    )


COMMENTS_SQL = f"""
comments AS (
  SELECT conv_id || '-' || turn AS comment_id,
         CAST(conv_id AS VARCHAR) AS note_id,
         CASE WHEN role = 'system' THEN '  ' ELSE text END AS content,
         CASE WHEN turn <> 3 THEN {FIRST_MILLIS} + conv_id * 3600000 + turn * 1999 END AS create_time,
         CASE WHEN role = 'user' THEN 'en' ELSE '' END AS ip_location
  FROM conversations
), valid_comments AS (
  SELECT * FROM comments
  WHERE note_id IS NOT NULL AND comment_id IS NOT NULL AND create_time IS NOT NULL
    AND content IS NOT NULL AND trim(content) <> ''
)"""

TEXT_UNION_SQL = f"""{NOTES_SQL}, {COMMENTS_SQL}, texts AS (
  SELECT comment_id AS id, content AS text, create_time // 1000 AS create_time, ip_location, note_id,
         'comment' AS type
  FROM valid_comments
  UNION ALL
  SELECT note_id, concat_ws(' ', title, "desc"), "time" // 1000, ip_location, note_id, 'note'
  FROM valid_notes WHERE trim(concat_ws(' ', title, "desc")) <> ''
)"""


# Scored records: events, with a score from their value; errors have none. A ninety-seventh has no
# finite decimal form, so means never end in an exact half at the digit they are rounded to.


# The tables hold wall-clock times without a zone; they are read as UTC whatever the session says.
ZONE = "UTC"


def event_time(unit: str) -> Column:
    return F.timestamp_diff(unit, F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))


def event_millis() -> Column:
    return event_time("MILLISECOND")


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    score = F.when(F.col("event_type") != "error", F.least(F.col("value") / 97, F.lit(1.0)))
    return classify(
        table(spark, folder, "events").select(
            "event_id",
            "user_id",
            F.col("event_type").alias("platform"),
            event_time("SECOND").alias("create_time"),
            clamp_score(score).alias("sentiment_score"),
        )
    )


CLASS_SQL = """CASE WHEN {0} IS NULL THEN 'unknown' WHEN {0} >= CAST(0.6 AS DOUBLE) THEN 'positive'
       WHEN {0} <= CAST(0.4 AS DOUBLE) THEN 'negative' ELSE 'neutral' END"""

SCORED_SQL = f"""
scores AS (
  SELECT event_id, user_id, event_type AS platform, epoch_us(ts) // 1000000 AS create_time,
         CASE WHEN event_type <> 'error' THEN greatest(least(value / 97, CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) END
           AS sentiment_score
  FROM events
), scored AS (
  SELECT *, {CLASS_SQL.format('sentiment_score')} AS sentiment_category,
         strftime(make_timestamp(create_time * 1000000), '%Y-%m-%d') AS "date"
  FROM scores
)"""


def located_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Scored records counted per user and class, with the user's nation as location.

    Counting comes before the join, so a user with very many records joins as four rows.
    """
    users = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ip_location")
    )
    counted = scored_events(spark, folder).groupBy("user_id", "sentiment_category").agg(F.count("*").alias("records"))
    return counted.join(users, "user_id", "left").join(nations, "c_nationkey", "left")


LOCATED_SQL = f"""{SCORED_SQL}, located AS (
  SELECT s.*, n.n_name AS ip_location
  FROM scored s LEFT JOIN customer c ON s.user_id = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
), by_location AS (
  SELECT ip_location, sentiment_category, count(*) AS "count" FROM located
  WHERE ip_location IS NOT NULL AND trim(ip_location) <> '' GROUP BY ALL
)"""


# Orders as notes with messy numbers, their lines as comments, parts as tag lists.


def order_notes(spark: SparkSession, folder: str) -> DataFrame:
    priority, status, customer = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("note_id"),
        status.alias("title"),
        F.when(priority == "1-URGENT", "")
        .when(priority == "3-MEDIUM", "  ")
        .when(priority == "4-NOT SPECIFIED", "1.2w")
        .when(priority == "5-LOW", customer)
        .alias("liked_count"),
        F.when(status == "F", F.concat(F.lit(" "), customer, F.lit(" ")))
        .when(status == "O", F.concat(customer, F.lit(".5")))
        .otherwise(F.concat(F.lit("-"), customer))
        .alias("comment_count"),
    )


def order_comments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("comment_id"),
        F.col("l_orderkey").cast("string").alias("note_id"),
    )


REPAIR_SQL = r"""CASE WHEN {0} IS NULL OR trim({0}) = '' THEN 0
       ELSE TRY_CAST(regexp_extract({0}, '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS BIGINT) END"""

ORDER_NOTES_SQL = f"""
raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS note_id, o_orderstatus AS title,
         CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '3-MEDIUM' THEN '  ' WHEN '4-NOT SPECIFIED' THEN '1.2w'
              WHEN '5-LOW' THEN CAST(o_custkey AS VARCHAR) END AS liked_text,
         CASE o_orderstatus WHEN 'F' THEN ' ' || o_custkey || ' ' WHEN 'O' THEN o_custkey || '.5'
              ELSE '-' || o_custkey END AS comment_text
  FROM orders
), order_notes AS (
  SELECT note_id, title, {REPAIR_SQL.format('liked_text')} AS liked_count,
         {REPAIR_SQL.format('comment_text')} AS comment_count
  FROM raw_orders
)"""


def tagged_parts(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("p_type"), F.lit(" "))
    return table(spark, folder, "part").select(
        F.concat_ws(",", F.upper("p_brand"), padded, F.lit(""), F.lower("p_type")).alias("tag_list")
    )


TAGS_SQL = """
pieces AS (
  SELECT unnest(string_split(trim(upper(p_brand) || ', ' || p_type || ' ,,' || lower(p_type)), ',')) AS piece FROM part
), tags AS (
  SELECT lower(trim(piece)) AS tag, count(*) AS tag_count FROM pieces WHERE trim(piece) <> '' GROUP BY 1
)"""


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Doubles cut to six digits, so that the order of a sum does not show."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def r6(expression: str) -> str:
    """The same in SQL; adding 0 turns a negative zero into a plain one."""
    return f"(round({expression}, 6) + 0)"

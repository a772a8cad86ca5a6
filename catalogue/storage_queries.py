"""Round trips through the writers and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from catalogue.bindings import SCORED_SQL, r6, rounded, scored_events, table
from catalogue.registry import register
from moodtide.operators import reports
from moodtide.schemas import POSTS, REPORTS
from moodtide.sources import files, writers
from moodtide.storage import scratch_path, store


@register("""
SELECT CAST(doc_id AS VARCHAR) AS id, CAST('2024-01-01' AS TIMESTAMP) + to_seconds(doc_id) AS "timestamp",
       CASE WHEN lang <> 'de' THEN lang END AS user_id, text, source AS platform
FROM documents
""")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Posts written as CSV and read back under their schema; texts hold quotes, commas, line breaks."""
    rows = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + F.col("doc_id")).alias("timestamp"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("user_id"),
        "text",
        F.col("source").alias("platform"),
    )
    path = scratch_path(spark, "posts_csv")
    writers.write_report(rows, path)
    read = files.read_posts(spark, path, POSTS, multi_line=True)
    return read.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register(f"""WITH {SCORED_SQL}
SELECT event_id, user_id, platform, create_time, sentiment_score, sentiment_category FROM scored""")
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The full scored table, partitioned by class."""
    scored = scored_events(spark, folder)
    path = scratch_path(spark, "scored_table")
    writers.write_table(scored, path, "sentiment_category")
    return spark.read.schema(scored.schema).parquet(path)


@register(f"""WITH {SCORED_SQL}
SELECT sentiment_category, count(*) AS "count", {r6('avg(sentiment_score)')} AS avg_score FROM scored GROUP BY 1""")
def report_readback(spark: SparkSession, folder: str) -> DataFrame:
    """A report written, then read with its neighbours; the ones that were never written come back empty."""
    path = scratch_path(spark, "reports")
    distribution = reports.class_distribution(scored_events(spark, folder))
    writers.write_report(distribution, f"{path}/sentiment_distribution")
    tables, _ = files.read_reports(spark, path, ["sentiment_distribution", "combined_sentiment_distribution"])
    found = tables["sentiment_distribution"].unionByName(tables["combined_sentiment_distribution"])
    return rounded(found.select(REPORTS["sentiment_distribution"].names), "avg_score")


# Every way to spoil a row, dealt over the documents; the last one is sound.
SPOILT_SQL = '''
lines AS (
  SELECT doc_id, doc_id % 7 AS c, CAST(doc_id AS VARCHAR) AS id, n_chars, CAST(n_chars AS VARCHAR) || '.5' AS amount FROM documents
), spoilt AS (
  SELECT CASE c WHEN 0 THEN id || ',' || amount WHEN 1 THEN id || ',many,2024-01-05,' || amount
                WHEN 2 THEN id || ',' || amount || ',2024-01-05,"a, b",more' WHEN 3 THEN id || ',' || amount || ',someday,text'
                WHEN 4 THEN 'x' || id || ',many,2024-01-05,"say ""so"""' WHEN 5 THEN id || ',,,'
                ELSE id || ',' || amount || ',2024-01-05,"a, ""b"""' END AS raw, c, doc_id, n_chars + 0.5 AS amount
  FROM lines
)'''


def _spoilt_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The lines written as a CSV file and read back with their problems, as a stored table."""
    case, id_, amount = F.col("doc_id") % 7, F.col("doc_id").cast("string"), F.concat(F.col("n_chars").cast("string"), F.lit(".5"))
    line = (
        F.when(case == 0, F.concat_ws(",", id_, amount))
        .when(case == 1, F.concat_ws(",", id_, F.lit("many"), F.lit("2024-01-05"), amount))
        .when(case == 2, F.concat_ws(",", id_, amount, F.lit("2024-01-05"), F.lit('"a, b"'), F.lit("more")))
        .when(case == 3, F.concat_ws(",", id_, amount, F.lit("someday"), F.lit("text")))
        .when(case == 4, F.concat(F.lit("x"), F.concat_ws(",", id_, F.lit("many"), F.lit("2024-01-05"), F.lit('"say ""so"""'))))
        .when(case == 5, F.concat(id_, F.lit(",,,")))
        .otherwise(F.concat_ws(",", id_, amount, F.lit("2024-01-05"), F.lit('"a, ""b"""')))
    )
    path = scratch_path(spark, "spoilt_csv")
    table(spark, folder, "documents").select(line.alias("line")).write.text(path)
    schema = StructType().add("id", "long").add("amount", "double").add("day", "date").add("note", "string")
    return store(files.read_checked(spark, path, schema, header=False), "checked_rows")


@register(f"""WITH {SPOILT_SQL}
SELECT CASE c WHEN 1 THEN 'unreadable amount' WHEN 3 THEN 'unreadable day' WHEN 4 THEN 'unreadable id' ELSE 'number of fields' END AS problem, raw
FROM spoilt WHERE c IN (0, 1, 2, 3, 4)""")
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Bad rows of a CSV file with their problem and raw text."""
    bad = files.quarantined(_spoilt_rows(spark, folder))[1]
    return bad.withColumnsRenamed({files.PROBLEM: "problem", files.RAW: "raw"})


@register(f"""WITH {SPOILT_SQL}
SELECT doc_id AS id, CASE WHEN c = 6 THEN CAST(amount AS DOUBLE) END AS amount,
       CASE WHEN c = 6 THEN CAST('2024-01-05' AS DATE) END AS day, CASE WHEN c = 6 THEN 'a, "b"' END AS note
FROM spoilt WHERE c IN (5, 6)""")
def sound_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of the same file, under its schema."""
    return files.quarantined(_spoilt_rows(spark, folder))[0]


@register(f"""WITH {SPOILT_SQL}
SELECT CASE c WHEN 1 THEN 'unreadable amount' WHEN 3 THEN 'unreadable day' WHEN 4 THEN 'unreadable id' ELSE 'number of fields' END AS problem,
       count(*) AS "rows"
FROM spoilt WHERE c IN (0, 1, 2, 3, 4) GROUP BY 1""")
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bad rows counted by problem."""
    return files.problem_counts(_spoilt_rows(spark, folder))

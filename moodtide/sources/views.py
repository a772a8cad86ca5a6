"""SQL names and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# `desc` is a column of notes and an SQL keyword: quote it where it is used.
NOTE_COMMENT_STATS = """
WITH note_groups AS (
    SELECT note_id, title, liked_count, comment_count, COUNT(*) AS copies
    FROM {notes} GROUP BY note_id, title, liked_count, comment_count
), comment_groups AS (
    SELECT note_id, COUNT(comment_id) AS actual FROM {comments} GROUP BY note_id
)
SELECT n.note_id,
       n.title,
       COALESCE(n.liked_count, 0) AS liked_count,
       COALESCE(n.comment_count, 0) AS note_declared_comment_count,
       n.copies * COALESCE(c.actual, 0) AS actual_comment_count
FROM note_groups n LEFT JOIN comment_groups c ON n.note_id = c.note_id
ORDER BY actual_comment_count DESC, note_id, title
"""


def register(notes: DataFrame, comments: DataFrame, notes_name: str = "notes", comments_name: str = "comments") -> None:
    """Give the cleaned tables SQL names in the session."""
    notes.createOrReplaceTempView(notes_name)
    comments.createOrReplaceTempView(comments_name)


def note_comment_stats_sql(
    spark: SparkSession, notes_name: str = "notes", comments_name: str = "comments"
) -> DataFrame:
    """Note statistics as SQL text over the registered names."""
    return spark.sql(NOTE_COMMENT_STATS.format(notes=notes_name, comments=comments_name))

"""Notes and comments brought to one record shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moodtide.functions.numbers import epoch_seconds
from moodtide.functions.text import join_text, not_blank
from moodtide.schemas import TEXT_RECORDS

COMMON_COLUMNS = TEXT_RECORDS.names


def comment_records(comments: DataFrame) -> DataFrame:
    return comments.select(
        F.col("comment_id").alias("id"),
        F.col("content").alias("text"),
        epoch_seconds(F.col("create_time")).alias("create_time"),
        "ip_location",
        "note_id",
        F.lit("comment").alias("type"),
    )


def note_records(notes: DataFrame) -> DataFrame:
    """Title and description as one text; notes left without text are dropped."""
    return notes.select(
        F.col("note_id").alias("id"),
        join_text(F.col("title"), F.col("desc")).alias("text"),
        epoch_seconds(F.col("time")).alias("create_time"),
        "ip_location",
        "note_id",
        F.lit("note").alias("type"),
    ).filter(not_blank(F.col("text")))


def text_union(notes: DataFrame, comments: DataFrame) -> DataFrame:
    """All texts. An id may occur once per type, so the key is (type, id)."""
    return comment_records(comments).select(COMMON_COLUMNS).unionByName(note_records(notes).select(COMMON_COLUMNS))

"""Row filters, null filling and schema checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.functions.numbers import repair_count
from moodtide.functions.text import not_blank

# Fixed value: the choice ("all") that switches an optional filter off.
EVERYTHING = "全部"


class MissingColumns(ValueError):
    """A table lacks columns an operator needs."""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; the table has {df.columns}")
    return df


def nonempty_posts(posts: DataFrame) -> DataFrame:
    """Posts with any text at all; spaces count as text here."""
    return posts.filter(F.col("text").isNotNull() & (F.col("text") != ""))


def repair_counts(notes: DataFrame, *names: str) -> DataFrame:
    """Numeric-text columns to longs."""
    return notes.withColumns({name: repair_count(F.col(name)) for name in names})


def is_valid_note() -> Column:
    worded = not_blank(F.col("title")) | not_blank(F.col("desc"))
    return F.col("note_id").isNotNull() & worded & F.col("time").isNotNull()


def is_valid_comment() -> Column:
    known = F.col("note_id").isNotNull() & F.col("comment_id").isNotNull()
    return known & not_blank(F.col("content")) & F.col("create_time").isNotNull()


def valid_notes(notes: DataFrame) -> DataFrame:
    """Notes with an id, a time, and a title or a description that is not blank."""
    return notes.filter(is_valid_note())


def valid_comments(comments: DataFrame) -> DataFrame:
    """Comments with both ids, a time and content that is not blank."""
    return comments.filter(is_valid_comment())


def with_key(df: DataFrame, name: str) -> DataFrame:
    """Rows whose key column is not blank."""
    return df.filter(not_blank(F.col(name)))


def complete_cases(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


def fill_numbers(df: DataFrame, value: float = 0.0) -> DataFrame:
    """NULL and NaN in numeric columns become ``value``; text and dates are left alone."""
    return df.fillna(value)


def equal_or_all(name: str, value: str | None) -> Column:
    """Equality, or no restriction when the value is None or the everything choice."""
    if value is None or value == EVERYTHING:
        return F.lit(True)
    return F.col(name) == value


def filtered(df: DataFrame, **choices: str | None) -> DataFrame:
    """Independent optional equality filters, combined by AND."""
    for name, value in choices.items():
        df = df.filter(equal_or_all(name, value))
    return df


def members(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Rows whose key occurs in ``keys``: a left-semi join, whatever the size of the list."""
    return df.join(keys.select(name).distinct(), name, "left_semi")

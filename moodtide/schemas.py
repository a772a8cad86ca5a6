"""Declared schemas and the fixed names shared by sources, operators and reports."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _L, _D, _I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()

# CSV: how a NULL is written, and the texts that have to be told apart from it.
NULL_MARK = "\\N"
NULL_LIKE = r"^\\+N$"

# Inputs.
POSTS = _struct(id=_S, timestamp=T.TimestampType(), user_id=_S, text=_S, platform=_S)
NOTES = _struct(
    note_id=_S, title=_S, desc=_S, time=_L, liked_count=_S, comment_count=_S, ip_location=_S, tag_list=_S
)
COMMENTS = _struct(comment_id=_S, note_id=_S, content=_S, create_time=_L, ip_location=_S)

# The record shape shared by notes and comments once they are scored together.
TEXT_RECORDS = _struct(id=_S, text=_S, create_time=_L, ip_location=_S, note_id=_S, type=_S)

# Polarity model: one row per known token.
POLARITY_MODEL = _struct(token=_S, weight=_D, occurrences=_L)

# Report tables, by report name.
REPORTS = {
    "sentiment_distribution": _struct(sentiment_category=_S, count=_L, avg_score=_D),
    "platform_sentiment": _struct(platform=_S, sentiment_category=_S, count=_L),
    "sentiment_sample": _struct(text=_S, sentiment_score=_D, sentiment_category=_S, platform=_S),
    "note_comment_stats": _struct(
        note_id=_S, title=_S, liked_count=_L, note_declared_comment_count=_L, actual_comment_count=_L
    ),
    "comment_daily_distribution": _struct(comment_date=_S, num_comments=_L),
    "combined_sentiment_distribution": _struct(sentiment_category=_S, count=_L, avg_score=_D),
    "combined_sentiment_over_time": _struct(date=_S, sentiment_category=_S, count=_L),
    "combined_sentiment_by_location_sample": _struct(ip_location=_S, sentiment_category=_S, count=_L),
    "combined_sentiment_sample_details": _struct(
        id=_S, note_id=_S, type=_S, text=_S, sentiment_score=_D, sentiment_category=_S, create_time=_L,
        ip_location=_S,
    ),
    "combined_sentiment_by_location": _struct(ip_location=_S, sentiment_category=_S, count=_L),
    "tag_frequency": _struct(tag=_S, tag_count=_L),
    "top_tags_for_wordcloud": _struct(tag=_S, tag_count=_L),
    "sentiment_trend_predictions": _struct(series=_S, date=_S, predicted_sentiment=_D),
    "sentiment_trend_evaluation": _struct(rmse=_D, mae=_D, r2=_D, rows=_L),
}

# The four opinion classes and the two score limits between them.
POSITIVE, NEGATIVE, NEUTRAL, UNKNOWN = "positive", "negative", "neutral", "unknown"
CATEGORIES = [POSITIVE, NEGATIVE, NEUTRAL, UNKNOWN]
POSITIVE_FROM = 0.6
NEGATIVE_TO = 0.4

# Row limits of the exported samples and top lists.
POST_SAMPLE_ROWS = 1000
DETAIL_SAMPLE_ROWS = 5000
TOP_TAG_ROWS = 200
TOP_LOCATION_ROWS = 200

# Series key used when one trend over the whole table is wanted.
WHOLE_TABLE = "all"

"""The notes-and-comments flow: repair, filter, union, score, report, forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame

from moodtide.operators import cube
from moodtide.operators.filters import repair_counts, require_columns, valid_comments, valid_notes
from moodtide.operators.polarity import score_text
from moodtide.operators.records import text_union
from moodtide.operators.reports import comments_per_day, note_comment_stats, tag_frequency, top_rows
from moodtide.plans.trend import forecast_daily
from moodtide.schemas import COMMENTS, DETAIL_SAMPLE_ROWS, NOTES, REPORTS, TOP_LOCATION_ROWS, TOP_TAG_ROWS
from moodtide.sources.generations import new_generation, publish
from moodtide.sources.writers import write_report, write_sample, write_table
from moodtide.storage import small_batches, store

KEY = ["type", "id"]
DETAIL_ORDER = [*KEY, "create_time", "text"]


def clean_tables(notes: DataFrame, comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired and valid rows of both tables."""
    require_columns(notes, NOTES.names)
    require_columns(comments, COMMENTS.names)
    return valid_notes(repair_counts(notes, "liked_count", "comment_count")), valid_comments(comments)


def analyse_notes(
    notes: DataFrame,
    comments: DataFrame,
    model: DataFrame,
    folder: str,
    horizon: int = 30,
    test_size: float = 0.2,
    zone: str | None = None,
) -> bool:
    """Write all reports of the flow as a new set of ``folder``; False, and no new set, when there is nothing to analyse.

    The cleaned tables are written once and re-read, so a database source is scanned a single time
    and a lost executor costs a file read.
    """
    spark, top, folder = notes.sparkSession, folder, new_generation(folder)
    clean_notes, clean_comments = clean_tables(notes, comments)
    write_table(clean_notes, f"{folder}/notes")
    write_table(clean_comments, f"{folder}/comments")
    clean_notes = spark.read.schema(clean_notes.schema).parquet(f"{folder}/notes")
    clean_comments = spark.read.schema(clean_comments.schema).parquet(f"{folder}/comments")
    if clean_notes.isEmpty() and clean_comments.isEmpty():
        return False

    write_report(note_comment_stats(clean_notes, clean_comments), f"{folder}/note_comment_stats")
    write_report(comments_per_day(clean_comments, zone), f"{folder}/comment_daily_distribution")
    tags = store(tag_frequency(clean_notes), "tags")
    write_report(tags, f"{folder}/tag_frequency")
    write_report(top_rows(tags, TOP_TAG_ROWS, "tag_count", "tag"), f"{folder}/top_tags_for_wordcloud")

    texts = text_union(clean_notes, clean_comments)
    if not texts.isEmpty():
        _scored_reports(texts, model, folder, horizon, test_size, zone)
    publish(spark, top, folder)
    return True


def _scored_reports(
    texts: DataFrame, model: DataFrame, folder: str, horizon: int, test_size: float, zone: str | None
) -> None:
    scored = score_text(texts, model, key=KEY)
    with small_batches(texts.sparkSession):
        write_table(scored, f"{folder}/scored", "sentiment_category")
    scored = texts.sparkSession.read.schema(scored.schema).parquet(f"{folder}/scored")

    # One pass over the scored rows for all counts and the daily series.
    counts = store(cube.report_cube(scored, zone=zone), "report_cube")
    write_report(cube.class_distribution(counts), f"{folder}/combined_sentiment_distribution")
    write_report(cube.class_by_day(counts), f"{folder}/combined_sentiment_over_time")
    by_location = cube.class_by_location(counts)
    write_report(by_location, f"{folder}/combined_sentiment_by_location")
    largest = top_rows(by_location, TOP_LOCATION_ROWS, "count", "ip_location", "sentiment_category")
    write_report(largest, f"{folder}/combined_sentiment_by_location_sample")

    # The sample is taken from the scored rows themselves: ids need not be unique.
    details = scored.select(REPORTS["combined_sentiment_sample_details"].names)
    write_sample(details, f"{folder}/combined_sentiment_sample_details", DETAIL_SAMPLE_ROWS, *DETAIL_ORDER)

    trend = forecast_daily(cube.daily_series(counts), horizon, test_size)
    write_report(trend.future.orderBy("series", "date"), f"{folder}/sentiment_trend_predictions")
    write_report(trend.evaluation, f"{folder}/sentiment_trend_evaluation")

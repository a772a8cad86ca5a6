"""The posts flow: filter, score, store, report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from moodtide.operators import cube
from moodtide.operators.filters import nonempty_posts, require_columns
from moodtide.operators.polarity import score_text
from moodtide.operators.reports import counting
from moodtide.schemas import POST_SAMPLE_ROWS
from moodtide.sources.generations import new_generation, publish
from moodtide.sources.writers import write_report, write_table
from moodtide.storage import small_batches, store


def analyse_posts(posts: DataFrame, model: DataFrame, folder: str) -> dict[str, int]:
    """Score posts with a stored polarity model and write the scored table and its reports as a new set of ``folder``.

    The text is read and scored once; the reports read the written table. Returns the row counts,
    taken while the table is written.
    """
    require_columns(posts, ["id", "text", "platform"])
    spark, top, folder = posts.sparkSession, folder, new_generation(folder)
    table = f"{folder}/sentiment_results"
    watched, counted = counting(score_text(nonempty_posts(posts), model, key=["id"]), "posts_scored")
    with small_batches(spark):
        write_table(watched, table)
    scored = spark.read.schema(watched.schema).parquet(table)

    counts = store(cube.report_cube(scored, ["class", "platform"]), "report_cube")
    write_report(cube.class_distribution(counts), f"{folder}/sentiment_distribution")
    write_report(cube.platform_class_counts(counts), f"{folder}/platform_sentiment")
    sample = scored.select("id", "text", "sentiment_score", "sentiment_category", "platform")
    first = sample.orderBy("id", "text").limit(POST_SAMPLE_ROWS).drop("id")
    write_report(first, f"{folder}/sentiment_sample")
    publish(spark, top, folder)
    return {"posts": counted.get["rows"]}

"""All counts of the reports from one pass over the scored records.

``report_cube`` groups by several sets of keys at once, so the scored table is read once whatever the number of reports; its
rows are few (one per key of each set) and are meant to be stored. The reports below select theirs from it. They equal the
plain groupings in ``reports`` and ``series``, which read the scored table once each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.functions.dates import day_string
from moodtide.functions.text import not_blank
from moodtide.operators.filters import require_columns
from moodtide.operators.reports import CLASS, SCORE
from moodtide.schemas import WHOLE_TABLE

# Keys of each report. The daily series has no class.
KEYS = {
    "class": [CLASS],
    "platform": ["platform", CLASS],
    "day": ["date", CLASS],
    "place": ["ip_location", CLASS],
    "series": ["series", "date"],
}


def report_cube(
    scored: DataFrame, reports: Sequence[str] = ("class", "day", "place", "series"), series: str | Column | None = None, zone: str | None = None
) -> DataFrame:
    """report, its keys (NULL where not its own), count, scored, avg_score, score_std: one row per key of each report.

    ``scored`` needs the columns of the reports asked for: ip_location, platform, create_time (days are cut in ``zone``).
    """
    require_columns(scored, [CLASS, SCORE])
    key = F.lit(WHOLE_TABLE) if series is None else F.col(series) if isinstance(series, str) else series
    made = {"date": lambda: day_string(F.col("create_time"), zone), "series": lambda: key}
    names = list(dict.fromkeys(name for report in reports for name in KEYS[report]))
    narrow = scored.select(*((made[name]() if name in made else F.col(name)).alias(name) for name in names), SCORE)
    sets = [[F.col(name) for name in KEYS[report]] for report in reports]
    cube = narrow.groupingSets(sets, *(F.col(name) for name in names)).agg(
        F.grouping_id().alias("_set"),
        F.count("*").alias("count"),
        F.count(SCORE).alias("scored"),
        F.avg(SCORE).alias("avg_score"),
        F.stddev_samp(SCORE).alias("score_std"),
    )
    # In the id of a set a bit is 1 for every key it leaves out, the first key being the highest bit.
    ids = {report: sum((name not in KEYS[report]) << i for i, name in enumerate(reversed(names))) for report in reports}
    report = F.coalesce(*(F.when(F.col("_set") == number, F.lit(name)) for name, number in ids.items()))
    return cube.select(report.alias("report"), *names, "count", "scored", "avg_score", "score_std")


def part_of(cube: DataFrame, report: str) -> DataFrame:
    return cube.filter(F.col("report") == report)


def class_distribution(cube: DataFrame) -> DataFrame:
    """Rows and mean score per class, largest first."""
    return part_of(cube, "class").select(CLASS, "count", "avg_score").orderBy(F.desc("count"), CLASS)


def platform_class_counts(cube: DataFrame) -> DataFrame:
    return part_of(cube, "platform").select("platform", CLASS, "count").orderBy("platform", "count", CLASS)


def class_by_day(cube: DataFrame) -> DataFrame:
    return part_of(cube, "day").select("date", CLASS, "count").orderBy("date", CLASS)


def class_by_location(cube: DataFrame) -> DataFrame:
    """Records per place and class, largest first; those without a place are left out."""
    placed = part_of(cube, "place").filter(not_blank(F.col("ip_location")))
    return placed.select("ip_location", CLASS, "count").orderBy(F.desc("count"), "ip_location", CLASS)


def daily_series(cube: DataFrame) -> DataFrame:
    """Mean, count and sample deviation of the score per series and day that has scored records."""
    days = part_of(cube, "series").filter((F.col("scored") > 0) & F.col("date").isNotNull())
    return days.select(
        "series",
        "date",
        F.col("avg_score").alias("avg_sentiment"),
        F.col("scored").alias("post_count"),
        F.col("score_std").alias("sentiment_std"),
    )

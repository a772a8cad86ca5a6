"""Daily series and their window features.

Windows are partitioned by a series key. A series has one row per day with data, so a window
partition is bounded by the calendar however many records a day holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from moodtide.functions.dates import DAY_FORMAT, calendar_parts, day_string, parse_day, shift_day
from moodtide.operators.filters import complete_cases, fill_numbers
from moodtide.schemas import WHOLE_TABLE

FEATURES = [
    "post_count",
    "sentiment_std",
    "sentiment_lag_1",
    "sentiment_lag_2",
    "sentiment_ma_7",
    "day_of_week",
    "month",
    "year",
]
MOVING_DAYS = 7


def by_day() -> WindowSpec:
    return Window.partitionBy("series").orderBy("date")


def daily_series(scored: DataFrame, series: str | Column | None = None, zone: str | None = None) -> DataFrame:
    """Mean, count and sample deviation of the score per series and day; unscored rows are left out."""
    if series is None:
        series = F.lit(WHOLE_TABLE)
    key = F.col(series) if isinstance(series, str) else series
    return (
        complete_cases(scored.withColumn("series", key), "sentiment_score", "create_time")
        .groupBy("series", day_string(F.col("create_time"), zone).alias("date"))
        .agg(
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.count("*").alias("post_count"),
            F.stddev_samp("sentiment_score").alias("sentiment_std"),
        )
    )


def trend_features(daily: DataFrame) -> DataFrame:
    """Lags, 7-row moving mean including the day itself, and calendar parts; gaps become 0.0."""
    days = by_day()
    return fill_numbers(
        daily.withColumns(
            {
                "sentiment_lag_1": F.lag("avg_sentiment", 1).over(days),
                "sentiment_lag_2": F.lag("avg_sentiment", 2).over(days),
                "sentiment_ma_7": F.avg("avg_sentiment").over(days.rowsBetween(1 - MOVING_DAYS, 0)),
                "date_parsed": parse_day(F.col("date")),
            }
        ).withColumns(calendar_parts(F.col("date_parsed")))
    )


def split_mark(features: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``is_train``: the first ``floor(n * (1 - test_size))`` days of each series."""
    whole = Window.partitionBy("series")
    train_rows = F.floor(F.count("*").over(whole) * F.lit(1 - test_size))
    return features.withColumn("is_train", F.row_number().over(by_day()) <= train_rows)


def train_part(marked: DataFrame) -> DataFrame:
    return marked.filter("is_train").drop("is_train")


def test_part(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("is_train")).drop("is_train")


def subtract_rows(features: DataFrame, train: DataFrame) -> DataFrame:
    """Distinct rows of ``features`` that are not in ``train``."""
    return features.subtract(train)


def last_rows(features: DataFrame) -> DataFrame:
    """The latest row of each series."""
    others = [name for name in features.columns if name != "series"]
    latest = F.max_by(F.struct(*others), "date").alias("latest")
    return features.groupBy("series").agg(latest).select("series", "latest.*")


def future_calendar(features: DataFrame, horizon: int) -> DataFrame:
    """The ``horizon`` days after the last one of each series, with their calendar parts."""
    last = features.groupBy("series").agg(F.max(parse_day(F.col("date"))).alias("last_date"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    days = last.select("series", "last_date", steps).withColumn("day", shift_day(F.col("last_date"), F.col("step")))
    return days.select("series", F.date_format("day", DAY_FORMAT).alias("date"), "day").withColumns(
        calendar_parts(F.col("day"))
    ).drop("day")


def standardised(features: DataFrame, train: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus the training mean over the training deviation; a constant column becomes 0."""
    stats = train.agg(
        F.struct(
            *[F.avg(name).alias(f"{name}_mean") for name in columns],
            *[F.stddev_samp(name).alias(f"{name}_std") for name in columns],
        )
    ).scalar()

    def scaled(name: str) -> Column:
        deviation = F.col("stats")[f"{name}_std"]
        return F.when(deviation > 0, (F.col(name) - F.col("stats")[f"{name}_mean"]) / deviation).otherwise(0.0)

    others = [name for name in features.columns if name not in columns]
    return features.withColumn("stats", stats).select(*others, *[scaled(name).alias(name) for name in columns])


def forecast_quality(predicted: DataFrame, label: str, prediction: str, *keys: str) -> DataFrame:
    """RMSE, MAE and R2 in one pass, overall or per key."""
    error = F.col(label) - F.col(prediction)
    squared = F.sum(error * error)
    spread = F.var_pop(label) * F.count(label)
    measures = [
        F.sqrt(squared / F.count(label)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, spread)).alias("r2"),
        F.count(label).alias("rows"),
    ]
    return predicted.groupBy(*keys).agg(*measures)

"""Regression forest over leak-free daily features, and a step-by-step forecast.

Every feature of a day is known before that day: lags of the mean, the mean of the seven days
before, the previous day's count and deviation, and the calendar.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from moodtide.functions.dates import DAY_FORMAT, calendar_parts, parse_day, shift_day
from moodtide.functions.numbers import clamp_score
from moodtide.operators.forest import Forest, grow_forest, walked
from moodtide.operators.series import MOVING_DAYS, by_day, split_mark
from moodtide.storage import store

# Python workers need only what Spark ships to them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL_FEATURES = [
    "sentiment_lag_1",
    "sentiment_lag_2",
    "sentiment_past_7",
    "post_count_lag_1",
    "sentiment_std_lag_1",
    "day_of_week",
    "month",
    "year",
]
TREES = 50
DEPTH = 10
SEED = 42

# Steps whose plans are stacked before the state is written and read back.
STACKED_STEPS = 5


def model_rows(daily: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Label, features and train mark per day, plus the seven latest means a forecast starts from."""
    days = by_day()
    deviation = F.coalesce("sentiment_std", F.lit(0.0))
    return split_mark(daily, test_size).withColumns(
        {
            "label": F.col("avg_sentiment"),
            "sentiment_lag_1": F.lag("avg_sentiment", 1).over(days),
            "sentiment_lag_2": F.lag("avg_sentiment", 2).over(days),
            "sentiment_past_7": F.avg("avg_sentiment").over(days.rowsBetween(-MOVING_DAYS, -1)),
            "post_count_lag_1": F.lag("post_count", 1).over(days),
            "sentiment_std_lag_1": F.lag(deviation, 1).over(days),
            "recent": F.collect_list("avg_sentiment").over(days.rowsBetween(1 - MOVING_DAYS, 0)),
            **calendar_parts(parse_day(F.col("date"))),
        }
    )


def with_history(rows: DataFrame) -> DataFrame:
    """Days that have both lags; the first two of each series have not."""
    return rows.filter(F.col("sentiment_lag_2").isNotNull())


def scaling_stages() -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features_raw", handleInvalid="skip"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        ]
    )


def train_rows(rows: DataFrame) -> DataFrame:
    """The training days of all series that have their history."""
    return with_history(rows).filter("is_train").select("series", "date", "label", *MODEL_FEATURES)


def fit_forest(
    rows: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = SEED, bootstrap: bool = True, subset: str = "auto"
) -> Forest:
    """Fit a forest on the training days of all series. ``rows`` should be a stored table.

    Trees split on order alone, so the features are not scaled first: the forest would be the same.
    """
    return grow_forest(train_rows(rows), MODEL_FEATURES, ["series", "date"], trees, depth, seed, bootstrap, subset)


def predict_test_days(rows: DataFrame, model: Forest | Transformer) -> DataFrame:
    test = with_history(rows).filter(~F.col("is_train"))
    return model.transform(test).select("series", "date", "label", "prediction")


def forecast_start(rows: DataFrame) -> DataFrame:
    """State per series after its latest day: newest mean first; count and deviation stay as they are."""
    state = F.struct(
        parse_day(F.col("date")).alias("last_date"),
        F.col("avg_sentiment").alias("sentiment_lag_1"),
        F.coalesce("sentiment_lag_1", F.lit(0.0)).alias("sentiment_lag_2"),
        F.reverse("recent").alias("recent"),
        F.col("post_count").alias("post_count_lag_1"),
        F.coalesce("sentiment_std", F.lit(0.0)).alias("sentiment_std_lag_1"),
    )
    return rows.groupBy("series").agg(F.max_by(state, "date").alias("state")).select("series", "state.*")


def forecast(rows: DataFrame, model: Forest | Transformer, horizon: int = 30) -> DataFrame:
    """``horizon`` consecutive days after the last one of every series, all series at once.

    ``model`` is anything that adds ``prediction`` to rows with the model features.

    Each step is a projection over one row per series and feeds its prediction to the next; the
    predictions collect in an array that is unfolded at the end, so no step is computed twice.
    """
    next_day = shift_day(F.col("last_date"), 1)
    mean = F.aggregate("recent", F.lit(0.0), lambda total, x: total + x) / F.size("recent")
    inputs = {"last_date": next_day, "sentiment_past_7": mean, **calendar_parts(next_day)}
    latest = F.col("prediction")
    outcome = [
        F.col("series"),
        F.col("last_date"),
        latest.alias("sentiment_lag_1"),
        F.col("sentiment_lag_1").alias("sentiment_lag_2"),
        F.slice(F.concat(F.array(latest), "recent"), 1, MOVING_DAYS).alias("recent"),
        F.col("post_count_lag_1"),
        F.col("sentiment_std_lag_1"),
        F.concat("path", F.array(F.struct(F.col("last_date").alias("day"), latest.alias("value")))).alias("path"),
    ]
    state = forecast_start(rows).withColumn("path", F.array().cast("array<struct<day:date,value:double>>"))
    for step in range(1, horizon + 1):
        state = model.transform(state.withColumns(inputs)).select(outcome)
        if step % STACKED_STEPS == 0 and step < horizon:
            state = store(state, "forecast_state")
    return state.select("series", F.explode("path").alias("point")).select(
        "series",
        F.date_format("point.day", DAY_FORMAT).alias("date"),
        clamp_score(F.col("point.value")).alias("predicted_sentiment"),
    )


def forecast_in_tasks(rows: DataFrame, model: Forest, horizon: int = 30) -> DataFrame:
    """The same as ``forecast`` for a forest, in one stage: its arrays travel to the tasks, each of which
    advances its series, one row each, through all steps at once."""
    shipped = rows.sparkSession.sparkContext.broadcast((model.feature, model.threshold, model.value))
    width = MOVING_DAYS

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            n = len(part)
            held = np.array([min(len(r), width) for r in part["recent"]], np.int64)
            recent = np.zeros((n, width))
            for i, values in enumerate(part["recent"]):
                recent[i, : held[i]] = values[:width]
            day = part["last_date"].to_numpy().astype("datetime64[D]")
            lag1, lag2 = part["sentiment_lag_1"].to_numpy(float), part["sentiment_lag_2"].to_numpy(float)
            count, deviation = part["post_count_lag_1"].to_numpy(float), part["sentiment_std_lag_1"].to_numpy(float)
            days, path = np.empty((n, horizon), "datetime64[D]"), np.empty((n, horizon))
            for step in range(horizon):
                day = day + 1
                total = np.zeros(n)
                for k in range(width):
                    total += np.where(k < held, recent[:, k], 0.0)
                month = day.astype("datetime64[M]").astype(np.int64)
                calendar = (day.astype(np.int64) + 4) % 7 + 1, month % 12 + 1, month // 12 + 1970
                x = np.column_stack([lag1, lag2, total / held, count, deviation, *calendar])
                value = walked(*shipped.value, x)
                days[:, step], path[:, step] = day, value
                lag1, lag2 = value, lag1
                recent = np.column_stack([value, recent[:, :-1]])
                held = np.minimum(held + 1, width)
            yield pd.DataFrame(
                {
                    "series": np.repeat(part["series"].to_numpy(), horizon),
                    "day": days.ravel().astype("datetime64[ms]"),
                    "value": path.ravel(),
                }
            )

    start = forecast_start(rows).withColumn("last_date", F.col("last_date").cast("timestamp_ntz"))
    kind = rows.schema["series"].dataType.simpleString()
    steps = start.mapInPandas(run, f"series {kind}, day timestamp_ntz, value double")
    return steps.select(
        "series", F.date_format("day", DAY_FORMAT).alias("date"), clamp_score(F.col("value")).alias("predicted_sentiment")
    )

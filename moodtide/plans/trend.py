"""The trend flow: daily rows, forest, quality on the later days, forecast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from moodtide.operators.forecast import fit_forest, forecast_in_tasks, model_rows, predict_test_days, with_history
from moodtide.operators.forest import Forest
from moodtide.operators.series import daily_series, forecast_quality
from moodtide.schemas import REPORTS
from moodtide.storage import store


@dataclass(frozen=True)
class Trend:
    model: Forest | None
    evaluation: DataFrame
    future: DataFrame


def stored_model_rows(
    scored: DataFrame, series: str | Column | None = None, test_size: float = 0.2, zone: str | None = None
) -> DataFrame:
    """Daily rows written once: every tree level reads them, and the scored records only here."""
    return store(model_rows(daily_series(scored, series, zone), test_size), "daily")


def forecast_trend(
    scored: DataFrame,
    series: str | Column | None = None,
    horizon: int = 30,
    test_size: float = 0.2,
    zone: str | None = None,
) -> Trend:
    """Fit one forest over all series, measure it on the later days, forecast every series.

    ``scored`` has sentiment_score and create_time (epoch seconds); without a series key the whole
    table is one series. Without a training day that has both lags the result tables are empty.
    """
    return forecast_daily(daily_series(scored, series, zone), horizon, test_size)


def forecast_daily(daily: DataFrame, horizon: int = 30, test_size: float = 0.2) -> Trend:
    """The same from daily rows."""
    rows = store(model_rows(daily, test_size), "daily")
    if with_history(rows).filter("is_train").isEmpty():
        nothing = [
            daily.sparkSession.createDataFrame([], REPORTS[name])
            for name in ("sentiment_trend_evaluation", "sentiment_trend_predictions")
        ]
        return Trend(None, *nothing)
    model = fit_forest(rows)
    evaluation = forecast_quality(predict_test_days(rows, model), "label", "prediction")
    return Trend(model, evaluation, forecast_in_tasks(rows, model, horizon))

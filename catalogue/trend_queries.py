"""Daily series, window features, split, standardisation and forecasts."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.bindings import SCORED_SQL, ZONE, r6, rounded, scored_events
from catalogue.registry import register
from moodtide.operators import forecast, forest, series
from moodtide.plans.trend import stored_model_rows
from moodtide.storage import store

HORIZON = 30


def daily_sql(key: str) -> str:
    return f"""{SCORED_SQL}, daily AS (
  SELECT {key} AS series, "date", avg(sentiment_score) AS avg_sentiment, count(*) AS post_count,
         stddev_samp(sentiment_score) AS sentiment_std
  FROM scored WHERE sentiment_score IS NOT NULL AND create_time IS NOT NULL GROUP BY 1, 2
)"""


FEATURES_SQL = f"""{daily_sql('platform')}, features AS (
  SELECT series, "date", avg_sentiment, post_count, coalesce(sentiment_std, 0) AS sentiment_std,
         coalesce(lag(avg_sentiment, 1) OVER days, 0) AS sentiment_lag_1,
         coalesce(lag(avg_sentiment, 2) OVER days, 0) AS sentiment_lag_2,
         avg(avg_sentiment) OVER (days ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sentiment_ma_7,
         CAST("date" AS DATE) AS date_parsed,
         CAST(dayofweek(CAST("date" AS DATE)) + 1 AS INTEGER) AS day_of_week,
         CAST(month(CAST("date" AS DATE)) AS INTEGER) AS "month",
         CAST(year(CAST("date" AS DATE)) AS INTEGER) AS "year"
  FROM daily WINDOW days AS (PARTITION BY series ORDER BY "date")
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY "date")
              <= floor(count(*) OVER (PARTITION BY series) * (1 - CAST(0.2 AS DOUBLE))) AS is_train
  FROM features
)"""

FEATURE_DOUBLES = ["avg_sentiment", "sentiment_std", "sentiment_lag_1", "sentiment_lag_2", "sentiment_ma_7"]
FEATURE_LIST_SQL = (
    'series, "date", post_count, date_parsed, day_of_week, "month", "year", '
    + ", ".join(f"{r6(name)} AS {name}" for name in FEATURE_DOUBLES)
)


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return series.daily_series(scored_events(spark, folder), "platform", ZONE)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return series.trend_features(_daily(spark, folder))


def _stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per series and day, written once for queries that read it twice."""
    return store(_features(spark, folder), "features")


def daily_list_sql(key: str) -> str:
    return f"""WITH {daily_sql(key)}
SELECT series, "date", {r6('avg_sentiment')} AS avg_sentiment, post_count, {r6('sentiment_std')} AS sentiment_std
FROM daily"""


@register(daily_list_sql("platform"))
def daily_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_daily(spark, folder), "avg_sentiment", "sentiment_std")


@register(daily_list_sql("'all'"))
def daily_series_whole_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.daily_series(scored_events(spark, folder), zone=ZONE), "avg_sentiment", "sentiment_std")


@register(f"WITH {FEATURES_SQL} SELECT {FEATURE_LIST_SQL} FROM features")
def trend_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_features(spark, folder), *FEATURE_DOUBLES)


@register(f'WITH {FEATURES_SQL} SELECT series, "date", is_train FROM marked')
def chronological_split(spark: SparkSession, folder: str) -> DataFrame:
    return series.split_mark(_features(spark, folder)).select("series", "date", "is_train")


@register(f"""WITH {FEATURES_SQL}
SELECT {FEATURE_LIST_SQL} FROM (SELECT * EXCLUDE (is_train) FROM marked
  EXCEPT SELECT * EXCLUDE (is_train) FROM marked WHERE is_train)""")
def split_by_subtraction(spark: SparkSession, folder: str) -> DataFrame:
    features = rounded(_stored_features(spark, folder), *FEATURE_DOUBLES)
    return series.subtract_rows(features, series.train_part(series.split_mark(features)))


@register(f"""WITH {FEATURES_SQL}, latest AS (SELECT series, max("date") AS "date" FROM features GROUP BY 1)
SELECT {FEATURE_LIST_SQL} FROM features JOIN latest USING (series, "date")""")
def last_feature_row(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.last_rows(_features(spark, folder)), *FEATURE_DOUBLES)


def scaled_sql(name: str) -> str:
    deviation = f'(SELECT stddev_samp("{name}") FROM marked WHERE is_train)'
    mean = f'(SELECT avg("{name}") FROM marked WHERE is_train)'
    scaled = f'CASE WHEN {deviation} > 0 THEN ("{name}" - {mean}) / {deviation} ELSE 0 END'
    return f'{r6(scaled)} AS "{name}"'


@register(f"""WITH {FEATURES_SQL}
SELECT series, "date", is_train, {', '.join(map(scaled_sql, series.FEATURES))} FROM marked""")
def standardised_features(spark: SparkSession, folder: str) -> DataFrame:
    marked = series.split_mark(_stored_features(spark, folder))
    scaled = series.standardised(marked, marked.filter("is_train"), series.FEATURES)
    return rounded(scaled.select("series", "date", "is_train", *series.FEATURES), *series.FEATURES)


ERROR_SQL = "avg_sentiment - sentiment_lag_1"


@register(f"""WITH {FEATURES_SQL}
SELECT series, {r6(f'sqrt(avg(pow({ERROR_SQL}, 2)))')} AS rmse, {r6(f'avg(abs({ERROR_SQL}))')} AS mae,
       {r6(f'1 - sum(pow({ERROR_SQL}, 2)) / (var_pop(avg_sentiment) * count(*))')} AS r2, count(*) AS "rows"
FROM marked WHERE NOT is_train GROUP BY series""")
def naive_forecast_eval(spark: SparkSession, folder: str) -> DataFrame:
    """Yesterday's mean as the prediction, measured on the later days of each series."""
    test = series.test_part(series.split_mark(_features(spark, folder)))
    quality = series.forecast_quality(test, "avg_sentiment", "sentiment_lag_1", "series")
    return rounded(quality, "rmse", "mae", "r2")


@register(f"""WITH {FEATURES_SQL}, latest AS (SELECT series, max(date_parsed) AS last_date FROM features GROUP BY 1),
days AS (SELECT series, last_date + CAST(step AS INTEGER) AS day FROM latest, range(1, {HORIZON + 1}) AS steps(step))
SELECT series, strftime(day, '%Y-%m-%d') AS "date", CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week,
       CAST(month(day) AS INTEGER) AS "month", CAST(year(day) AS INTEGER) AS "year" FROM days""")
def future_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return series.future_calendar(_features(spark, folder), HORIZON)


# What is known before any model: calendar, rows, and labels on the same rows the model sees.
MODEL_ROWS_SQL = f"""{daily_sql('platform')}, model_rows AS (
  SELECT series, "date", avg_sentiment AS label, lag(avg_sentiment, 1) OVER days AS sentiment_lag_1,
         lag(avg_sentiment, 2) OVER days AS sentiment_lag_2,
         avg(avg_sentiment) OVER (days ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sentiment_past_7,
         CAST(lag(post_count, 1) OVER days AS DOUBLE) AS post_count_lag_1,
         lag(coalesce(sentiment_std, 0), 1) OVER days AS sentiment_std_lag_1,
         CAST(dayofweek(CAST("date" AS DATE)) + 1 AS DOUBLE) AS day_of_week,
         CAST(month(CAST("date" AS DATE)) AS DOUBLE) AS "month", CAST(year(CAST("date" AS DATE)) AS DOUBLE) AS "year",
         row_number() OVER days <= floor(count(*) OVER (PARTITION BY series) * (1 - CAST(0.2 AS DOUBLE))) AS is_train
  FROM daily WINDOW days AS (PARTITION BY series ORDER BY "date")
), known AS (SELECT * FROM model_rows WHERE sentiment_lag_2 IS NOT NULL), train AS (SELECT * FROM known WHERE is_train)"""

FUTURE_SQL = f"""
latest AS (SELECT series, max(CAST("date" AS DATE)) AS last_date FROM daily GROUP BY 1),
days AS (SELECT series, last_date + CAST(step AS INTEGER) AS day FROM latest, range(1, {HORIZON + 1}) AS steps(step)),
bounds AS (SELECT min(label) AS low, max(label) AS high FROM train)"""


def _within_labels(rows: DataFrame, value: str) -> DataFrame:
    """Whether a value lies in the range of the training labels, which no forest can leave."""
    return rows.select("series", "date", F.col(value).between(F.col("low") - 1e-9, F.col("high") + 1e-9).alias("in_range"))


def _label_range(model_rows: DataFrame) -> DataFrame:
    return forecast.with_history(model_rows).filter("is_train").agg(F.min("label").alias("low"), F.max("label").alias("high"))


@register(f"""WITH {MODEL_ROWS_SQL}, {FUTURE_SQL}
SELECT series, strftime(day, '%Y-%m-%d') AS "date", low <= high AS in_range FROM days, bounds""")
def forest_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty days ahead for every series, from one forest over all of them: days, and values within the labels."""
    rows = stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE)
    future = forecast.forecast_in_tasks(rows, forecast.fit_forest(rows), HORIZON)
    return _within_labels(future.crossJoin(F.broadcast(_label_range(rows))), "predicted_sentiment")


@register(f"""WITH {MODEL_ROWS_SQL}
SELECT series, "date", {r6('label')} AS label, label IS NOT NULL AS in_range FROM known WHERE NOT is_train""")
def forest_eval(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the forest for the later days: their rows and labels, and values within the labels."""
    rows = stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE)
    predicted = forecast.predict_test_days(rows, forecast.fit_forest(rows)).crossJoin(F.broadcast(_label_range(rows)))
    held = _within_labels(predicted, "prediction").join(predicted.select("series", "date", "label"), ["series", "date"])
    return rounded(held.select("series", "date", "label", "in_range"), "label")


@register(f"""WITH {MODEL_ROWS_SQL}, mean AS (SELECT avg(label) AS guess FROM train)
SELECT series, {r6('sqrt(avg(pow(label - guess, 2)))')} AS rmse, {r6('avg(abs(label - guess))')} AS mae, count(*) AS "rows"
FROM known, mean WHERE NOT is_train GROUP BY series""")
def forest_exact(spark: SparkSession, folder: str) -> DataFrame:
    """The whole pipeline with one tree of depth 0 over all rows: it predicts the mean training label."""
    rows = stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE)
    model = forecast.fit_forest(rows, trees=1, depth=0, bootstrap=False, subset="all")
    quality = series.forecast_quality(forecast.predict_test_days(rows, model), "label", "prediction", "series")
    return rounded(quality.select("series", "rmse", "mae", "rows"), "rmse", "mae")


# One split over all training days: the grid's thresholds, labels in fixed point, the first of the best splits.
LONG_SQL = " UNION ALL ".join(
    f'SELECT series, "date", label, is_train, {i} AS f, CAST("{name}" AS DOUBLE) AS x FROM known'
    for i, name in enumerate(forecast.MODEL_FEATURES)
)
STUMP_SQL = f"""{MODEL_ROWS_SQL}, long AS ({LONG_SQL}), ends AS (SELECT min(label) AS first, max(label) AS last FROM train
), bounds AS (SELECT f, min(x) AS lo, max(x) AS hi, count(*) AS n FROM long WHERE is_train GROUP BY f
), cells AS (
  SELECT f, lo, hi, n, least({forest.GRID - 1}, CASE WHEN hi > lo THEN floor((x - lo) / (hi - lo) * {forest.GRID}) ELSE 0 END) AS cell, count(*) AS c
  FROM long JOIN bounds USING (f) WHERE is_train GROUP BY ALL
), summed AS (
  SELECT *, sum(c) OVER (PARTITION BY f ORDER BY cell) AS upto, max(cell) OVER (PARTITION BY f) AS top FROM cells
), picked AS (
  SELECT f, lo, hi, top, q, min(cell) AS cell FROM summed, range(1, {forest.BINS}) AS quantiles(q)
  WHERE upto * {forest.BINS} >= n * q GROUP BY ALL
), thresholds AS (SELECT DISTINCT f, cell, lo + (cell + 1) * (hi - lo) / {forest.GRID} AS t FROM picked WHERE cell < top
), fixed AS (
  SELECT f, x, CAST(round((label - first) / (last - first) * {forest.STEPS}) AS BIGINT) AS y FROM long, ends WHERE is_train
), splits AS (
  SELECT f, cell, t, CAST(sum(y) FILTER (x <= t) AS DOUBLE) AS sl, count(*) FILTER (x <= t) AS nl,
         CAST(sum(y) FILTER (x > t) AS DOUBLE) AS sr, count(*) FILTER (x > t) AS nr
  FROM fixed JOIN thresholds USING (f) GROUP BY ALL
), best AS (SELECT * FROM splits WHERE nl > 0 AND nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC, f, cell LIMIT 1)"""


@register(f"""WITH {STUMP_SQL}
SELECT series, "date", {r6('label')} AS label,
       {r6(f'first + CASE WHEN x <= t THEN sl / nl ELSE sr / nr END / {forest.STEPS} * (last - first)')} AS prediction
FROM long JOIN best USING (f), ends WHERE NOT is_train""")
def forest_stump(spark: SparkSession, folder: str) -> DataFrame:
    """One tree of one split over all rows and features: its predictions for the later days."""
    rows = stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE)
    model = forecast.fit_forest(rows, trees=1, depth=1, bootstrap=False, subset="all")
    return rounded(forecast.predict_test_days(rows, model), "label", "prediction")


VECTOR_SQL = ", ".join(
    f"""{r6(f'("{n}" - (SELECT avg("{n}") FROM train)) / coalesce(nullif((SELECT stddev_samp("{n}") FROM train), 0), 1)')}"""
    f' * CAST((SELECT stddev_samp("{n}") FROM train) > 0 AS INTEGER) AS "{n}"'
    for n in forecast.MODEL_FEATURES
)


@register(f"""WITH {MODEL_ROWS_SQL} SELECT series, "date", {VECTOR_SQL} FROM known""")
def scaled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The assembler and scaler stages as the forest sees them, unfolded again."""
    rows = forecast.with_history(stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE))
    stages = forecast.scaling_stages().fit(forecast.train_rows(rows))
    values = vector_to_array(F.col("features"))
    columns = [F.get(values, F.lit(i)).alias(name) for i, name in enumerate(forecast.MODEL_FEATURES)]
    return rounded(stages.transform(rows).select("series", "date", *columns), *forecast.MODEL_FEATURES)


class MeanOfRecent(Transformer):
    """Predicts the mean of the seven latest values."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", F.col("sentiment_past_7"))


@register(f"""WITH RECURSIVE {daily_sql('platform').strip()}, latest AS (
  SELECT series, max(CAST("date" AS DATE)) AS last_date,
         list(avg_sentiment ORDER BY "date" DESC)[1:7] AS recent FROM daily GROUP BY series
), steps AS (
  SELECT series, 1 AS step, last_date, recent, list_avg(recent) AS value FROM latest
  UNION ALL
  SELECT series, step + 1, last_date, list_concat([value], recent)[1:7], list_avg(list_concat([value], recent)[1:7])
  FROM steps WHERE step < {HORIZON}
)
SELECT series, strftime(last_date + step, '%Y-%m-%d') AS "date", {r6('value')} AS predicted_sentiment FROM steps""")
def recursive_mean_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The step-by-step forecast with a model that SQL can follow."""
    rows = stored_model_rows(scored_events(spark, folder), "platform", zone=ZONE)
    return rounded(forecast.forecast(rows, MeanOfRecent(), HORIZON), "predicted_sentiment")

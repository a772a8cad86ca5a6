import datetime
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from moodtide.operators import forecast, forest, series
from moodtide.plans.trend import forecast_trend, stored_model_rows
from tests.conftest import plan_of, values

DAY = 86400
START = 1735689600  # 2025-01-01


def records(days, gap_after=None):
    """Two series with one to four records per day; a gap of three days when asked for."""
    rows = []
    for name, phase in (("x", 0.0), ("y", 1.0)):
        for i in range(days):
            shift = 3 if gap_after is not None and i > gap_after else 0
            for k in range(1 + (i * 7) % 4):
                score = 0.5 + 0.3 * math.sin(i / 3 + phase) + 0.02 * k
                rows.append((name, score, START + (i + shift) * DAY + k * 60))
    return rows + [("x", None, START), ("x", 0.5, None)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(records(40, gap_after=20), "series_name string, sentiment_score double, create_time long")


@pytest.fixture(scope="module")
def daily(scored):
    return series.daily_series(scored, "series_name")


@pytest.fixture(scope="module")
def rows(scored):
    return stored_model_rows(scored, "series_name")


@pytest.fixture(scope="module")
def model(rows):
    return forecast.fit_forest(rows, trees=5)


def test_daily_series(daily):
    got = {(r["series"], r["date"]): r for r in daily.collect()}
    assert len(got) == 80 and got["x", "2025-01-01"]["post_count"] == 1
    assert got["x", "2025-01-01"]["sentiment_std"] is None
    scores = [0.5 + 0.3 * math.sin(1 / 3) + 0.02 * k for k in range(4)]
    day = got["x", "2025-01-02"]
    assert day["post_count"] == 4
    assert math.isclose(day["avg_sentiment"], statistics.mean(scores))
    assert math.isclose(day["sentiment_std"], statistics.stdev(scores))


def test_features_follow_present_days(daily):
    got = [r for r in series.trend_features(daily).orderBy("series", "date").collect() if r["series"] == "x"]
    means = [r["avg_sentiment"] for r in got]
    assert (got[0]["sentiment_lag_1"], got[0]["sentiment_lag_2"], got[0]["sentiment_std"]) == (0.0, 0.0, 0.0)
    assert (got[1]["sentiment_lag_1"], got[1]["sentiment_lag_2"]) == (means[0], 0.0)
    assert got[21]["date"] == "2025-01-25" and got[21]["sentiment_lag_1"] == means[20]  # across the gap
    assert math.isclose(got[9]["sentiment_ma_7"], statistics.mean(means[3:10]))
    assert got[0]["date_parsed"] == datetime.date(2025, 1, 1)
    assert (got[0]["day_of_week"], got[0]["month"], got[0]["year"]) == (4, 1, 2025)


def test_windows_stay_within_a_series(daily):
    plan = plan_of(series.trend_features(daily))
    assert "SinglePartition" not in plan and "Window" in plan
    assert "SinglePartition" not in plan_of(series.split_mark(daily))


@pytest.mark.parametrize("n, train", [(1, 0), (5, 4), (10, 8), (30, 24), (560, 448)])
def test_split_sizes(spark, n, train):
    days = spark.range(n).select(F.lit("s").alias("series"), F.format_string("%05d", "id").alias("date"))
    marked = series.split_mark(days)
    assert series.train_part(marked).count() == train
    assert series.train_part(marked).agg(F.max("date")).first()[0] == (f"{train - 1:05d}" if train else None)
    rest = series.subtract_rows(days, series.train_part(marked))
    assert values(rest) == values(series.test_part(marked))


def test_last_rows(daily):
    last = series.last_rows(series.trend_features(daily)).collect()
    assert {(r["series"], r["date"]) for r in last} == {("x", "2025-02-12"), ("y", "2025-02-12")}


def test_standardised(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 9.0, 5.0)], "k string, v double, w double")
    train = df.filter("k <> 'c'")
    assert values(series.standardised(df, train, ["v", "w"]), "k", "w") == [("a", 0.0), ("b", 0.0), ("c", 0.0)]
    scaled = {r["k"]: r["v"] for r in series.standardised(df, train, ["v", "w"]).collect()}
    assert math.isclose(scaled["c"], 7 / math.sqrt(2)) and math.isclose(scaled["a"], -1 / math.sqrt(2))


def test_quality_equals_the_ml_evaluator(spark):
    df = spark.createDataFrame([(0.1, 0.2), (0.5, 0.4), (0.9, 0.95), (0.3, 0.1)], "label double, prediction double")
    got = series.forecast_quality(df, "label", "prediction").first()
    for name in ("rmse", "mae", "r2"):
        assert math.isclose(got[name], RegressionEvaluator(metricName=name).evaluate(df))
    constant = series.forecast_quality(df.withColumn("label", F.lit(0.5)), "label", "prediction").first()
    assert constant["r2"] is None and constant["rows"] == 4


def test_model_features_know_nothing_of_their_own_day(rows):
    got = {r["date"]: r for r in rows.filter("series = 'x'").collect()}
    day, before = got["2025-01-10"], got["2025-01-09"]
    assert day["post_count_lag_1"] == before["post_count"]
    assert day["sentiment_std_lag_1"] == (before["sentiment_std"] or 0.0)
    week = [got[f"2025-01-{d:02d}"]["avg_sentiment"] for d in range(3, 10)]
    assert math.isclose(day["sentiment_past_7"], statistics.mean(week)) and len(day["recent"]) == 7
    assert forecast.with_history(rows).count() == rows.count() - 4


def forecast_by_hand(spark, rows, model, name, horizon):
    """The same recursion with its state in Python, one prediction at a time."""
    last = rows.filter(F.col("series") == name).orderBy(F.desc("date")).first()
    lag1, lag2, recent = last["avg_sentiment"], last["sentiment_lag_1"], list(last["recent"])
    date, out = datetime.date.fromisoformat(last["date"]), []
    for _ in range(horizon):
        date += datetime.timedelta(days=1)
        features = {
            "sentiment_lag_1": lag1,
            "sentiment_lag_2": lag2,
            "sentiment_past_7": statistics.mean(recent),
            "post_count_lag_1": last["post_count"],
            "sentiment_std_lag_1": last["sentiment_std"] or 0.0,
            "day_of_week": date.isoweekday() % 7 + 1,
            "month": date.month,
            "year": date.year,
        }
        value = model.transform(spark.createDataFrame([features])).first()["prediction"]
        out.append((name, date.isoformat(), value))
        lag1, lag2, recent = value, lag1, [*recent, value][-7:]
    return out


def test_forecast_equals_recursion_by_hand(spark, rows, model):
    got = [tuple(r) for r in forecast.forecast(rows, model, 7).orderBy("series", "date").collect()]
    expected = forecast_by_hand(spark, rows, model, "x", 7) + forecast_by_hand(spark, rows, model, "y", 7)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert all(math.isclose(g[2], e[2], abs_tol=1e-9) for g, e in zip(got, expected))
    assert all(0 <= g[2] <= 1 for g in got)


def test_same_seed_same_forecast(rows, model):
    again = forecast.forecast(rows, forecast.fit_forest(rows, trees=5), 3)
    assert values(again) == values(forecast.forecast(rows, model, 3))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_layout_of_the_rows_does_not_matter(rows, model, partitions):
    again = forecast.fit_forest(rows.repartition(partitions, "date"), trees=5)
    for name in ("feature", "threshold", "value"):
        assert (getattr(again, name) == getattr(model, name)).all()


def test_forecast_in_tasks_equals_forecast(spark, rows, model):
    got = values(forecast.forecast_in_tasks(rows, model, 40))
    assert len(got) == 80 and got == values(forecast.forecast(rows, model, 40))
    short = spark.createDataFrame([("one", 0.4, START), ("two", 0.4, START), ("two", 0.6, START + DAY)], "k string, sentiment_score double, create_time long")
    starts = forecast.model_rows(series.daily_series(short, "k"))
    assert values(forecast.forecast_in_tasks(starts, model, 9)) == values(forecast.forecast(starts, model, 9))
    nothing = rows.filter("series = 'nobody'")
    assert forecast.forecast_in_tasks(nothing, model, 3).count() == 0
    assert plan_of(forecast.forecast_in_tasks(rows, model, 40)).count("Exchange hashpartitioning") == 1


def tree_by_hand(rows, names, thresholds, depth):
    """A tree of dictionaries, grown row by row: the first of the best splits."""
    mean = sum(w * y for _, y, w in rows) / sum(w for *_, w in rows)
    error = lambda part: sum(w * y for _, y, w in part) ** 2 / sum(w for *_, w in part)
    best = None
    for f in range(len(names)):
        for t in thresholds[f]:
            sides = [r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]
            if all(sides) and (best is None or error(sides[0]) + error(sides[1]) > best[0] + 1e-9):
                best = error(sides[0]) + error(sides[1]), f, t, sides
    if depth == 0 or best is None or best[0] <= error(rows) + 1e-9:
        return mean
    return best[1], best[2], *(tree_by_hand(side, names, thresholds, depth - 1) for side in best[3])


def test_tree_equals_one_grown_by_hand(spark):
    rng = random.Random(5)
    data = [(f"k{i}", float(rng.randrange(7)), rng.random(), rng.random() ** 2) for i in range(60)]
    train = spark.createDataFrame(data, "k string, a double, b double, label double").repartition(3)
    model = forest.grow_forest(train, ["a", "b"], ["k"], 1, 3, 1, bootstrap=False)
    ends = [(min(r[i] for r in data), max(r[i] for r in data)) for i in (1, 2)]
    low, high = ({n: e[k] for n, e in zip("ab", ends)} for k in (0, 1))
    thresholds = [t.tolist() for t in forest.grid_thresholds(train, low, high, ["a", "b"], 60)]
    by_hand = tree_by_hand([((a, b), y, 1) for _, a, b, y in data], ["a", "b"], thresholds, 3)

    def answer(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    tests = [(rng.uniform(-1, 8), rng.random()) for _ in range(300)]
    got = model.predict(np.array(tests))
    assert all(math.isclose(g, answer(by_hand, x), abs_tol=1e-6) for g, x in zip(got, tests))


def test_forest_finds_a_rule(spark):
    """Bagged trees with feature subsets on a rule with noise: well below the deviation of the labels."""
    rng = random.Random(6)
    data = [(f"k{i}", *(x := [rng.random() for _ in range(5)]), (x[0] > 0.5) * 0.6 + 0.3 * x[1] + 0.02 * rng.random()) for i in range(600)]
    names = list("abcde")
    df = spark.createDataFrame(data, "k string, " + ", ".join(f"{n} double" for n in names) + ", label double")
    model = forest.grow_forest(df.filter("pmod(crc32(k), 3) > 0"), names, ["k"], 30, 6, 3)
    quality = series.forecast_quality(model.transform(df.filter("pmod(crc32(k), 3) = 0")), "label", "prediction").first()
    assert quality["r2"] > 0.9


def test_poisson_weights():
    weights = forest.poisson_weights(np.arange(200_000), 3, 7)
    shares = np.bincount(weights)[:4] / len(weights)
    assert np.allclose(shares, [math.exp(-1) / math.factorial(k) for k in range(4)], atol=0.005)
    other = forest.poisson_weights(np.arange(200_000), 4, 7)
    assert abs(np.corrcoef(weights, other)[0, 1]) < 0.01


def test_forecast_dates(spark):
    few = spark.createDataFrame([("s", 0.2 + i / 100, 1748736000 - (9 - i) * DAY) for i in range(10)], "k string, sentiment_score double, create_time long")
    trend = forecast_trend(few, horizon=3)
    assert [r["date"] for r in trend.future.orderBy("date").collect()] == ["2025-06-02", "2025-06-03", "2025-06-04"]
    assert trend.evaluation.first()["rows"] == 2


def test_short_series_are_forecast_too(spark, rows, model):
    short = spark.createDataFrame([("one", 0.4, START), ("two", 0.4, START), ("two", 0.6, START + DAY)], "k string, sentiment_score double, create_time long")
    starts = forecast.model_rows(series.daily_series(short, "k"))
    future = forecast.forecast(starts, model, 2)
    assert future.groupBy("series").count().orderBy("series").collect() == [("one", 2), ("two", 2)]


def test_future_calendar(daily):
    got = series.future_calendar(daily, 3).filter("series = 'x'").orderBy("date").collect()
    assert [(r["date"], r["day_of_week"], r["month"], r["year"]) for r in got] == [
        ("2025-02-13", 5, 2, 2025), ("2025-02-14", 6, 2, 2025), ("2025-02-15", 7, 2, 2025),
    ]

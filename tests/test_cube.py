import math

import pytest
from pyspark.sql import functions as F

from moodtide.operators import cube, reports, series
from tests.conftest import plan_of, values

DAY = 86400


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (f"p{i % 3}", None if i % 11 == 0 else i % 6 * DAY + i, [None, "", "  ", "x", "y"][i % 5], None if i % 4 == 0 else i / 40, "extra")
        for i in range(40)
    ] + [("p9", 20 * DAY, "x", None, "e"), (None, 1, "z", 0.5, None)]
    df = spark.createDataFrame(rows, "platform string, create_time long, ip_location string, sentiment_score double, other string")
    kind = F.when(F.col("sentiment_score").isNull(), "unknown").when(F.col("sentiment_score") >= 0.6, "positive").otherwise("negative")
    return df.withColumn("sentiment_category", kind).repartition(3)


def same(got, expected):
    got, expected = values(got, *expected.columns), values(expected)
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected):
        assert all(math.isclose(x, y, rel_tol=1e-12) if isinstance(x, float) and isinstance(y, float) else x == y for x, y in zip(a, b))


def test_reports_equal_the_plain_groupings(scored):
    counts = cube.report_cube(scored, list(cube.KEYS), "platform", "UTC")
    same(cube.class_distribution(counts), reports.class_distribution(scored))
    same(cube.platform_class_counts(counts), reports.platform_class_counts(scored))
    same(cube.class_by_day(counts), reports.class_by_day(scored, "UTC"))
    same(cube.class_by_location(counts), reports.class_by_location(scored))
    same(cube.daily_series(counts), series.daily_series(scored, "platform", "UTC"))
    whole = cube.report_cube(scored, ["series", "class"], zone="UTC")
    same(cube.daily_series(whole), series.daily_series(scored, zone="UTC"))


@pytest.mark.parametrize("report", list(cube.KEYS))
def test_one_report_alone(scored, report):
    assert set(cube.report_cube(scored, [report]).select("report").collect()) == {(report,)}


def test_one_scan_and_one_exchange(spark, scored, tmp_path):
    scored.write.parquet(str(tmp_path / "scored"))
    plan = plan_of(cube.report_cube(spark.read.parquet(str(tmp_path / "scored")), list(cube.KEYS)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "other" not in plan.split("ReadSchema")[1]


def test_no_rows(scored):
    assert cube.report_cube(scored.filter("false")).count() == 0

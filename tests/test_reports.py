import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from moodtide.operators import polarity, reports
from tests.conftest import plan_of, values

KINDS = "id string, score double, platform string, ip_location string, create_time long"
ROWS = [
    ("a", 0.9, "p", "bj", 0),
    ("b", 0.1, "p", "bj", 10),
    ("c", 0.5, "q", "sh", 86400),
    ("d", None, "q", " ", 86400),
    ("e", 0.8, "q", None, 86401),
    ("f", 0.7, "p", "gz", 3 * 86400),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(ROWS, KINDS).withColumnRenamed("score", "sentiment_score")
    return polarity.classify(df)


def test_class_distribution(scored):
    rows = [tuple(r) for r in reports.class_distribution(scored).collect()]
    assert [(r[0], r[1]) for r in rows] == [("positive", 3), ("negative", 1), ("neutral", 1), ("unknown", 1)]
    assert dict((r[0], r[2]) for r in rows)["unknown"] is None
    assert abs(rows[0][2] - 0.8) < 1e-12


def total(df):
    return df.agg(F.sum("count")).first()[0]


def test_counts_add_up(scored):
    by_day, by_platform = reports.class_by_day(scored), reports.platform_class_counts(scored)
    assert total(reports.class_distribution(scored)) == total(by_day) == total(by_platform) == len(ROWS)
    assert total(reports.class_by_location(scored)) == 4
    assert [r["date"] for r in by_day.collect()][0] == "1970-01-01"
    assert "1970-01-03" not in {r["date"] for r in by_day.collect()}


def test_platform_counts_are_ascending(scored):
    got = [(r["platform"], r["count"]) for r in reports.platform_class_counts(scored).collect()]
    assert got == [("p", 1), ("p", 2), ("q", 1), ("q", 1), ("q", 1)]


def test_pivots(scored):
    by_platform = reports.class_pivot(reports.platform_class_counts(scored), "platform")
    assert by_platform.columns == ["platform", "positive", "negative", "neutral", "unknown"]
    assert values(by_platform) == [("p", 2, 1, 0, 0), ("q", 1, 0, 1, 1)]
    days = reports.day_class_pivot(reports.class_by_day(scored)).collect()
    assert [r["date"].isoformat() for r in days] == ["1970-01-01", "1970-01-02", "1970-01-04"]


def test_shares(spark, scored):
    row = reports.class_shares(reports.class_distribution(scored)).first().asDict()
    assert (row["total"], row["positive"], row["negative"], row["neutral"]) == (6, 3, 1, 1)
    assert row["positive_percent"] == 50.0
    nothing = spark.createDataFrame([], "sentiment_category string, count long, avg_score double")
    empty = reports.class_shares(nothing).first().asDict()
    assert empty["total"] == 0 and empty["positive"] == 0 and empty["negative_percent"] == 0.0


def test_locations(scored):
    by_location = reports.class_by_location(scored)
    assert [tuple(r) for r in reports.location_totals(by_location).collect()] == [("bj", 2), ("gz", 1), ("sh", 1)]
    assert values(reports.top_location_classes(by_location, 2), "ip_location", "sentiment_category") == [
        ("bj", "negative"), ("bj", "positive"), ("gz", "positive"),
    ]
    assert values(reports.top_location_classes(by_location, 1, "positive")) == [("bj", "positive", 1)]


def test_tags(spark):
    notes = spark.createDataFrame([(" a , B,,a ",), (None,), ("  ",), ("b",), (",",)], "tag_list string")
    assert [tuple(r) for r in reports.tag_frequency(notes).collect()] == [("a", 2), ("b", 2)]


NOTE = st.tuples(st.sampled_from(["n1", "n2", "n3", None]), st.sampled_from(["t", None]), st.sampled_from([None, 0, 5]))
COMMENT = st.tuples(st.sampled_from(["n1", "n2", "n9", None]), st.sampled_from(["c", None]))


@settings(max_examples=12, deadline=None)
@given(st.lists(NOTE, max_size=12), st.lists(COMMENT, max_size=20))
def test_note_stats_equal_join_then_group(spark, notes, comments):
    """Duplicate notes, NULL keys, NULL titles and orphan comments included."""
    n = spark.createDataFrame([(*row, 3) for row in notes], "note_id string, title string, liked_count long, comment_count long")
    c = spark.createDataFrame(comments, "note_id string, comment_id string")
    joined = n.join(c, "note_id", "left").groupBy("note_id", "title", "liked_count", "comment_count")
    expected = joined.agg(F.count("comment_id").alias("actual")).select(
        "note_id", "title", F.coalesce("liked_count", F.lit(0)), F.coalesce("comment_count", F.lit(0)), "actual"
    )
    assert values(reports.note_comment_stats(n, c)) == values(expected)


def test_orphans(spark):
    n = spark.createDataFrame([("1",), ("1",)], "note_id string")
    c = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), ("3", "d")], "note_id string, comment_id string")
    assert reports.orphan_comments(n, c).first().asDict() == {"orphan_comments": 3, "missing_notes": 2}
    assert reports.orphan_comments(n, c.filter("note_id = '1'")).first()["orphan_comments"] == 0


def test_top_lists_break_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "tag string, tag_count int")
    top = reports.top_rows(df, 2, "tag_count", "tag")
    assert [r["tag"] for r in top.collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan_of(top)
    assert "TakeOrderedAndProject" in plan_of(reports.sample_rows(df, 2, "tag"))


def test_row_counts_and_observation(spark, scored):
    counts = reports.row_counts(all=scored, none=scored.filter("false"))
    assert values(counts) == [("all", 6), ("none", 0)]
    watched, seen = reports.counting(scored, "seen")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 6


def test_small_helpers(scored):
    assert values(reports.distinct_values(scored, "platform", "id")) == [
        *(("id", row[0]) for row in ROWS), ("platform", "p"), ("platform", "q"),
    ]
    ordered = reports.ordered(scored.select("platform", "id"), platform="desc", id="asc")
    assert [r["id"] for r in ordered.collect()] == ["c", "d", "e", "a", "b", "f"]
    assert reports.renamed(scored, {"id": "key"}).columns[0] == "key"


def test_one_class_with_a_third_of_all_rows_is_combined_before_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("tag_list"))
    plan = plan_of(reports.tag_frequency(df))
    assert "partial_count" in plan
    assert reports.tag_frequency(df).first()["tag_count"] == 1000


def test_counted_tables_give_the_same_report(scored):
    counted = scored.groupBy("ip_location", "sentiment_category").agg(F.count("*").alias("n"))
    assert values(reports.class_by_location(counted, times="n")) == values(reports.class_by_location(scored))

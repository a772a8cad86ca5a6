"""Every registered query against its SQL twin on the smallest data, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_points
from tests.conftest import plan_of

QUERIES, ORACLE = entry_points.QUERIES, entry_points.ORACLE
# Spark type names and their DuckDB counterparts.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


DATED = [
    "class_by_day", "comments_per_day", "epoch_to_date", "daily_series", "parquet_roundtrip", "csv_roundtrip",
    "future_calendar", "union_class_by_day",
]


@pytest.mark.parametrize("name", DATED)
def test_session_zone_does_not_matter(spark, duck, folder, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_equals_sql(spark, duck, folder, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, folder, name):
    result = QUERIES[name](spark, folder)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLE[name])
    found = {d[0]: (i, str(d[1])) for i, d in enumerate(cursor.description)}
    assert sorted(found) == columns
    kinds = {field.name: KINDS[field.dataType.simpleString()] for field in result.schema}
    assert kinds == {column: found[column][1] for column in columns}
    expected = [tuple(row[found[column][0]] for column in columns) for row in cursor.fetchall()]
    got = [tuple(row) for row in result.select(*columns).collect()]
    assert len(got) > 0
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_counts_take_one_scan_per_table(spark, folder):
    plan = plan_of(QUERIES["record_counts"](spark, folder))
    assert plan.count("FileScan") == 3  # documents twice: as sound and as damaged notes


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["sentiment_category", "count", "avg_score"]


LAZY = [
    "class_by_day", "class_by_location", "note_comment_stats", "tag_frequency", "trend_features", "daily_series",
    "comments_per_day", "platform_class_pivot",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_nested_loops(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for slow in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert slow not in plan


def test_scans_read_only_what_is_used(spark, folder):
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan_of(QUERIES["comments_per_day"](spark, folder))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan_of(
        QUERIES["class_by_day"](spark, folder)
    )


def test_filters_reach_the_scan(spark, folder):
    assert "EqualTo(event_type,click)" in plan_of(QUERIES["filtered_records"](spark, folder))


def test_top_lists_do_not_sort_everything(spark, folder):
    for name in ("top_tags", "sample_records", "top_location_classes"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, folder))

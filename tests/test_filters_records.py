import itertools

import pytest
from pyspark.sql import functions as F

from moodtide.operators import filters, records
from moodtide.schemas import COMMENTS, NOTES
from tests.conftest import values


def test_posts_keep_blank_but_not_empty_text(spark):
    posts = spark.createDataFrame([("a", "x"), ("b", ""), ("c", None), ("d", "  ")], "id string, text string")
    assert values(filters.nonempty_posts(posts), "id") == [("a",), ("d",)]


def test_note_validity(spark):
    texts = [None, "", "  ", "x"]
    rows = [
        (note_id, title, desc, time)
        for note_id, title, desc, time in itertools.product(["n", None], texts, texts, [1, None])
    ]
    notes = spark.createDataFrame(rows, "note_id string, title string, desc string, time long")
    kept = {tuple(row) for row in filters.valid_notes(notes).collect()}
    assert kept == {r for r in rows if r[0] and r[3] and ("x" in (r[1], r[2]))}


def test_comment_validity(spark):
    rows = list(itertools.product(["n", None], ["c", None], [None, "", " ", "x"], [5, None]))
    comments = spark.createDataFrame(rows, "note_id string, comment_id string, content string, create_time long")
    assert values(filters.valid_comments(comments)) == [("n", "c", "x", 5)]


def test_fill_and_complete_cases(spark):
    df = spark.createDataFrame(
        [(None, None, None), (float("nan"), 2, "x"), (1.0, None, "y")], "a double, b int, c string"
    )
    assert values(filters.fill_numbers(df)) == [(0.0, 0, None), (0.0, 2, "x"), (1.0, 0, "y")]
    assert filters.complete_cases(df, "a", "b").count() == 0  # NaN counts as missing


def test_optional_filters_combine(spark):
    df = spark.createDataFrame([("p", "x"), ("p", "y"), ("n", "x")], "a string, b string")
    assert filters.filtered(df, a="p", b="x").count() == 1
    assert filters.filtered(df, a="p", b=None).count() == 2
    assert filters.filtered(df, a=filters.EVERYTHING, b=filters.EVERYTHING).count() == 3


def test_members_and_required_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, v int")
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    assert values(filters.members(df, keys, "k")) == [("a", 1), ("a", 3)]
    with pytest.raises(filters.MissingColumns, match="nope"):
        filters.require_columns(df, ["k", "nope"])


def test_text_union(spark):
    notes = spark.createDataFrame(
        [
            ("1", "t", None, 1999, "0", "0", "bj", None),
            ("2", None, "d", 2000, "0", "0", None, None),
            ("3", " ", "", 2000, "0", "0", None, None),
        ],
        NOTES,
    )
    comments = spark.createDataFrame([("1", "9", "hi", -1999, "sh")], COMMENTS)
    union = records.text_union(notes, comments)
    assert union.columns == records.COMMON_COLUMNS
    assert values(union) == [
        ("1", "hi", -1, "sh", "9", "comment"),
        ("1", "t", 1, "bj", "1", "note"),
        ("2", "d", 2, None, "2", "note"),
    ]


def test_same_id_in_both_types_stays_apart(spark):
    notes = spark.createDataFrame([("7", "t", "d", 0, "", "", "", "")], NOTES)
    comments = spark.createDataFrame([("7", "7", "c", 0, "")], COMMENTS)
    union = records.text_union(notes, comments)
    assert union.select("type", "id").distinct().count() == union.count() == 2
    assert union.filter(F.col("id") == "7").count() == 2

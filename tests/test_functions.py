import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from moodtide.functions import classes, dates, numbers, text
from tests.conftest import plan_of


def one(spark, rows, kind, build):
    df = spark.createDataFrame([(value,) for value in rows], f"x {kind}").withColumn("n", F.monotonically_increasing_id())
    return [row["y"] for row in df.select("n", build(F.col("x")).alias("y")).orderBy("n").collect()]


def test_repair_count(spark):
    rows = [None, "", "  ", "12", " 7 ", "1.5", "-3", "+4", "1.2w", "abc", "9" * 20]
    assert one(spark, rows, "string", numbers.repair_count) == [0, 0, 0, 12, 7, 1, -3, 4, None, None, None]


def test_epoch_seconds_cut_towards_zero(spark):
    assert one(spark, [1999, -1999, 0, None], "long", numbers.epoch_seconds) == [1, -1, 0, None]


def test_clamp(spark):
    assert one(spark, [None, float("nan"), -1.0, 2.0, 0.3], "double", numbers.clamp_score) == [None, 0, 0, 1, 0.3]


def test_class_limits(spark):
    rows = [None, 0.0, 0.4, 0.4000001, 0.5999999, 0.6, 1.0]
    expected = ["unknown", "negative", "negative", "neutral", "neutral", "positive", "positive"]
    assert one(spark, rows, "double", classes.opinion_class) == expected


def test_class_limits_are_parameters(spark):
    strict = lambda score: classes.opinion_class(score, positive_from=0.9, negative_to=0.1)
    assert one(spark, [0.95, 0.9, 0.5, 0.1], "double", strict) == ["positive", "positive", "neutral", "negative"]


def test_clean_text(spark):
    rows = [
        "héllo @用户_1x see https://a.b/c?d=1 中文　 x\u0085y z",
        None,
        "",
        " \t\n",
        "a http://x@y.z b",
        "@http://a b",
        "mail me@home.org now",
        "httpx://no https:// alone",
    ]
    assert one(spark, rows, "string", text.clean_text) == [
        "héllo see 中文 x y z",
        "",
        "",
        "",
        "a b",
        "@ b",
        "mail me.org now",
        "httpx://no https:// alone",
    ]


def cleaned_in_python(value):
    value = re.sub(r"https?://\S+", "", value)
    value = re.sub(r"@\w+", "", value)
    return re.sub(r"\s+", " ", value).strip()


ALPHABET = st.sampled_from(list("ab1_@:/. \t\n　 \u0085é中文٣²") + ["http://", "https://", "@"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=40))
def test_clean_text_equals_unicode_regex(spark, rows):
    assert one(spark, rows, "string", text.clean_text) == [cleaned_in_python(row) for row in rows]


def test_tokens(spark):
    got = one(spark, ["Good, GOOD 中文x 9a @me http://t.co/x end", "...", None], "string", text.tokens)
    assert [t for t in got[0] if t] == ["good", "good", "中", "文", "x", "9a", "end"]
    assert not any(got[1]) and got[2] is None


def test_join_text(spark):
    df = spark.createDataFrame([(None, "a"), ("a", ""), (None, None)], "t string, d string")
    assert [r[0] for r in df.select(text.join_text(F.col("t"), F.col("d"))).collect()] == ["a", "a ", ""]


def test_days(spark):
    assert one(spark, [0, 86399, 86400, None], "long", dates.day_string) == ["1970-01-01", "1970-01-01", "1970-01-02", None]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_day_in_a_named_zone_ignores_the_session(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        shanghai = lambda c: dates.day_string(c, "Asia/Shanghai")
        assert one(spark, [16 * 3600 - 1, 16 * 3600, None], "long", shanghai) == ["1970-01-01", "1970-01-02", None]
        new_york = lambda c: dates.day_string(c, "America/New_York")
        clocks_back = [1730606400 - 1, 1730606400, 1730696400 - 1, 1730696400]  # a day of 25 hours
        days = ["2024-11-02", "2024-11-03", "2024-11-03", "2024-11-04"]
        assert one(spark, clocks_back, "long", new_york) == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    df = spark.createDataFrame([("2025-06-01",), ("2025-06-02",)], "d string").withColumn("d", dates.parse_day(F.col("d")))
    rows = df.select("d", *[c.alias(n) for n, c in dates.calendar_parts(F.col("d")).items()]).orderBy("d").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 6, 2025), (2, 6, 2025)]


def test_han_pattern_covers_the_whole_script(spark):
    points = [i for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    blocks = ["".join(map(chr, points[i : i + 5000])) for i in range(0, len(points), 5000)]
    marked = one(spark, blocks, "string", lambda c: F.regexp_replace(c, text.HAN_PATTERN, " $1 "))
    by_script = one(spark, blocks, "string", lambda c: F.regexp_replace(c, r"(\p{IsHan})", " $1 "))
    assert marked == by_script and marked != blocks


def test_not_blank(spark):
    rows = [None, "", "  ", "\t", "　", " a "]
    assert one(spark, rows, "string", text.not_blank) == [False, False, False, True, True, True]


def test_guards_and_ranges_change_no_token(spark):
    """Against the plain patterns, on every kind of character, alone, between letters and beside links and mentions."""
    signs = [chr(c) for c in (*range(0x3100), *range(0x4E00, 0x4E20), *range(0xA000, 0xA100), 0x1F389, 0x20000, 0x2F800)]
    forms = ["{}", "aB{}cD", "x {} y", "http://a{}b @u{}v", "ht{}tp://a @", "HTTP://{} https://{} {}@q", "İ{}K"]
    rows = [(form.replace("{}", c),) for c in signs for form in forms]
    df = spark.createDataFrame([*rows, (None,), ("",)], "text string")
    stripped = F.regexp_replace(F.regexp_replace("text", text.URL_PATTERN, ""), text.MENTION_PATTERN, "")
    plain = F.split(F.lower(F.regexp_replace(stripped, text.HAN_PATTERN, " $1 ")), r"[^\p{L}\p{N}]+")
    wrong = ~(text.tokens(F.col("text")).eqNullSafe(plain) & text.strip_noise(F.col("text")).eqNullSafe(stripped))
    assert df.filter(wrong).count() == 0


def test_plain_texts_are_not_searched_for_links(spark):
    plan = plan_of(spark.range(1).select(text.tokens(F.col("id").cast("string"))))
    assert "CASE WHEN" in plan and "contains(" in plan.lower()

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moodtide.operators.polarity import fit_polarity_model
from moodtide.plans import notes as plan
from moodtide.plans.notes import analyse_notes, clean_tables
from moodtide.plans.posts import analyse_posts
from moodtide.schemas import COMMENTS, NOTES, POSTS, REPORTS
from moodtide.sources import files, jdbc, views, writers
from moodtide.operators import reports
from moodtide.sources.generations import current, manifest
from moodtide.storage import SHARED_FOLDER, shared_folder, store
from tests.conftest import plan_of, values

NOON = datetime.datetime(2025, 6, 1, 12, 0, 0)
POST_ROWS = [
    ("p1", NOON, "u1", 'quote " and, comma', "wb"),
    ("p2", NOON, None, "two\nlines", "zh"),
    ("p3", None, "u3", "", "zh"),
    ("p4", NOON, "", None, None),
    ("p5", NOON, "u5", "back\\slash", "dy"),
    ("p6", NOON, "  lead", "trail  ", "tab\t"),
    ("p7", NOON, "\\N", "\\\\N", " \\N"),
    (None, None, None, None, None),
]


def test_csv_round_trip(spark, tmp_path):
    posts = spark.createDataFrame(POST_ROWS, POSTS)
    writers.write_report(posts, str(tmp_path / "posts"))
    assert values(files.read_posts(spark, str(tmp_path / "posts"), multi_line=True)) == sorted(POST_ROWS, key=repr)


def test_csv_with_inferred_types(spark, tmp_path):
    writers.write_report(spark.createDataFrame([(1, 2.5, NOON)], "a int, b double, c timestamp"), str(tmp_path / "t"))
    read = files.read_csv(spark, str(tmp_path / "t"))
    assert [f.dataType.simpleString() for f in read.schema] == ["int", "double", "timestamp"]


def test_missing_reports(spark, tmp_path):
    assert files.read_reports(spark, str(tmp_path)) is None
    name = "top_tags_for_wordcloud"
    writers.write_report(spark.createDataFrame([("a", 2)], REPORTS[name]), str(tmp_path / name))
    tables, missing = files.read_reports(spark, str(tmp_path))
    assert values(tables[name]) == [("a", 2)] and set(missing) == set(REPORTS) - {name}
    other = tables["note_comment_stats"]
    assert other.schema == REPORTS["note_comment_stats"] and other.isEmpty()


def test_partitioned_table_and_rewrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, kind string")
    writers.write_table(df, path, "kind")
    writers.write_table(df, path, "kind")
    assert values(spark.read.parquet(path), "id", "kind") == [("a", "x"), ("b", "y")]
    assert "PartitionFilters: [isnotnull(kind" in plan_of(spark.read.parquet(path).filter("kind = 'x'"))


def test_sample_is_ordered_and_bounded(spark, tmp_path):
    df = spark.range(100).select(F.format_string("%03d", "id").alias("id"))
    writers.write_sample(df, str(tmp_path / "s"), 7, "id")
    assert values(files.read_csv(spark, str(tmp_path / "s"), df.schema)) == [(f"{i:03d}",) for i in range(7)]


def test_rows_to_table(spark):
    table = files.rows_to_table(spark, [("a", 1)], REPORTS["top_tags_for_wordcloud"])
    assert table.schema == REPORTS["top_tags_for_wordcloud"] and table.count() == 1


SETTINGS = {"host": "h", "database": "d", "user": "u", "password": "p"}


def test_connection():
    url, properties = jdbc.connection(SETTINGS)
    assert url == "jdbc:mysql://h:3306/d" and properties["user"] == "u" and properties["driver"] == jdbc.DEFAULT_DRIVER
    assert properties["useCursorFetch"] == "true"
    assert jdbc.connection({**SETTINGS, "port": "99"}, driver="x.Y") == (
        "jdbc:mysql://h:99/d", {"user": "u", "password": "p", "driver": "x.Y"},
    )


@pytest.mark.parametrize("name", jdbc.REQUIRED_SETTINGS)
@pytest.mark.parametrize("value", ["", None])
def test_connection_needs_all_settings(name, value):
    with pytest.raises(ValueError, match=name):
        jdbc.connection({**SETTINGS, name: value})


def test_settings_file(tmp_path):
    path = tmp_path / "db.ini"
    with pytest.raises(FileNotFoundError):
        jdbc.settings_from_ini(str(path))
    path.write_text("[mysql_db]\nhost = h\ndatabase=d\nuser =u\npassword =p%1\n")
    assert jdbc.connection(jdbc.settings_from_ini(str(path)))[1]["password"] == "p%1"
    with pytest.raises(KeyError, match="other"):
        jdbc.settings_from_ini(str(path), "other")


def test_read_options():
    options = jdbc.read_options("jdbc:x", "t", {"user": "u"}, jdbc.KeyRange("id", 0, 1000, 16))
    assert options["numPartitions"] == "16" and options["upperBound"] == "1000" and options["fetchsize"] == "10000"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t", {})


@pytest.mark.parametrize("predicates", [None, ["a = 1", "a <> 1 OR a IS NULL"]])
def test_missing_driver_is_named(spark, predicates):
    with pytest.raises(jdbc.DriverMissing, match="no.such.Driver"):
        jdbc.read_table(
            spark, "t", "jdbc:none://h/d", {"driver": "no.such.Driver"}, predicates=predicates, whole_table=True
        )


def test_a_whole_table_has_to_be_asked_for(spark):
    with pytest.raises(ValueError, match="whole_table"):
        jdbc.read_table(spark, "t", "jdbc:none://h/d", {"driver": "no.such.Driver"})


def test_hash_predicates():
    assert jdbc.hash_predicates("k", 2) == ["(MOD(CRC32(k), 2) = 0 OR k IS NULL)", "MOD(CRC32(k), 2) = 1"]
    with pytest.raises(ValueError):
        jdbc.hash_predicates("k", 0)


def test_hash_predicates_deal_every_row_once(spark):
    rows = spark.createDataFrame([(f"n{i}",) for i in range(50)] + [(None,), (None,)], "k string")
    parts = [rows.filter(p) for p in jdbc.hash_predicates("k", 4)]
    assert sum(part.count() for part in parts) == 52 and values(parts[0].filter("k IS NULL")) == [(None,), (None,)]


NOTE_ROWS = [
    ("n1", "good day", "good good", 1748736000000, "12", " 3 ", "bj", "Travel, food"),
    ("n2", "bad", None, 1748736000000 + 86400000, "", None, " ", "food"),
    ("n3", " ", "", 1748736000000, "1", "1", "sh", "lost"),
    (None, "x", "x", 1748736000000, "1", "1", "sh", "lost"),
    ("n4", "zzz", "", 1748736000000 + 2 * 86400000, "1.2w", "2", None, None),
]
COMMENT_ROWS = [
    ("c1", "n1", "good", 1748736000000 + 5000, "bj"),
    ("c2", "n1", "bad bad", 1748736000000 + 86400000, "gz"),
    ("c3", "n9", "good", 1748736000000 + 2 * 86400000, "gz"),
    ("c4", "n1", "  ", 1748736000000, "gz"),
    *[(f"d{i}", "n2", "good" if i % 2 else "bad", 1748736000000 + i * 86400000, "gz") for i in range(3, 12)],
]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(NOTE_ROWS, NOTES), spark.createDataFrame(COMMENT_ROWS, COMMENTS)


@pytest.fixture(scope="module")
def model(spark):
    rows = [("good good fine", 1), ("good day", 1), ("bad bad", 0), ("awful bad day", 0)]
    return store(fit_polarity_model(spark.createDataFrame(rows, "text string, label int")), "model")


def test_sql_text_over_names(spark, tables):
    notes, comments = clean_tables(*tables)
    views.register(notes, comments)
    by_sql = views.note_comment_stats_sql(spark)
    assert values(by_sql) == values(reports.note_comment_stats(notes, comments))
    assert values(spark.sql("SELECT count(*) AS n FROM comments WHERE `note_id` = 'n1'")) == [(2,)]
    assert spark.sql("SELECT max(`desc`) AS d FROM notes").first()["d"] == "good good"


def test_notes_flow(spark, tables, model, tmp_path):
    folder = str(tmp_path)
    assert analyse_notes(*tables, model, folder, horizon=3)
    read, missing = files.read_reports(spark, folder)
    assert set(missing) == {"sentiment_distribution", "platform_sentiment", "sentiment_sample"}
    stats = {r["note_id"]: r for r in read["note_comment_stats"].collect()}
    assert {k: v["actual_comment_count"] for k, v in stats.items()} == {"n1": 2, "n2": 9, "n4": 0}
    assert (stats["n1"]["liked_count"], stats["n1"]["note_declared_comment_count"]) == (12, 3)
    assert stats["n4"]["liked_count"] == 0
    total = lambda name: read[name].agg(F.sum("count")).first()[0]
    assert total("combined_sentiment_distribution") == total("combined_sentiment_over_time") == 15
    assert read["combined_sentiment_sample_details"].count() == 15
    assert total("combined_sentiment_by_location_sample") == 13
    assert read["comment_daily_distribution"].agg(F.sum("num_comments")).first()[0] == 12
    assert values(read["top_tags_for_wordcloud"]) == values(read["tag_frequency"]) == [("food", 2), ("travel", 1)]
    assert total("combined_sentiment_by_location") == 13
    assert read["sentiment_trend_predictions"].count() == 3
    assert read["sentiment_trend_evaluation"].count() == 1


def test_a_flow_that_fails_leaves_the_old_set_whole(spark, tables, model, tmp_path, monkeypatch):
    folder, notes, comments = str(tmp_path), *tables
    assert files.read_reports(spark, folder) is None
    assert analyse_notes(notes, comments, model, folder, horizon=3)
    before = {name: values(df) for name, df in files.read_reports(spark, folder)[0].items()}
    fewer = comments.filter("note_id = 'n1'")

    def failing(df, path, **settings):
        if path.endswith("by_location"):
            raise RuntimeError("lost")
        writers.write_report(df, path, **settings)

    with monkeypatch.context() as patched:
        patched.setattr(plan, "write_report", failing)
        with pytest.raises(RuntimeError, match="lost"):
            analyse_notes(notes, fewer, model, folder, horizon=3)
    assert {name: values(df) for name, df in files.read_reports(spark, folder)[0].items()} == before
    assert analyse_notes(notes, fewer, model, folder, horizon=3)
    after = files.read_reports(spark, folder)[0]
    assert after["comment_daily_distribution"].agg(F.sum("num_comments")).first()[0] == 2
    assert manifest(spark, folder).count() == 2


def test_notes_flow_without_rows(spark, model, tmp_path):
    empty = spark.createDataFrame([], NOTES), spark.createDataFrame([], COMMENTS)
    assert analyse_notes(*empty, model, str(tmp_path)) is False


def test_posts_flow_without_rows(spark, model, tmp_path):
    assert analyse_posts(spark.createDataFrame([], POSTS), model, str(tmp_path)) == {"posts": 0}
    assert spark.read.parquet(f"{current(spark, str(tmp_path))}/sentiment_results").count() == 0


def test_notes_flow_with_too_few_days_to_train(spark, model, tmp_path):
    notes = spark.createDataFrame(NOTE_ROWS[:1], NOTES)
    comments = spark.createDataFrame(COMMENT_ROWS[:2], COMMENTS)
    assert analyse_notes(notes, comments, model, str(tmp_path))
    read, _ = files.read_reports(spark, str(tmp_path))
    assert read["combined_sentiment_distribution"].agg(F.sum("count")).first()[0] == 3
    assert read["sentiment_trend_predictions"].isEmpty() and read["sentiment_trend_evaluation"].isEmpty()


def test_posts_flow(spark, model, tmp_path):
    rows = [(f"p{i}", NOON, "u", ["good", "bad", "zzz", "", None][i % 5], f"s{i % 2}") for i in range(50)]
    assert analyse_posts(spark.createDataFrame(rows, POSTS), model, str(tmp_path)) == {"posts": 30}
    (read, missing) = files.read_reports(spark, str(tmp_path), ["sentiment_distribution", "platform_sentiment", "sentiment_sample"])
    assert not missing
    assert values(read["sentiment_distribution"], "sentiment_category", "count") == [
        ("negative", 10), ("positive", 10), ("unknown", 10),
    ]
    assert read["platform_sentiment"].agg(F.sum("count")).first()[0] == 30
    assert read["sentiment_sample"].count() == 30
    full = spark.read.parquet(f"{current(spark, str(tmp_path))}/sentiment_results")
    assert full.columns == [*POSTS.names, "sentiment_score", "sentiment_category"] and full.count() == 30


def test_details_with_repeated_ids_keep_their_own_scores(spark, model, tmp_path):
    notes = spark.createDataFrame([("n1", "good", "", 1748736000000 + i, "1", "1", "bj", "") for i in range(3)], NOTES)
    rows = [("c1", "n1", text, 1748736000000, "bj") for text in ("good", "bad", "bad bad", "zzz", " \\N good ")]
    assert analyse_notes(notes, spark.createDataFrame(rows, COMMENTS), model, str(tmp_path))
    read, _ = files.read_reports(spark, str(tmp_path))
    details = read["combined_sentiment_sample_details"].collect()
    assert len(details) == 8
    kinds = {(r["text"], r["sentiment_category"]) for r in details}
    assert kinds == {
        ("good", "positive"), ("good ", "positive"), ("bad", "negative"), ("bad bad", "negative"), ("zzz", "unknown"),
        (" \\N good ", "positive"),
    }


def test_reports_are_cut_into_files(spark, tmp_path):
    path = tmp_path / "cut"
    writers.write_report(spark.range(0, 25, 1, 1).select(F.col("id").cast("string").alias("id")), str(path), file_rows=10)
    assert len(list(path.glob("*.csv"))) == 3 and files.read_csv(spark, str(path), _one_string()).count() == 25


def test_a_column_of_nulls_comes_back(spark, tmp_path):
    rows = spark.createDataFrame([(None,), ("",), ("\\N",), ("a",)], _one_string())
    writers.write_report(rows, str(tmp_path / "n"))
    assert values(files.read_csv(spark, str(tmp_path / "n"), _one_string(), multi_line=True)) == values(rows)


def _one_string():
    return StructType([StructField("id", StringType())])


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get(SHARED_FOLDER)


class OtherSession:
    """Just enough of a session: a configuration without the setting, and a master."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_shared_folder_without_the_setting():
    local = shared_folder(OtherSession("local[2]"))
    assert local == shared_folder(OtherSession("local[2]"))
    with pytest.raises(ValueError, match=SHARED_FOLDER):
        shared_folder(OtherSession("spark://host:7077"))

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import Observation, functions as F

from moodtide.operators import polarity
from moodtide.storage import small_batches, store, store_texts
from tests.conftest import plan_of, values

RANDOM = random.Random(7)
WORDS = ["good", "bad", "fine", "awful", "the", "of", "so", "rare", "中", "文"]


def make_texts(n):
    rows = []
    for i in range(n):
        label = RANDOM.choice([0, 1])
        words = RANDOM.choices(WORDS, weights=[3 + 4 * label, 7 - 4 * label, 2, 2, 30, 9, 4, 0.2, 1, 1], k=RANDOM.randint(0, 30))
        rows.append((i, " ".join(words).title() + f" once{i}", label))
    return rows


TEXTS = make_texts(120)


def tokens_of(text):
    return re.findall(r"[一-龥]|[^\W_一-龥]+", text.lower())


def brute_model(rows):
    counts = [Counter(), Counter()]
    for _, text, label in rows:
        counts[label].update(tokens_of(text))
    vocabulary = set(counts[0]) | set(counts[1])
    n0, n1, v = sum(counts[0].values()), sum(counts[1].values()), len(vocabulary)
    return {t: math.log((counts[1][t] + 1) / (n1 + v)) - math.log((counts[0][t] + 1) / (n0 + v)) for t in vocabulary}


def brute_score(text, model):
    known = [model[t] for t in tokens_of(text or "") if t in model]
    return 1 / (1 + math.exp(-sum(known) / len(known))) if known else None


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id long, text string, label int")


@pytest.fixture(scope="module")
def model(texts):
    return store(polarity.fit_polarity_model(texts), "model")


def test_model_equals_brute_force(model):
    expected = brute_model(TEXTS)
    got = {row["token"]: row["weight"] for row in model.collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[t], expected[t], abs_tol=1e-12) for t in got)


def test_rare_tokens_are_left_out_on_request(texts, model):
    kept = polarity.fit_polarity_model(texts, min_occurrences=2)
    assert values(kept, "token") == values(model.filter("occurrences >= 2"), "token")


def test_labels_other_than_zero_and_one_are_ignored(spark, texts, model):
    extra = spark.createDataFrame([(900, "good good bad", None), (901, "bad", 5)], "id long, text string, label int")
    refitted = polarity.fit_polarity_model(texts.union(extra))
    assert values(refitted, "token", "occurrences") == values(model, "token", "occurrences")


def test_scores_equal_brute_force(texts, model):
    weights = brute_model(TEXTS)
    got = {r["id"]: r["sentiment_score"] for r in polarity.score_records(texts, model, key=["id"]).collect()}
    assert len(got) == len(TEXTS)
    for i, text, _ in TEXTS:
        expected = brute_score(text, weights)
        assert (got[i] is None) == (expected is None)
        assert expected is None or math.isclose(got[i], expected, abs_tol=1e-12)


@pytest.mark.parametrize("head_rows, salts", [(1, 1), (3, 4), (100, 16)])
def test_split_model_gives_the_same_scores(texts, model, head_rows, salts):
    whole = polarity.score_records(texts, model, key=["id"])
    split = polarity.score_records(texts, model, key=["id"], broadcast_limit=0, head_rows=head_rows, salts=salts)
    rounded = [F.col("id"), F.round("sentiment_score", 12), F.col("sentiment_category")]
    assert values(split.select(rounded)) == values(whole.select(rounded))


@pytest.mark.parametrize("chunk_tokens", [1, 7, 100])
def test_chunks_of_any_size_give_the_same_scores(texts, model, chunk_tokens):
    whole = polarity.score_text(texts, model, key=["id"])
    split = polarity._score_by_joins(texts, model, ["id"], "text", 2, None, chunk_tokens)
    rounded = [F.col("id"), F.round("sentiment_score", 12), F.col("sentiment_category")]
    assert values(split.select(rounded)) == values(whole.select(rounded))


def test_a_chunk_asks_once_for_a_token(spark, model):
    """The rows of the join with the model grow with the distinct tokens of a chunk, not with its texts."""
    df = spark.range(600).selectExpr("id", "'good bad rare rare once' || id % 5 AS text").repartition(3)
    tokens = df.select("id", polarity._token_hashes("text").alias("_tokens"))
    stored = polarity._asked_in_chunks(tokens, ["id"], model.limit(0), 10**6)
    asked = stored.filter("_asked IS NOT NULL").selectExpr("_chunk", "explode(_asked) AS token")
    assert asked.count() == asked.distinct().count() <= 3 * 8


def test_unknown_texts(spark, model):
    rows = [("a", None), ("b", ""), ("c", "zzz qqq"), ("d", "!!!"), ("e", "@good http://good"), ("f", "good")]
    df = spark.createDataFrame(rows, "id string, text string")
    for limit in (polarity.BROADCAST_BYTES, 0):
        scored = polarity.score_records(df, model, key=["id"], broadcast_limit=limit)
        classes = {r["id"]: r["sentiment_category"] for r in scored.collect()}
        assert [classes[k] for k in "abcde"] == ["unknown"] * 5 and classes["f"] != "unknown"


def test_score_text_keeps_every_row(spark, model):
    rows = [("a", "good"), ("a", "good"), ("a", "bad bad"), (None, "good"), (None, None), ("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    scored = polarity.score_text(df, model, key=["id"])
    assert scored.columns == ["id", "text", "sentiment_score", "sentiment_category"]
    assert values(scored, "id", "text") == sorted(rows, key=repr)
    by_text = {r["text"]: r["sentiment_score"] for r in scored.collect()}
    assert by_text["good"] == brute_score("good", brute_model(TEXTS)) and by_text[None] is None


@pytest.mark.parametrize("limit", [polarity.BROADCAST_BYTES, 0])
def test_score_records_keeps_every_row(spark, model, limit):
    """A third of all rows are equal in everything; others share a key, or have none, or no text."""
    rows = [("hot", "good rare", 1)] * 200 + [("hot", "bad", 1), ("hot", "good", 2), (None, "good", 1), (None, None, 1)]
    rows += [(f"k{i % 50}", f"good bad once{i}", i % 3) for i in range(380)] + [("e", "", 0), ("e", "", 0), ("n", None, 0)]
    df = spark.createDataFrame(rows, "id string, text string, kept int").repartition(7)
    scored = polarity.score_records(df, model, key=["id"], keep=["kept"], broadcast_limit=limit, head_rows=3)
    assert values(scored, "id", "kept") == sorted(((r[0], r[2]) for r in rows), key=repr)
    weights = brute_model(TEXTS)
    expected = sorted((r[0], r[2], round(brute_score(r[1], weights) or -1, 9)) for r in rows if r[0])
    got = scored.filter("id IS NOT NULL").fillna(-1.0, ["sentiment_score"]).collect()
    assert sorted((r["id"], r["kept"], round(r["sentiment_score"], 9)) for r in got) == expected


def test_kept_columns_travel_with_the_key(texts, model):
    scored = polarity.score_records(texts, model, key=["id"], keep=["label"])
    assert values(scored, "id", "label") == values(texts, "id", "label")


def test_model_size_decides_the_join(texts, model):
    assert polarity.fits_broadcast(model) and not polarity.fits_broadcast(model, 0)
    whole = plan_of(polarity.score_records(texts, model, key=["id"]))
    assert "ArrowEvalPython" in whole and "Exchange" not in whole and "Join" not in whole
    split = plan_of(polarity.score_records(texts, model, key=["id"], broadcast_limit=0))
    assert "SortMergeJoin" in split and "EvalPython" not in split


def test_scoring_shuffles_neither_texts_nor_records(texts, model):
    scored = plan_of(polarity.score_text(texts, model, key=["id"]))
    assert "Exchange" not in scored and "Sort" not in scored and "BatchEvalPython" not in scored
    assert scored.count("Scan") == plan_of(texts).count("Scan")


def test_model_without_tokens(spark):
    none = spark.createDataFrame([], "token string, weight double, occurrences long")
    df = spark.createDataFrame([("a", "good"), ("b", None)], "id string, text string")
    assert {r["sentiment_category"] for r in polarity.score_text(df, none, key=["id"]).collect()} == {"unknown"}


def test_token_in_a_third_of_all_rows_in_the_rare_part(spark, model):
    """A token outside the broadcast head may be common in the scored texts."""
    rows = [(i, "rare rare good" if i % 3 == 0 else f"once{i % 120} bad") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, text string")
    whole = polarity.score_records(df, model, key=["id"])
    split = polarity.score_records(df, model, key=["id"], broadcast_limit=0, head_rows=1, salts=8)
    pick = [F.col("id"), F.round("sentiment_score", 12)]
    assert values(split.select(pick)) == values(whole.select(pick))


def test_plugged_in_scorer(spark):
    def load():
        def scorer(text):
            if "boom" in text:
                raise ValueError(text)
            return {"int": 1, "nan": float("nan"), "big": 7.0, "low": -1.0}.get(text, 0.5)

        return scorer

    rows = [("今天的天气不错",), ("",), (None,), ("@only_a_name",), ("boom",), ("int",), ("nan",), ("big",), ("low",)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, text string")
    failures = Observation("failures")
    scored = polarity.score_with(df, polarity.per_text(load), failures=failures)
    got = [tuple(r[1:]) for r in sorted(scored.select("id", "sentiment_score", "sentiment_category").collect())]
    unknown = (None, "unknown")
    assert got == [
        (0.5, "neutral"), unknown, unknown, unknown, unknown, unknown,
        (0.0, "negative"), (1.0, "positive"), (0.0, "negative"),
    ]
    assert failures.get["failed"] == 2


def test_plugged_in_batch_scorer(spark):
    df = spark.createDataFrame([(0, "abc"), (1, None), (2, "b")], "id int, text string")
    scored = polarity.score_with(df, lambda: lambda texts: texts.str.len() / 4.0)
    assert values(scored, "id", "sentiment_score") == [(0, 0.75), (1, None), (2, 0.25)]


def test_a_batch_scorer_gets_bounded_series(spark):
    df = spark.range(60).selectExpr("id", "repeat('ab ', 100000) AS text").coalesce(1)

    def load():
        return lambda texts: texts.map(lambda _: float(texts.str.len().sum() <= 4_000_000))

    scored = polarity.score_with(df, load)
    assert {r["sentiment_score"] for r in scored.collect()} == {1.0}


def test_flows_score_in_small_arrow_batches(spark):
    """A write inside is planned with the short batches; the session's own setting is back afterwards, after errors too."""
    sizes = F.arrow_udf(lambda t: polarity.pa.array([len(t)] * len(t), polarity.pa.int64()), "long")
    df = spark.range(5000).coalesce(1).select(sizes(F.col("id").cast("string")).alias("n"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert store_texts(df, "sizes").agg(F.max("n")).first()[0] <= 1000
    with pytest.raises(ValueError), small_batches(spark):
        raise ValueError
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_runs_of_rows():
    runs = lambda *sizes: list(polarity.runs_of_rows(polarity.np.array(sizes, int), 10))
    assert runs() == [] and runs(0, 0) == [(0, 2)] and runs(30) == [(0, 1)]
    assert runs(4, 6, 1, 30, 0, 9, 2) == [(0, 2), (2, 3), (3, 4), (4, 6), (6, 7)]


@pytest.mark.parametrize("limit", [0, 1, 3, 10, 10**6])
def test_frequent_tokens_are_bounded_and_the_largest(model, limit):
    counts = {r["token"]: r["occurrences"] for r in model.collect()}
    head = {r["token"] for r in polarity.frequent_tokens(model, limit).collect()}
    assert len(head) <= limit
    assert not head or min(counts[t] for t in head) > max((counts[t] for t in counts.keys() - head), default=0)
    assert limit < 10**6 or head == counts.keys()

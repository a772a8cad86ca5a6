from pyspark.sql import functions as F

from moodtide.llm import lines
from tests.llm.conftest import prose


def test_log_lines_share_a_template(spark):
    rows = [(i, f"{prose(12, i)}\nuser {i} signed in from host{i}\n{prose(9, 50 + i)}") for i in range(6)]
    rows += [(10, "user 5 signed out by hand"), (11, "\n\n"), (12, None)]
    kept = {r["doc_id"]: r for r in lines.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept[0]["text"] == rows[0][1] and kept[0]["n_dropped"] == 0
    for i in range(1, 6):
        assert kept[i]["text"].split("\n") == [prose(12, i), prose(9, 50 + i)] and kept[i]["n_dropped"] == 1
    assert kept[10]["n_dropped"] == 0 and kept[11]["text"] == "\n\n" and kept[11]["n_lines"] == 3
    assert kept[12]["text"] is None and kept[12]["n_lines"] == 0


def test_places_that_vary_become_variables(spark):
    """Without any digit: the name differs, the rest is constant; two documents are not enough."""
    rows = [(i, f"the daily job {name} has ended well") for i, name in enumerate(["alpha", "beta", "gamma", "delta"])]
    rows += [(20 + i, f"quite other words {name} here") for i, name in enumerate(["alpha", "beta"])]
    rows += [(30, "the daily job of a b c"), (31, "the daily job is x y z"), (32, "the daily job at p q r")]
    kept = {r["doc_id"]: r["n_dropped"] for r in lines.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {0: 0, 1: 1, 2: 1, 3: 1, 20: 0, 21: 0, 30: 0, 31: 0, 32: 0}


def test_messy_documents(spark, messy, no_documents):
    out = lines.without_recurring_lines(messy)
    assert sorted(out.columns) == sorted({*messy.columns, "n_lines", "n_dropped"}) and out.count() == messy.count()
    dropped = {(r["doc_id"], r["n_dropped"]) for r in out.filter("n_dropped > 0").select("doc_id", "n_dropped").collect()}
    # The log lines recur in three documents; their first one stays, in document 10.
    assert {(10, 8), (11, 1), (12, 1)} <= dropped
    assert lines.without_recurring_lines(no_documents).isEmpty()


def test_hot_line(spark):
    rows = [(i, "all rights of this work are reserved\n" + prose(8, i)) for i in range(500)]
    out = lines.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["doc_id"], r["n_dropped"]) for r in out.collect()} == {(i, int(i > 0)) for i in range(500)}


def test_support_counts_documents_not_lines(spark):
    """A name that one document repeats in three lines is no constant."""
    ends = ["cron", "root", "sshd"]
    rows = [(i, "\n".join(f"session for user {name} opened by {end}" for end in ends)) for i, name in enumerate(["ann", "bob", "eve"])]
    out = lines.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_dropped"] for r in out.collect()} == {0: 0, 1: 3, 2: 3}


def test_support_of_documents_with_one_bit(spark, monkeypatch):
    """Where the bits of documents fall together the documents are counted."""
    monkeypatch.setattr(lines, "document", lambda: F.col("doc_id") * 63)
    rows = [(i, f"the daily job {name} has ended well") for i, name in enumerate(["alpha", "beta", "gamma"])]
    out = lines.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_dropped"] for r in out.collect()} == {0: 0, 1: 1, 2: 1}

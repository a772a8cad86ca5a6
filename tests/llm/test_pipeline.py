import pytest

import corpus_pipeline
from moodtide.storage import store

ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def folder_of(spark, tmp_path_factory):
    """A folder with a benchmark table, as the stages read it."""

    def make(rows):
        path = tmp_path_factory.mktemp("tables")
        spark.createDataFrame(rows, ITEMS).write.parquet(f"{path}/benchmark.parquet")
        return str(path)

    return make


def run_stages(spark, docs, folder):
    sizes = [docs.count()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, folder), name)
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    return docs, sizes


def test_messy_documents(spark, messy, folder_of):
    out, sizes = run_stages(spark, messy, folder_of([(1, messy.filter("doc_id = 4").first()["text"]), (2, None)]))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ids = {r["doc_id"] for r in out.collect()}
    assert 4 not in ids and 1 not in ids and sizes[2] < sizes[1] and sizes[3] == sizes[2] - 1


def test_no_documents(spark, no_documents, folder_of):
    out, sizes = run_stages(spark, no_documents, folder_of([]))
    assert sizes == [0] * 6


def test_whole_pipeline(spark, folder):
    out = store(corpus_pipeline.run(spark, folder), "tokens")
    rows = sorted(out.collect(), key=lambda r: r["start"])
    assert rows and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)

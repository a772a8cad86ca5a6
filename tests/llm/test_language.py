import numpy as np
import pyarrow as pa

from moodtide.llm import language
from pyspark.sql import functions as F
from tests.llm.conftest import prose

PAGES = [
    (1, "http://www.host.example.fr/en/1", "<html lang='de-DE'><script>var en</script><p>le chat &amp; la souris</p></html>"),
    (2, "https://u:p@HOST.Example.org:80/fr", '<!doctype html><HTML class=x lang="FR"><!-- the --><b>abc</b>'), (3, None, None), (4, "not a url", "plain"),
    (5, "http://a.b/fra/x", "<html><body>x</body></html>"),
]


def test_page_evidence(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r["page_id"]: (r["declared"], r["suffix"], r["host"], r["text"].split()) for r in language.page_records(pages).collect()}
    assert got[1] == ("de", "fr/en", "www.host.example.fr", ["le", "chat", "la", "souris"])
    assert got[2] == ("fr", "org/fr", "host.example.org", ["abc"])
    assert got[3] == (None, None, None, []) and got[4] == (None, None, None, ["plain"])
    assert got[5] == (None, "b/", "a.b", ["x"])


def test_trigrams_stay_inside_their_text():
    texts = ["ab", "", "abc", "Abc 12 dÉf", None, "x"]
    alone = [language.trigram_buckets(pa.array([t or ""]))[0] for t in texts]
    together, bounds = language.trigram_buckets(pa.array([t or "" for t in texts]))
    for i, own in enumerate(alone):
        assert together[bounds[i] : bounds[i + 1]].tolist() == own.tolist()
    assert (alone[0] == 2**language.BUCKET_BITS).all() and (alone[2] != 2**language.BUCKET_BITS).sum() == 1


def test_documents_are_told_apart_by_text(spark, folder):
    """Half of the rows train; the other half hide their declared language and are still found."""
    docs = language.document_records(spark.read.parquet(f"{folder}/documents.parquet"))
    half = F.pmod("doc_id", F.lit(2)) == 0
    model = language.fit_text_model(docs.filter(half).select("declared", "text"))
    hidden = docs.filter(~half & (F.length("text") > 60)).withColumn("truth", F.col("declared"))
    found = language.identify(hidden.withColumn("declared", F.lit(None).cast("string")), model)
    rows = found.collect()
    assert len(rows) > 50 and np.mean([r["language"] == r["truth"] for r in rows]) > 0.95
    assert np.mean([r["text_language"] == r["truth"] for r in rows]) > 0.95


def toy_model(languages=("aa", "bb")):
    table = np.zeros((2**language.BUCKET_BITS + 1, 3), np.float32)
    table[:-1] = np.log(2.0**-language.BUCKET_BITS)
    for column, word in enumerate(("xyz", "uvw")):
        table[language.trigram_buckets(pa.array([word]))[0][0], column] = np.log(0.5)
    return table


def test_fusion_equals_the_formula(spark):
    rows = [
        (1, "xyz", "aa", "com/", "h.example.com"), (2, "uvw", "bb", "com/", "h.example.com"), (3, "xyz", "bb", "com/", "k.example.com"),
        (4, "", "bb", "com/", "h.example.com"), (5, None, None, None, None), (6, "uvw", None, "org/", "z.org"), (7, "xyz uvw", "aa", None, "h.example.com"),
    ]
    df = spark.createDataFrame(rows, "id int, text string, declared string, suffix string, host string")
    got = {r["id"]: r for r in language.identify(df.withColumn("text", F.coalesce("text", F.lit(""))), toy_model(), ("aa", "bb")).collect()}
    low = np.log(2.0**-language.BUCKET_BITS)
    high = np.log(0.5)
    heard = {"xyz": [high, low, low], "uvw": [low, high, low], "xyz uvw": [high + low + 4 * low, high + low + 4 * low, 6 * low], "": [0, 0, 0], None: [0, 0, 0]}
    # " u"-like trigrams across the blank are ordinary ones: every class gives them the same.
    t = {r[0]: np.array(heard[r[1]]) / language.OVERLAP for r in rows}
    p = {i: np.exp(v - v.max()) / np.exp(v - v.max()).sum() for i, v in t.items()}

    def soft(at, value):
        return sum((p[r[0]] for r in rows if r[at] == value), np.zeros(3))

    def value_logs(at, value):
        if value is None:
            return np.zeros(3)
        values = {r[at] for r in rows if r[at] is not None}
        every = sum(soft(at, v) for v in values)
        return np.log((soft(at, value) + language.SMOOTH) / (every + language.SMOOTH * len(values)))

    def prior(row):
        host, k = row[4], language.HOST_WEIGHT
        if host is None:
            return np.zeros(3)
        every = sum(soft(4, r) for r in {r[4] for r in rows if r[4]})
        share = (every + 1) / (every.sum() + 3)
        for depth in (1, 2):
            end = ".".join(host.split(".")[-depth:])
            counts = sum((soft(4, h) for h in {r[4] for r in rows if r[4]} if ".".join(h.split(".")[-depth:]) == end), np.zeros(3))
            share = (counts + k * share) / (counts.sum() + k)
        own = soft(4, host) - p[row[0]]
        return np.log((own + k * share) / (own.sum() + k))

    for row in rows:
        logs = t[row[0]] + value_logs(2, row[2]) + value_logs(3, row[3]) + prior(row)
        share = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        assert abs(got[row[0]]["posterior"] - share.max()) < 1e-6, row
        if row[0] in (1, 2, 3, 6):
            assert got[row[0]]["language"] == ("aa", "bb", "und")[share.argmax()]


def test_messy_documents(spark, messy, no_documents):
    kept = language.accepted_documents(messy)
    assert kept.columns == messy.columns
    prose = {0, 1, 2, 3, 4, 9, 13, 14}
    assert prose <= {r["doc_id"] for r in kept.collect()}
    assert language.accepted_documents(no_documents).isEmpty()


def test_unknown_scripts_are_rejected(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(-1, "字" * 300, None, "odd1"), (-2, "жзийклмнопрст " * 30, None, "odd2")], docs.schema)
    kept = {r["doc_id"] for r in language.accepted_documents(docs.union(odd)).select("doc_id").collect()}
    assert not {-1, -2} & kept and len(kept) == docs.count()


def test_copies_of_a_text_train_once(spark):
    texts = [("en" if i % 2 else "de", prose(30, i)) for i in range(40)]
    once = spark.createDataFrame(texts, "declared string, text string")
    copied = spark.createDataFrame(texts + texts[:1] * 400, "declared string, text string")
    assert np.array_equal(language.fit_text_model(once), language.fit_text_model(copied))
    lowest = once.orderBy(F.xxhash64("declared", "text")).limit(5)
    assert np.array_equal(language.fit_text_model(copied, rows=5), language.fit_text_model(lowest))

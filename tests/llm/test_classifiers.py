import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.llm import quality, queries, toxicity
from moodtide.storage import store
from tests.llm.conftest import prose


def test_statistics_of_a_text():
    text = "Ab ab ab. 12!!!\n\nAb ab ab. 12!!!\nx|y"
    got = dict(zip(quality.NAMES, quality.statistics(pa.array([text]))[0], strict=True))
    words = text.split()
    assert got["log_words"] == pytest.approx(np.log1p(len(words))) and got["word_length"] == pytest.approx(np.mean([len(w) for w in words]))
    assert got["distinct_words"] == pytest.approx(len(set(words)) / len(words)) and got["log_lines"] == pytest.approx(np.log1p(3))
    assert got["distinct_lines"] == pytest.approx(2 / 3) and got["digits"] == pytest.approx(4 / len(text))
    assert got["triples"] == pytest.approx(2 / len(text)) and got["bars"] == pytest.approx(1 / len(text))
    pairs = list(zip(words, words[1:]))
    assert got["distinct_pairs"] == pytest.approx(len(set(pairs)) / len(pairs))
    assert got["repeated_next"] == pytest.approx(sum(a == b for a, b in pairs) / len(words))


def test_statistics_do_not_depend_on_the_batch():
    texts = ["", prose(30, 1), "a", "  ", prose(400, 2) + "\n" + prose(5, 3), "é 中文 12", "\n\n", "!!!", prose(9000, 4)]
    together = quality.statistics(pa.array(texts))
    for text, row in zip(texts, together, strict=True):
        assert quality.statistics(pa.array([text]))[0].tolist() == row.tolist()
    assert (together[0] == 0).all()


def test_pool_adjacent_is_isotonic_regression():
    rng = np.random.default_rng(1)
    counts, ones = rng.integers(1, 20, 60), None
    ones = rng.binomial(counts, np.clip(np.linspace(-0.2, 1.2, 60), 0, 1))
    fitted = quality.pool_adjacent(ones, counts)
    assert (np.diff(fitted) >= -1e-12).all()
    # Optimality: no block may be cut into a lower left and a higher right part.
    for value in np.unique(fitted):
        at = np.flatnonzero(fitted == value)
        assert ones[at].sum() / counts[at].sum() == pytest.approx(value)
        for cut in range(1, len(at)):
            assert ones[at[:cut]].sum() / counts[at[:cut]].sum() >= value - 1e-9


def test_summed_equations_equal_one_ridge_regression(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, len(quality.NAMES))), rng.integers(0, 2, 300)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, label int").repartition(7)
    features = quality.Features(x.mean(0), x.std(0))
    z = features(x)
    penalty = np.diag([*[quality.RIDGE * 300] * quality.FEATURES, 1e-9 * 300])
    assert np.allclose(quality.solve_ridge(rows, features), np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, len(quality.NAMES)))
    features = quality.Features(np.zeros(x.shape[1]), np.ones(x.shape[1]))
    z = features(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.WIDTH**2))
    assert np.abs(z @ z.T - kernel).mean() < 0.06


@pytest.mark.parametrize("name, label, least", [("op5_fourier_quality", "quality", 0.93), ("op4_recurrent_toxicity", "toxic", 0.85)])
def test_held_out_labels(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    scored = store(queries.QUERIES[name](spark, folder), name)
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert scored.filter("score IS NULL OR score < 0 OR score > 1 OR predicted NOT IN (0, 1)").isEmpty()
    rows = scored.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert rows.agg(F.avg((F.col(label) == F.col("predicted")).cast("double"))).first()[0] >= least


SCORERS = {"quality": quality.quality_scores, "toxicity": toxicity.toxicity_scores}


@pytest.mark.parametrize("kind", SCORERS)
def test_messy_documents(spark, messy, no_documents, kind, monkeypatch):
    monkeypatch.setattr(toxicity, "FIRST_STEPS", 20)
    monkeypatch.setattr(toxicity, "STEPS", 20)
    labels = spark.createDataFrame([(0, 1, 9), (1, 1, 9), (3, 0, 9), (4, 0, 9), (9, 1, 9), (5, 0, 9), (None, 1, 9), (2, None, 9), (8, 7, 9)], "doc_id long, label int, score int")
    scored = SCORERS[kind](messy, labels, F.lit(True))
    rows = scored.collect()
    assert scored.columns == ["doc_id", "score"] and len(rows) == messy.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.ptp([r["score"] for r in rows if r["doc_id"] == 8]) < 2e-6
    assert SCORERS[kind](no_documents, labels, F.lit(True)).isEmpty()
    unlabelled = {r["score"] for r in SCORERS[kind](messy, labels.limit(0), F.lit(True)).collect()}
    assert unlabelled == {0.5 if kind == "quality" else 0.0}
    assert all(0 <= r["score"] <= 1 for r in SCORERS[kind](messy, labels.filter("label = 1"), F.lit(True)).collect())


def test_windows_cover_whole_texts():
    texts = ["", "a", " ".join(map(str, range(24))), " ".join(map(str, range(25))), " ".join(map(str, range(100))), None]
    words = toxicity.Words(pa.array(texts))
    for i, text in enumerate(texts):
        own = words.windows[words.text == i]
        seen = {w for w in own.ravel().tolist() if w != words.size}
        assert len(seen) == len((text or "").split())
        assert len(own) == (0 if not text else max(0, -(-(len(text.split()) - toxicity.WINDOW) // toxicity.STRIDE)) + 1)


def test_gradients():
    words = toxicity.Words(pa.array(["you are an idiot, really. " * 9, "a b c"]))
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = lambda: toxicity.Network.inputs(net, words).astype(np.float64)
    logit, kept = net.forward(x(), words.windows, keep=True)
    grads = net.gradients(x(), words, words.windows, kept, logit)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        if name in ("word", "char"):
            continue
        at = tuple(rng.integers(0, n) for n in value.shape)
        old, sides = value[at], []
        for step in (1e-4, -1e-4):
            value[at] = old + step
            sides.append((net.forward(x(), words.windows)[0] ** 2).sum() / 2)
        value[at] = old
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-4, rel=1e-3, abs=1e-7)


def test_scores_do_not_depend_on_the_batch():
    net = toxicity.train([prose(60, i) + (" idiot scum" if i % 2 else "") for i in range(60)], np.arange(60) % 2)
    texts = ["", prose(500, 100), prose(10, 101) + " idiot", None, "  "]
    together = net.scores(pa.array(texts))
    for text, score in zip(texts, together, strict=True):
        assert net.scores(pa.array([text], pa.string()))[0] == pytest.approx(score, abs=2e-6)

"""Quality scores: kernel ridge regression on document statistics by random Fourier features.

1. Statistics. One pass over the text, in numpy over whole Arrow batches: lengths, shares of kinds of
   characters, repetition of words, word pairs and lines. The narrow result is written once.
2. Features. Standardised statistics x become cos(W x + b) with W normal and b uniform: their inner
   products approximate a Gaussian kernel of width ``WIDTH``.
3. Fit. Every partition of labelled rows adds up its part of the normal equations; Spark adds the parts,
   and the driver solves one system of ``FEATURES`` + 1 unknowns.
4. Calibration. Raw scores of the labelled rows are counted into ``BINS`` bins; isotonic regression over
   the bins (pool adjacent violators) makes the score a probability.

Labels are the only thing learnt from, and only where the caller lets them be; the score of a
document depends on its text alone.

Defined cases: NULL and empty texts have all statistics 0 and get the score of that point; labels other
than 0 and 1 are ignored; without labelled rows every score is 0.5; rows with one id share its label;
repeated rows are scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.common import bounded_slices, store_texts, text_of
from moodtide.storage import store

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-4
BINS = 512
LOW, HIGH = -0.5, 1.5
SEED = 7
SLICE_BYTES = 1_000_000

NAMES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "letters", "capitals", "digits", "spaces", "stops",
    "commas", "bars", "marks", "symbols", "other_bytes", "triples", "distinct_words", "repeated_next",
    "distinct_pairs", "log_lines", "distinct_lines", "capital_words",
)
SPACE, CAPITAL, LETTER, DIGIT, STOP, COMMA, BAR, MARK, SYMBOL, WIDE = range(10)


def kinds() -> np.ndarray:
    """Kind of every byte."""
    table = np.full(256, SYMBOL, np.uint8)
    for name, kind in ((" \t\n\r\x0b\x0c", SPACE), (".", STOP), (",;:", COMMA), ("|", BAR), ("!?'\"()-", MARK)):
        table[[ord(c) for c in name]] = kind
    table[ord("A") : ord("Z") + 1], table[ord("a") : ord("z") + 1] = CAPITAL, LETTER
    table[ord("0") : ord("9") + 1], table[128:] = DIGIT, WIDE
    return table


def spread_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each (non-empty) run of bytes, from bytes and their places in the run."""
    lengths = ends - starts
    into = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    held = raw[into + np.repeat(starts, lengths)]
    values = spread_bits(held.astype(np.uint64) + (into.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
    return spread_bits(np.add.reduceat(values, np.cumsum(lengths) - lengths)) if len(lengths) else np.empty(0, np.uint64)


def distinct_per_text(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    keys = np.sort(spread_bits(hashes + text.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(20) | (text.astype(np.uint64) << np.uint64(44)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[first] >> np.uint64(44)).astype(np.int64), minlength=texts)


def sums(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=texts)


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of runs of True that do not cross the bounds of a text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    size = np.diff(bounds)
    out = np.zeros((n, len(NAMES)))
    if not len(raw):
        return out
    text = np.repeat(np.arange(n), size)
    kind = kinds()[raw]
    shares = np.bincount(text * 10 + kind, minlength=n * 10).reshape(n, 10) / np.maximum(size, 1)[:, None]
    starts, ends = runs(kind != SPACE, bounds)
    of, length = text[starts], (ends - starts).astype(np.float64)
    words = np.bincount(of, minlength=n)
    some = np.maximum(words, 1)
    mean = sums(length, of, n) / some
    spread = np.sqrt(np.maximum(sums(length**2, of, n) / some - mean**2, 0))
    hashes = segment_hashes(raw, starts, ends)
    follows = of[1:] == of[:-1]
    again = np.bincount(of[1:][follows & (hashes[1:] == hashes[:-1])], minlength=n)
    pair_text, pairs = of[1:][follows], spread_bits(hashes[1:] + np.uint64(3) * hashes[:-1])[follows]
    pair_count = np.maximum(np.bincount(pair_text, minlength=n), 1)
    line_starts, line_ends = runs(raw != 10, bounds)
    line_text = text[line_starts]
    lines = np.bincount(line_text, minlength=n)
    line_hashes = segment_hashes(raw, line_starts, line_ends)
    triple = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (text[2:] == text[:-2]) & (kind[2:] != SPACE)
    full = words > 0
    columns = (
        np.log1p(size), np.log1p(words), mean, spread, shares[:, LETTER], shares[:, CAPITAL], shares[:, DIGIT],
        shares[:, SPACE], shares[:, STOP], shares[:, COMMA], shares[:, BAR], shares[:, MARK], shares[:, SYMBOL],
        shares[:, WIDE], np.bincount(text[2:][triple], minlength=n) / np.maximum(size, 1),
        distinct_per_text(hashes, of, n) / some, again / some, distinct_per_text(pairs, pair_text, n) / pair_count,
        np.log1p(lines), distinct_per_text(line_hashes, line_text, n) / np.maximum(lines, 1),
        np.bincount(of[kind[starts] == CAPITAL], minlength=n) / some,
    )
    for i, column in enumerate(columns):
        out[:, i] = np.where(full | (i < 2), column, 0)
    return out


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of its text, as a written table."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            rows = pa.FixedSizeListArray.from_arrays(statistics(batch["text"]).ravel(), len(NAMES))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], rows.cast(pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return store_texts(rows.mapInArrow(measure, "doc_id long, x array<double>"), "document_statistics")


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, len(NAMES)))


class Features:
    """Random Fourier features of standardised statistics, with a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / WIDTH, (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack((np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))))


def fit_features(stats: DataFrame) -> Features:
    """Mean and deviation of every statistic, over all documents."""
    columns = [f(F.get("x", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(len(NAMES)) for f in (F.avg, F.stddev_pop)]
    row = stats.agg(*columns).first()
    mean = np.array([row[f"avg{i}"] or 0.0 for i in range(len(NAMES))])
    scale = np.array([row[f"stddev_pop{i}"] or 0.0 for i in range(len(NAMES))])
    return Features(mean, np.where(scale > 1e-9, scale, 1.0))


def solve_ridge(labelled: DataFrame, features: Features) -> np.ndarray | None:
    """Weights from the summed normal equations of (x, label); None without rows."""
    size = FEATURES + 1

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = features(stacked(batch["x"]))
            total += z.T @ np.hstack((z, batch["label"].to_numpy(float)[:, None]))
        yield pd.DataFrame({"i": np.arange(size), "line": list(total)})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"].iloc[:1], "line": [np.stack(group["line"].to_numpy()).sum(0)]})

    lines = labelled.mapInPandas(parts, "i int, line array<double>")
    summed = lines.groupBy("i").applyInPandas(add, "i int, line array<double>").toPandas().sort_values("i")
    if summed.empty:
        return None
    system = np.stack(summed["line"].to_numpy())
    rows = system[-1, size - 1]
    if not rows:
        return None
    penalty = np.full(size, RIDGE * rows)
    penalty[-1] = 1e-9 * rows
    return np.linalg.solve(system[:, :size] + np.diag(penalty), system[:, size])


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)


def pool_adjacent(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-decreasing means closest to ones / counts, weighted by counts."""
    blocks: list[list[float]] = []
    for one, count in zip(ones, counts, strict=True):
        blocks.append([one, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.concatenate([np.full(int(n), one / count) for one, count, n in blocks]) if blocks else np.empty(0)


def calibrate(labelled: DataFrame, features: Features, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the calibrated score as a function of the raw one."""

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = features(stacked(batch["x"])) @ weights
            yield pd.DataFrame({"bin": bin_of(raw), "label": batch["label"].to_numpy(np.int64)})

    counted = labelled.mapInPandas(binned, "bin long, label long").groupBy("bin")
    table = counted.agg(F.sum("label").alias("ones"), F.count("*").alias("n")).toPandas().sort_values("bin")
    centres = LOW + (table["bin"].to_numpy() + 0.5) * (HIGH - LOW) / BINS
    return centres, pool_adjacent(table["ones"].to_numpy(float), table["n"].to_numpy(float))


def quality_scores(documents: DataFrame, labels: DataFrame, may_learn: Column) -> DataFrame:
    """doc_id and calibrated score of every document.

    ``labels``: doc_id, label. Only labels for which ``may_learn`` (a condition on doc_id) holds are used.
    """
    stats = document_statistics(documents)
    features = fit_features(stats)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    usable = usable.filter(may_learn & F.col("label").isin(0, 1))
    labelled = store(stats.join(usable, "doc_id").select("x", "label"), "labelled_statistics")
    weights = solve_ridge(labelled, features)
    if weights is None:
        return stats.select("doc_id", F.lit(0.5).alias("score"))
    places, values = calibrate(labelled, features, weights)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = features(stacked(batch["x"])) @ weights
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": np.interp(raw, places, values)})

    return stats.mapInPandas(score, "doc_id long, score double")

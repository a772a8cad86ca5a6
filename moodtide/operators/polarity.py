"""Polarity model: a multinomial naive Bayes fitted and applied as Spark aggregations.

    weight(t) = ln((c1(t)+1) / (N1+V)) - ln((c0(t)+1) / (N0+V))
    score     = 1 / (1 + exp(-z)),  z = mean weight over the known tokens of a text

A text without known tokens has no score and is classed as unknown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from moodtide.functions.classes import opinion_class
from moodtide.functions.numbers import clamp_score
from moodtide.functions.text import clean_text, tokens
from moodtide.operators.filters import require_columns
from moodtide.schemas import NEGATIVE_TO, POSITIVE_FROM
from moodtide.storage import store_texts

LOGIT_LIMIT = 500.0

# A model up to this estimated size is broadcast whole (rows are charged a fixed overhead).
BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

# Beyond it only the most frequent short tokens are: at most 200,000 rows of at most 64 characters.
HEAD_ROWS = 200_000
HEAD_TOKEN_CHARS = 64

# Tokens that a task looks up at once, tokens of texts that ask for their weights together, and chunks
# that ask for one token under one key.
TASK_TOKENS = 200_000
CHUNK_TOKENS = 1_000_000
KEY_CHUNKS = 100_000
# Bytes of text that a caller's function gets at once.
SCORER_BYTES = 4_000_000


def token_counts(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    """Occurrences of every token in texts labelled 1 and in texts labelled 0.

    Grouping by token combines on the map side, so a token in every text costs one row per task.
    """
    label = F.col(label_col)
    return (
        labelled.filter(label.isin(0, 1))
        .select(label.cast("long").alias("label"), F.explode(tokens(F.col(text_col))).alias("token"))
        .filter(F.col("token") != "")
        .groupBy("token")
        .agg(F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative"))
    )


def token_weights(counts: DataFrame, min_occurrences: int = 1) -> DataFrame:
    """Log-odds weights with add-one smoothing from a token count table.

    ``min_occurrences`` leaves out rarer tokens; by default every token seen in training is known.
    """
    totals = counts.agg(
        F.struct(
            F.sum("positive").alias("positive"), F.sum("negative").alias("negative"), F.count("token").alias("size")
        )
    ).scalar()

    def log_share(name: str) -> Column:
        return F.log((F.col(name) + 1) / (F.col("totals")[name] + F.col("totals")["size"]))

    occurrences = F.col("positive") + F.col("negative")
    return (
        counts.withColumn("totals", totals)
        .filter(occurrences >= min_occurrences)
        .select(
            "token",
            (log_share("positive") - log_share("negative")).alias("weight"),
            occurrences.alias("occurrences"),
        )
    )


def fit_polarity_model(
    labelled: DataFrame, text_col: str = "text", label_col: str = "label", min_occurrences: int = 1
) -> DataFrame:
    """Model table (token, weight, occurrences). Store it once; scoring reads it several times.

    Tokens rarer than ``min_occurrences`` are left out: above 1 that keeps the table smaller, and
    makes texts without a more frequent token unknown.
    """
    require_columns(labelled, [text_col, label_col])
    return token_weights(token_counts(labelled, text_col, label_col), min_occurrences)


def fits_broadcast(model: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the model: one small aggregation over the stored table."""
    size = model.agg(
        F.coalesce(F.sum(F.octet_length("token") + ROW_OVERHEAD_BYTES), F.lit(0)).alias("bytes")
    ).first()
    return size["bytes"] <= limit


def score_of(total: Column, known: Column) -> Column:
    """Logistic of the mean weight; NULL when no token is known (``least``/``greatest`` would skip it)."""
    z = F.greatest(F.lit(-LOGIT_LIMIT), F.least(F.lit(LOGIT_LIMIT), total / known))
    return F.when((known > 0) & total.isNotNull(), 1 / (1 + F.exp(-z)))


def _token_hashes(text_col: str) -> Column:
    """Hashes of the tokens of a text; none for NULL."""
    hashes = F.transform(F.array_remove(tokens(F.col(text_col)), ""), lambda t: F.xxhash64(t))
    return F.coalesce(hashes, F.array().cast("array<bigint>"))


def _sorted_weights(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and the weights of a model that is measured or bounded."""
    found = model.select(F.xxhash64("token").alias("hash"), "weight").toPandas().sort_values("hash")
    return found["hash"].to_numpy(np.int64), found["weight"].to_numpy(float)


def runs_of_rows(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """First row and end of runs of rows whose sizes add up to at most ``limit``, one row at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists and the row of each."""
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), _sizes(lists))


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _looked_up(hashes: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each asked hash in the sorted ones, and whether it is there."""
    if not len(hashes):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
    return at, hashes[at] == asked


def _score_in_task(df: DataFrame, model: DataFrame, text_col: str) -> DataFrame:
    """Score and class added in the task that reads the text: no shuffle.

    Spark cuts the text into tokens and hashes them; runs of Arrow rows are looked up in the sorted
    hashes of the model, which is measured to fit and travels once to every executor.
    """
    shipped = df.sparkSession.sparkContext.broadcast(_sorted_weights(model))

    @F.arrow_udf("double")
    def mean_weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, weights = shipped.value
        for batch in batches:
            means = np.empty(len(batch))
            for start, stop in runs_of_rows(_sizes(batch), TASK_TOKENS):
                asked, text = _flat(batch.slice(start, stop - start))
                at, known = _looked_up(hashes, asked)
                counts = np.bincount(text[known], minlength=stop - start)
                totals = np.bincount(text[known], weights=weights[at[known]], minlength=stop - start)
                means[start:stop] = np.where(counts > 0, totals / np.maximum(counts, 1), np.nan)
            yield pa.array(means, pa.float64(), mask=np.isnan(means))

    scored = df.withColumn("_mean", mean_weight(_token_hashes(text_col)))
    return classify(scored.withColumn("sentiment_score", score_of(F.col("_mean"), F.lit(1))).drop("_mean"))


def frequent_tokens(model: DataFrame, limit: int) -> DataFrame:
    """Short tokens above a power of two of occurrences, the lowest that leaves at most ``limit`` rows.

    The power is read off a histogram by bit length, which has at most 64 rows; sorting the
    vocabulary for its top would push ``limit`` rows of every partition through one task.
    """
    short = model.filter(F.length("token") <= HEAD_TOKEN_CHARS)
    bits = F.length(F.bin("occurrences")).alias("bits")
    floor, taken = None, 0
    for level in sorted(short.groupBy(bits).count().collect(), reverse=True):
        taken += level["count"]
        if taken > limit:
            break
        floor = 2 ** (level["bits"] - 1)
    return short.filter(F.lit(False) if floor is None else F.col("occurrences") >= floor)


ASKED = "_chunk long, _total double, _known long, _places array<int>, _asked array<long>"


def _asked_in_chunks(texts: DataFrame, group: Sequence[str], head: DataFrame, chunk_tokens: int) -> DataFrame:
    """A written table of two kinds of rows, from one pass over the texts.

    Per text: its group, its chunk, the sum and number of its frequent tokens, and for every other one
    its place in the list of the chunk. Per chunk of about ``chunk_tokens`` tokens: that list, each
    distinct hash once.
    """
    shipped = texts.sparkSession.sparkContext.broadcast(_sorted_weights(head))
    fields = [T.StructField(f.name, f.dataType) for f in texts.select(*group).schema]
    schema = T.StructType([*fields, *T.StructType.fromDDL(ASKED).fields])

    def rows_of(chunk: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, weights = shipped.value
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        values, text = _flat(rows["_tokens"])
        at, known = _looked_up(hashes, values)
        n, frequent = rows.num_rows, text[known]
        asked, places = np.unique(values[~known], return_inverse=True)
        ends = np.cumsum(np.append(0, np.bincount(text[~known], minlength=n))).astype(np.int32)
        made = {
            "_chunk": pa.array(np.full(n, chunk)),
            "_total": pa.array(np.bincount(frequent, weights=weights[at[known]], minlength=n).astype(float)),
            "_known": pa.array(np.bincount(frequent, minlength=n).astype(np.int64)),
            "_places": pa.ListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.int32))),
            "_asked": pa.nulls(n, pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_pydict({name: rows[name] for name in group} | made)
        one = {name: pa.nulls(1, rows[name].type) for name in group}
        one |= {name: pa.nulls(1, made[name].type) for name in ("_total", "_known", "_places")}
        one |= {"_chunk": pa.array([chunk]), "_asked": pa.array([asked], pa.list_(pa.int64()))}
        yield pa.RecordBatch.from_pydict({name: one[name] for name in [*group, *made]})

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            sizes = _sizes(batch["_tokens"])
            for start, stop in runs_of_rows(sizes, chunk_tokens // 4):
                held.append(batch.slice(start, stop - start))
                size += int(sizes[start:stop].sum())
                if size >= chunk_tokens:
                    yield from rows_of(chunk, held)
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield from rows_of(chunk, held)

    return store_texts(texts.select(*group, "_tokens").mapInArrow(chunks, schema), "asked_tokens")


def _sums_with_split_model(
    texts: DataFrame, group: Sequence[str], model: DataFrame, head_rows: int, salts: int | None, chunk_tokens: int
) -> DataFrame:
    """Frequent tokens by broadcast, the rest by a shuffle join of the distinct tokens of each chunk.

    A chunk asks for a token once, however often its texts hold it, and takes the weights to its texts'
    lists of places. One token is one row per chunk, spread over ``salts`` keys.
    """
    stored = _asked_in_chunks(texts, group, frequent_tokens(model, head_rows), chunk_tokens)
    lists = stored.filter(F.col("_asked").isNotNull())
    if salts is None:
        salts = 1 + lists.count() // KEY_CHUNKS
    asked = lists.select("_chunk", F.posexplode("_asked").alias("_place", "_token"))
    tail = model.select(
        F.xxhash64("token").alias("_token"),
        F.col("weight").alias("_weight"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_salt"),
    )
    salted = asked.withColumn("_salt", F.pmod(F.xxhash64("_chunk"), F.lit(salts)))
    found = salted.join(tail.hint("merge"), ["_token", "_salt"])
    found = found.select(F.col("_chunk").alias("_of"), "_place", "_weight")
    rows = stored.filter(F.col("_asked").isNull()).drop("_asked")
    fields = rows.select(*group, "_total", "_known").schema

    def sums(rows: pa.Table, found: pa.Table) -> pa.Table:
        lists = rows["_places"].combine_chunks()
        places, text = _flat(lists)
        at = found["_place"].to_numpy()
        weights = np.full(max(places.max(initial=-1), at.max(initial=-1)) + 1, np.nan)
        weights[at] = found["_weight"].to_numpy()
        held = weights[places]
        known = ~np.isnan(held)
        totals = np.bincount(text[known], weights=held[known], minlength=len(lists)) + rows["_total"].to_numpy()
        counts = np.bincount(text[known], minlength=len(lists)) + rows["_known"].to_numpy()
        made = {"_total": pa.array(totals), "_known": pa.array(counts.astype(np.int64))}
        return pa.table({name: rows[name] for name in group} | made)

    return rows.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(sums, fields)


def _score_by_joins(
    df: DataFrame,
    model: DataFrame,
    key: Sequence[str],
    text_col: str,
    head_rows: int,
    salts: int | None,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """Score and class added by joins, for a model too large to travel whole.

    Scores are joined back on the key and a hash of the text, NULL-safe; rows equal in both have one score.
    """
    hashed = df.withColumn("_hash", F.xxhash64(text_col))
    group = [*key, "_hash"]
    texts = hashed.select(*group, _token_hashes(text_col).alias("_tokens"))
    sums = _sums_with_split_model(texts, group, model, head_rows, salts, chunk_tokens)
    scores = sums.select(*group, score_of(F.col("_total"), F.col("_known")).alias("_score"))
    once = scores.groupBy(*group).agg(F.max("_score").alias("sentiment_score"))
    renamed = once.withColumnsRenamed({name: f"_score_{name}" for name in group})
    on = F.lit(True)
    for name in group:
        on = on & hashed[name].eqNullSafe(renamed[f"_score_{name}"])
    columns = [hashed[name] for name in df.columns]
    return classify(hashed.join(renamed, on, "left").select(*columns, "sentiment_score"))


def score_text(
    df: DataFrame,
    model: DataFrame,
    key: Sequence[str],
    text_col: str = "text",
    broadcast_limit: int = BROADCAST_BYTES,
    head_rows: int = HEAD_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """All rows and columns of ``df`` with score and class added.

    ``model`` should be a stored table: it is measured first. Up to ``broadcast_limit`` bytes it is
    shipped to the executors and each text is scored where it is read. A larger one is joined with the
    distinct rare tokens of chunks of texts; the rows are then shuffled once. A rare token that very
    many chunks ask for is spread over ``salts`` keys (by default one per 100,000 chunks). Both ways
    give the same scores.
    """
    require_columns(df, [*key, text_col])
    if fits_broadcast(model, broadcast_limit):
        return _score_in_task(df, model, text_col)
    return _score_by_joins(df, model, key, text_col, head_rows, salts)


def score_records(
    df: DataFrame, model: DataFrame, key: Sequence[str], keep: Sequence[str] = (), text_col: str = "text", **limits: int
) -> DataFrame:
    """Score and class per record, without the text: key, kept columns, score, class."""
    columns = [*key, *keep]
    require_columns(df, [*columns, text_col])
    scored = score_text(df.select(*dict.fromkeys([*columns, text_col])), model, key, text_col, **limits)
    return scored.select(*columns, "sentiment_score", "sentiment_category")


def classify(df: DataFrame, positive_from: float = POSITIVE_FROM, negative_to: float = NEGATIVE_TO) -> DataFrame:
    """Add the opinion class of ``sentiment_score``."""
    return df.withColumn("sentiment_category", opinion_class(F.col("sentiment_score"), positive_from, negative_to))


def per_text(load_scorer: Callable[[], Callable[[str], float | None]]) -> Callable[[], Callable[[pd.Series], pd.Series]]:
    """A loader of a batch function from one of a function for single texts; an error gives no score."""

    def load() -> Callable[[pd.Series], pd.Series]:
        scorer = load_scorer()

        def one(text: str) -> float | None:
            try:
                return scorer(text)
            except Exception:
                return None

        return lambda texts: texts.map(one)

    return load


def score_with(
    df: DataFrame,
    load_scorer: Callable[[], Callable[[pd.Series], pd.Series]],
    text_col: str = "text",
    failures: Observation | None = None,
) -> DataFrame:
    """Score with a caller's own function over Arrow batches of texts, at most 4 MB of text or one text at a time.

    ``load_scorer`` runs once per task and returns a function from a series of texts to one of
    scores, in the same order (``per_text`` makes one from a function for single texts). Blank texts
    are not passed to it. A result that is not a float gives no score; ``failures`` counts those
    (column ``failed``). An error of the batch function ends the task. The text is cleaned by Spark.
    The memory of a task also holds two Arrow batches as the session sizes them: write the result
    with ``storage.store_texts`` or within ``small_batches`` to keep those short.
    """

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = load_scorer()

        def some(texts: pd.Series) -> pa.Array:
            asked = texts.notna() & (texts != "")
            found = scorer(texts[asked])
            floats = pd.Series([v if isinstance(v, float) else None for v in found], index=found.index, dtype=object)
            # A scorer's own NaN is the lowest score; Arrow would turn it into NULL.
            numbers = [None if v is None else 0.0 if v != v else float(v) for v in floats]
            scored = pd.Series(numbers, index=found.index, dtype="float64").reindex(texts.index)
            return pa.array(scored.to_numpy(), pa.float64(), from_pandas=True)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy().astype(np.int64)
            runs = runs_of_rows(sizes, SCORER_BYTES)
            parts = [some(batch.slice(start, stop - start).to_pandas()) for start, stop in runs]
            yield pa.concat_arrays([*parts, pa.nulls(0, pa.float64())])

    require_columns(df, [text_col])
    cleaned = df.withColumn("_clean", clean_text(F.col(text_col)))
    scored = cleaned.withColumn("sentiment_score", clamp_score(scores("_clean")))
    if failures is not None:
        asked = F.coalesce(F.col("_clean") != "", F.lit(False))
        scored = scored.observe(failures, F.count_if(asked & F.col("sentiment_score").isNull()).alias("failed"))
    return classify(scored.drop("_clean"))

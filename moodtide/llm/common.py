"""Helpers shared by the operators: word lists, sizes of tables, rows as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.storage import store, store_texts

SHINGLE_WORDS = 5
NOT_WORD = r"[^\p{L}\p{N}]+"


def text_of(text: str | Column) -> Column:
    """The text, NULL as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def row_key(text: str = "text") -> Column:
    """A hash of the text: with the id it names a row where ids repeat."""
    return F.xxhash64(text_of(text))


def packed(documents: DataFrame) -> DataFrame:
    """doc_id, _row and the whole row as one column: joins then meet no other column names."""
    names = [F.col(f"`{name}`") for name in documents.columns]
    return documents.select("doc_id", row_key().alias("_row"), F.struct(*names).alias("_document"))


def without_rows(documents: DataFrame, keys: DataFrame, limit: int = 32 * 1024 * 1024) -> DataFrame:
    """The documents whose (doc_id, _row) is not in ``keys``, a stored table.

    ``keys`` are broadcast where they are measured to fit, so that the documents are not shuffled.
    """
    named = keys.select(F.col("doc_id").alias("_id"), F.col("_row").alias("_hash"))
    here = F.broadcast(named) if measured_bytes(keys, F.lit(32)) <= limit else named
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    return packed(documents).join(here, same, "left_anti").select("_document.*")


def bounded_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def measured_bytes(df: DataFrame, row_bytes: Column) -> int:
    """Sum of an estimate per row: one aggregation."""
    return df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes")).first()["bytes"]


# A key with more rows than this counts as hot.
HOT_ROWS = 10_000


def looked_up(rows: DataFrame, keys: list[str], table: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has one row per key; NULL where it has none.

    Keys of more than ``hot_rows`` rows, of which there is at most one per ``hot_rows`` rows, are broadcast.
    Their rows, and those with a NULL key, then go to the second join under keys of their own.
    """
    names = [name for name in table.columns if name not in keys]
    often = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).drop("_n")
    often = store(often, "hot_keys")
    if often.isEmpty():
        return rows.join(table, keys, "left")
    hot = table.join(F.broadcast(often), keys).select(*keys, F.struct(*names).alias("_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    placed = F.col("_hot").isNotNull()
    for key in keys:
        placed = placed | F.col(key).isNull()
    spread = F.xxhash64(*(f"`{name}`" for name in rows.columns))
    own = {f"_key{i}": F.when(placed, spread).otherwise(F.col(key)) for i, key in enumerate(keys)}
    cold = table.select(*(F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)), F.struct(*names).alias("_cold"))
    joined = marked.withColumns({"_placed": placed, **own}).join(
        cold.withColumn("_placed", F.lit(False)), ["_placed", *own], "left"
    )
    value = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *(value[name].alias(name) for name in names))

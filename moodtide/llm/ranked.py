"""Ranked lexical search over an index whose documents are grouped by equal length normaliser.

A document with n of all L terms has the normaliser m = 50 + (50 n N) div L. A term that occurs tf times in it
adds  w * ((10^9 tf) div (1000 tf + 20 m)),  w the term's weight, so within one stratum (one m) what a term adds
depends on tf alone. The index follows that:

1. Documents are ordered by (m, id) and cut into shards: up to ``SHARD_DOCS`` documents of one stratum. A shard
   holds its postings by term and tf, one run of document places for each (term, tf); impacts are computed once
   per run. Strata with very many documents are several shards, so no group grows with the table.
2. The bound of a shard for an item sums what each term adds at the shard's highest tf for it: no document of the
   shard has a higher score.
3. The ``SEEDS`` shards with the highest bounds are visited first. The k-th score found there is the item's floor;
   after that every shard whose bound reaches the floor is visited, and no other. The result is exact.

Terms are looked up by their bytes. Items are worked off in blocks of about ``BLOCK_BYTES`` of text, each against
all documents; the vocabulary, weights and floors of one block, which its bytes bound, are all that passes the driver.

Defined cases: NULL texts have no terms; documents without terms are in no count; rows with a NULL id come after all
ids at equal scores; repeated rows are documents of their own; items equal in id and text are one item, items that
differ in text only are ranked each for itself under their id; items without terms, or whose terms no document holds,
get no rows; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from moodtide.llm.common import bounded_slices, measured_bytes, text_of
from moodtide.storage import store

BLOCK_BYTES = 8_000_000
SLICE_BYTES = 4_000_000
# Texts are cut into words in pieces of this size, so that a very long one needs no longer list.
PIECE_BYTES = 1_000_000
SHARD_DOCS = 2048
SEEDS = 16
# Postings that are added up at a time.
BLOCK_POSTINGS = 500_000

LETTER_OR_DIGIT = [*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]
# Bytes of UTF-8: letters and digits stay, A to Z become small, all other signs of ASCII part terms.
BYTES = bytes(b if b in LETTER_OR_DIGIT else b + 32 if ord("A") <= b <= ord("Z") else 32 for b in range(256))


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    plain, at = text.translate(BYTES), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE_BYTES)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Distinct items (item_id, text) as lists of about ``BLOCK_BYTES`` of text."""
    distinct = items.select("item_id", text_of("text").alias("text")).distinct()
    blocks = max(1, math.ceil(measured_bytes(distinct, F.octet_length("text")) / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        rows = distinct.filter(block == number).orderBy(F.col("item_id").asc_nulls_last(), "text").collect()
        if rows:
            yield [(row["item_id"], row["text"].encode()) for row in rows]


COUNTED = "doc_id long, n long, terms array<int>, tfs array<int>"


def counted_terms(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document the number of its terms, and place and occurrences of those in the vocabulary."""
    shipped = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value.get
        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            sizes, terms, tfs = [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                n, counts = 0, {}
                for piece in term_pieces(text):
                    n += len(piece)
                    at = np.fromiter(map(known, piece, repeat(-1)), np.int32, len(piece))
                    for term, tf in zip(*map(np.ndarray.tolist, np.unique(at[at >= 0], return_counts=True)), strict=True):
                        counts[term] = counts.get(term, 0) + tf
                sizes.append(n)
                terms.append(list(counts))
                tfs.append(list(counts.values()))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (terms, tfs)]
            names = ["doc_id", "n", "terms", "tfs"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), *lists], names=names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(run, COUNTED)


SHARDS = (
    "shard long, m long, n_docs int, doc_ids array<long>, run_terms array<int>, run_tfs array<int>, run_ends array<int>,"
    " places array<int>"
)
SHARD_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4]
SHARD_NAMES = [part.split()[0] for part in SHARDS.split(", ")]


def shard_row(number: int, m: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Documents of one stratum as runs of places by (term, tf)."""
    held = pa.Table.from_batches(parts).combine_chunks()
    lengths = np.diff(np.concatenate([[0], np.cumsum(held["terms"].combine_chunks().value_lengths().to_numpy())]))
    terms, tfs = (held[name].combine_chunks().flatten().to_numpy() for name in ("terms", "tfs"))
    place = np.repeat(np.arange(held.num_rows, dtype=np.int32), lengths)
    order = np.lexsort((place, tfs, terms))
    terms, tfs, place = terms[order], tfs[order], place[order]
    ends = np.flatnonzero(np.append((np.diff(terms) != 0) | (np.diff(tfs) != 0), True)) + 1 if len(terms) else np.empty(0, np.int64)
    columns = number, m, held.num_rows, held["doc_id"].to_pylist(), terms[ends - 1], tfs[ends - 1], ends, place
    arrays = [pa.array([c], kind) for c, kind in zip(columns, SHARD_KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=SHARD_NAMES)


def shard_table(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: documents in order of (m, id), one row per shard."""
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L").alias("m")
    placed = counted.filter((F.col("n") > 0) & (F.size("terms") > 0)).select("doc_id", m, "terms", "tfs")
    key = ["m", "doc_id", F.xxhash64("terms")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, rows, stratum = TaskContext.get().partitionId() << 32, [], 0, None
        for batch in batches:
            ms = batch["m"].to_numpy()
            at = 0
            for end in [*(np.flatnonzero(np.diff(ms)) + 1).tolist(), len(ms)]:
                while at < end:
                    if parts and (ms[at] != stratum or rows == SHARD_DOCS):
                        yield shard_row(number, stratum, parts)
                        number, parts, rows = number + 1, [], 0
                    stratum, taken = int(ms[at]), min(end - at, SHARD_DOCS - rows)
                    parts.append(batch.slice(at, taken))
                    at, rows = at + taken, rows + taken
        if parts:
            yield shard_row(number, stratum, parts)

    return placed.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(cut, SHARDS)


def impacts(tfs: np.ndarray, m: int) -> np.ndarray:
    tfs = tfs.astype(np.int64)
    return 1_000_000_000 * tfs // (1000 * tfs + 20 * m)


class Wanted:
    """The items of one block: their terms and weights behind one another."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.terms, self.weights = terms, weights
        self.size = len(weights)
        self.asked = np.array([i for i, t in enumerate(terms) if len(t)], np.int64)
        lengths = [len(terms[i]) for i in self.asked]
        self.flat = np.concatenate([terms[i] for i in self.asked] or [np.empty(0, np.int64)])
        self.starts = np.cumsum(lengths, dtype=np.int64) - np.array(lengths, np.int64)

    def bounds(self, run_terms: np.ndarray, run_tfs: np.ndarray, m: int) -> np.ndarray:
        """For each item that has terms the highest score that its terms can have in a shard."""
        last = np.append(np.diff(run_terms) != 0, True) if len(run_terms) else np.empty(0, bool)
        most = np.zeros(self.size, np.int64)
        most[run_terms[last]] = impacts(run_tfs[last], m)
        return np.add.reduceat(most[self.flat] * self.weights[self.flat], self.starts)

    def scores(self, items: np.ndarray, shard: tuple) -> np.ndarray:
        """Scores of all documents of a shard, a row for each item."""
        n_docs, run_terms, added, ends, places = shard
        total = np.zeros(len(items) * n_docs, np.int64)
        terms = np.concatenate([self.terms[i] for i in items])
        row = np.repeat(np.arange(len(items)), [len(self.terms[i]) for i in items])
        before = np.concatenate([[0], ends])
        low = before[np.searchsorted(run_terms, terms, "left")]
        held = before[np.searchsorted(run_terms, terms, "right")] - low
        for some in cut_by_sum(held, BLOCK_POSTINGS):
            many = held[some]
            at = np.repeat(low[some] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            value = added[at] * np.repeat(self.weights[terms[some]], many)
            np.add.at(total, np.repeat(row[some] * n_docs, many) + places[at], value)
        return total.reshape(len(items), n_docs)


def cut_by_sum(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of about ``limit`` together, one entry at least."""
    part = np.cumsum(sizes) // limit
    ends = [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for start, end in zip([0, *ends[:-1]], ends, strict=True):
        if end > start:
            yield slice(start, end)


def best_places(scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, floor: int, k: int) -> np.ndarray:
    """The k best of those from ``floor`` on: highest score, then smallest id, no id last."""
    found = np.flatnonzero(scores >= floor)
    if len(found) > k:
        least = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= least]
    return found[np.lexsort((ids[found], no_id[found], -scores[found]))[:k]]


def shard_bounds(shards: DataFrame, shipped) -> DataFrame:
    """item, shard, bound: every shard that may hold a score above 0 for the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Wanted(*shipped.value)
        for batch in batches:
            for i in range(batch.num_rows):
                terms, tfs = (batch[name][i].values.to_numpy() for name in ("run_terms", "run_tfs"))
                bound = wanted.bounds(terms, tfs, batch["m"][i].as_py())
                some = np.flatnonzero(bound)
                shard = pa.array(np.full(len(some), batch["shard"][i].as_py(), np.int64))
                arrays = [pa.array(wanted.asked[some].astype(np.int32)), shard, pa.array(bound[some])]
                yield pa.RecordBatch.from_arrays(arrays, names=["item", "shard", "bound"])

    return shards.select("shard", "m", "run_terms", "run_tfs").mapInArrow(run, "item int, shard long, bound long")


FOUND = "item int, doc_id long, score long"


def visited(shards: DataFrame, visits: DataFrame, shipped, floors: dict[int, int], k: int) -> DataFrame:
    """The best k of every visited shard for every item that visits it, none below the item's floor."""
    told = shards.sparkSession.sparkContext.broadcast(floors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, floor = Wanted(*shipped.value), told.value
        for batch in batches:
            out_items, out_ids, out_scores = [], [], []
            for i in range(batch.num_rows):
                ids = batch["doc_ids"][i].values
                no_id, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                terms, tfs, ends, places = (batch[name][i].values.to_numpy() for name in SHARD_NAMES[4:])
                per_run = impacts(tfs, batch["m"][i].as_py())
                shard = len(ids), terms, np.repeat(per_run, np.diff(ends, prepend=0)), ends, places
                items = batch["items"][i].values.to_numpy()
                for some in cut_by_sum(np.full(len(items), len(ids)), BLOCK_POSTINGS):
                    for item, scores in zip(items[some].tolist(), wanted.scores(items[some], shard), strict=True):
                        best = best_places(scores, ids, no_id, floor.get(item, 1), k)
                        if len(best):
                            out_items.append(np.full(len(best), item, np.int32))
                            out_ids.append(pa.array(ids[best], mask=no_id[best]))
                            out_scores.append(scores[best])
            if out_items:
                arrays = [pa.array(np.concatenate(out_items)), pa.concat_arrays(out_ids), pa.array(np.concatenate(out_scores))]
                yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    by_shard = visits.groupBy("shard").agg(F.collect_list("item").alias("items"))
    return shards.join(by_shard, "shard").select("m", "doc_ids", *SHARD_NAMES[4:], "items").mapInArrow(run, FOUND)


def best_of_items(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(documents: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items of one block."""
    spark = documents.sparkSession
    item_terms = [sorted({t for piece in term_pieces(text) for t in piece}) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in item_terms for t in terms}))}
    counted = store(counted_terms(documents, vocabulary), "counted_terms")
    sizes = counted.filter("n > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * sizes["n"] + 2) / (2 * row["count"] + 1)))
    known = [np.array([vocabulary[t] for t in terms], np.int64) for terms in item_terms]
    shipped = spark.sparkContext.broadcast((known, weights))

    shards = store(shard_table(counted, sizes["n"], sizes["terms"]), "shards")
    bounds = store(shard_bounds(shards, shipped), "shard_bounds")
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "shard")
    seeds = store(bounds.withColumn("place", F.row_number().over(by_bound)).filter(F.col("place") <= SEEDS), "seed_shards")
    first = store(best_of_items(visited(shards, seeds, shipped, {}, k), k).drop("rank"), "seed_scores")
    full = first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") == k)
    floors = {row["item"]: row["floor"] for row in full.collect()}
    limit = spark.createDataFrame(list(floors.items()), "item int, floor long")
    open_ = bounds.join(F.broadcast(limit), "item", "left").filter(F.col("bound") >= F.coalesce("floor", F.lit(1)))
    rest = open_.join(seeds.select("item", "shard"), ["item", "shard"], "left_anti")
    found = best_of_items(first.unionByName(visited(shards, rest, shipped, floors, k)), k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item int, item_id long")
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item, all if fewer have a score."""
    result = documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items):
        result = result.union(search_block(documents, block, k))
    return result

"""Exact top-k by inner product, with a table of pivot distances to leave candidates out.

Every vector is turned into integers, and its distances to ``PIVOTS`` pivot vectors are computed once
and stored. For a query q and a candidate x the triangle inequality gives

    |q - x| >= max over pivots p of | |q - p| - |x - p| |  =: bound
    q . x = (|q|^2 + |x|^2 - |q - x|^2) / 2  <=  (|q|^2 + |x|^2 - bound^2) / 2

Candidates are evaluated in descending order of that upper limit, a run at a time, until the k-th
score found exceeds the next limit: no score can be missed. Scores are integers, so the search is exact.

Queries are dealt into blocks and rows into chunks, both of bounded size; a task holds one block and one
chunk of the grid and returns only candidates that can still be among the best k of a query: at most
k per query, and none below the k-th score that the query reaches on the other queries of its block.
No query and no row passes the driver; the plan is the same for any number of blocks.

Defined cases: vectors that are NULL, empty or hold NULL, NaN or infinite components take no part, nor do
those whose integers have a sum of squares of 2^53 or more, as their scores need not be exact (at 64
components of equal size: beyond 46,000 each); a shorter vector counts as filled up with zeros; rows
that share the query's id are the query's own; query rows equal in id and vector are one query, those
of one id and different vectors are queries of their own, each with its ranks; equal scores go to the
smaller id; rows without an id are candidates, after all ids at equal scores; repeated rows are
candidates of their own; other columns are ignored. Vectors of one id with equal 64-bit hashes count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from moodtide.storage import store

PIVOTS = 24
# Queries of a block and rows of a chunk: at 64 components 4 MB and 2 MB.
BLOCK_QUERIES, CHUNK_ROWS = 8_192, 4_096
SEED_ROWS = 2_048
STRIP_QUERIES = 128
RUN = 256
# Sums of products of whole numbers are exact in doubles below this.
EXACT = 2.0**53


def integer_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """Ids and vectors of floor(scale * x) for the rows that take part."""
    x = F.col("embedding")
    sound = F.forall(x, lambda v: F.coalesce((v - v) == 0, F.lit(False)))
    vector = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")))
    usable = table.filter(x.isNotNull() & (F.size(x) > 0) & sound)
    # Squared as doubles before anything becomes a whole number, so that nothing overflows.
    scaled = F.transform(x, lambda v: F.lit(float(scale)) * v.cast("double"))
    squares = F.aggregate(scaled, F.lit(0.0), lambda total, v: total + (F.abs(v) + 1) * (F.abs(v) + 1))
    usable = usable.filter(squares < EXACT)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of equal width out of a list column, in doubles."""
    array = vectors.combine_chunks()
    array = pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array
    lengths = array.value_lengths().to_numpy().astype(np.int64)
    out = np.zeros((len(array), width))
    of = np.repeat(np.arange(len(array)), lengths)
    out[of, np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = array.flatten().to_numpy()
    return out


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> tuple[np.ndarray, int]:
    """The widest vector's width, and ``count`` rows by the lowest hash of their content: a bounded list."""
    width = vectors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()["width"]
    chosen = vectors.select("vector", F.xxhash64("vector").alias("hash")).orderBy("hash").limit(count)
    return matrix(pa.chunked_array([pa.array([row["vector"] for row in chosen.collect()], pa.list_(pa.int64()))]), width), width


def pivot_table(vectors: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """The stored table: a number of the row, id, vector and distance to every pivot."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(matrix(pa.chunked_array([batch["vector"]]), width), pivots)
            offsets = np.arange(len(far) + 1, dtype=np.int32) * far.shape[1]
            held = pa.ListArray.from_arrays(pa.array(offsets), pa.array(far.ravel()))
            yield pa.record_batch([*batch.columns, held], [*batch.schema.names, "distance"])

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")
    return store(rows.mapInArrow(add, "row long, vec_id long, vector array<long>, distance array<double>"), "pivots")


def best_of(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The k best: higher scores first, then earlier rows."""
    return np.lexsort((places, -scores))[:k]


def search_block(
    queries: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    rows: tuple[np.ndarray, np.ndarray, np.ndarray],
    k: int,
    unnamed: np.ndarray | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the places and scores of its best k among ``rows``, none below its known floor.

    Rows are in the order in which ties are settled; ``unnamed`` marks those without an id.
    """
    query_ids, query_vectors, query_distances, floors = queries
    ids, vectors, far = rows
    unnamed = np.zeros(len(ids), bool) if unnamed is None else unnamed
    norms, query_norms = (vectors**2).sum(1), (query_vectors**2).sum(1)
    for start in range(0, len(query_ids), STRIP_QUERIES):
        strip = slice(start, start + STRIP_QUERIES)
        bound = np.zeros((len(query_ids[strip]), len(ids)), dtype=np.float32)
        for p in range(far.shape[1]):
            apart = query_distances[strip, p, None].astype(np.float32) - far[None, :, p].astype(np.float32)
            np.maximum(bound, np.abs(apart, out=apart), out=bound)
        # More than single precision takes from the distances, so that limits are never too low.
        slack = (query_distances[strip].max(1, initial=0)[:, None] + far.max(1, initial=0)) * 2**-22 + 1e-2
        bound = np.maximum(bound.astype(np.float64) - slack, 0)
        limits = (query_norms[strip, None] + norms - bound**2) / 2
        for i in range(len(limits)):
            q = start + i
            open_ = np.flatnonzero((limits[i] >= floors[q]) & ((ids != query_ids[q]) | unnamed))
            order = open_[np.argsort(-limits[i, open_], kind="stable")]
            places, found = np.empty(0, np.int64), np.empty(0)
            for a in range(0, len(order), RUN):
                if len(found) == k and found[-1] > limits[i, order[a]]:
                    break
                run = order[a : a + RUN]
                scores = vectors[run] @ query_vectors[q]
                kept = scores >= floors[q]
                all_places, all_scores = np.append(places, run[kept]), np.append(found, scores[kept])
                best = best_of(all_places, all_scores, k)
                places, found = all_places[best], all_scores[best]
            yield q, places, found


def floors_of(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """The k-th score of each query among the first queries of its block: a floor for its k-th score."""
    floors = np.full(len(ids), -np.inf)
    seeds = vectors[:SEED_ROWS]
    if len(seeds) <= k:
        return floors
    for start in range(0, len(ids), STRIP_QUERIES):
        scores = vectors[start : start + STRIP_QUERIES] @ seeds.T
        scores[ids[start : start + STRIP_QUERIES, None] == ids[None, :SEED_ROWS]] = -np.inf
        floors[start : start + STRIP_QUERIES] = np.partition(scores, -k, axis=1)[:, -k]
    return floors


FOUND = "query_id long, query_hash long, vec_id long, score long"


def searched_tile(width: int, pivots: int, k: int):
    """Function of a block of queries and a chunk of rows: candidates for the best k of each query."""

    def search(block: pa.Table, chunk: pa.Table) -> pa.Table:
        out = [], [], [], []
        if len(block) and len(chunk):
            chunk = chunk.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # NULL ids last
            # Seeds are the first queries: in an order that does not hang on the shuffle.
            block = block.sort_by([("query_hash", "ascending"), ("vec_id", "ascending")])
            ids, hashes = block["vec_id"].to_numpy(), block["query_hash"].to_numpy()
            held = matrix(block["vector"], width)
            queries = ids, held, matrix(block["distance"], pivots), floors_of(ids, held, k)
            row_ids = chunk["vec_id"].fill_null(0).to_numpy()
            rows = row_ids, matrix(chunk["vector"], width), matrix(chunk["distance"], pivots)
            unnamed = chunk["vec_id"].is_null().to_numpy()
            for q, places, scores in search_block(queries, rows, k, unnamed):
                out[0].append(np.full(len(places), ids[q]))
                out[1].append(np.full(len(places), hashes[q]))
                out[2].append(places)
                out[3].append(scores.astype(np.int64))
        columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        named = chunk["vec_id"].combine_chunks().take(pa.array(columns[2])) if len(columns[2]) else pa.array([], pa.int64())
        return pa.table(
            {"query_id": columns[0], "query_hash": columns[1], "vec_id": named, "score": columns[3]},
            schema=pa.schema([(name, pa.int64()) for name in ("query_id", "query_hash", "vec_id", "score")]),
        )

    return search


def top_k(table: DataFrame, query_every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``k`` rows for each row whose id ``query_every`` divides."""
    vectors = integer_vectors(table, scale)
    pivots, width = choose_pivots(vectors)
    stored = pivot_table(vectors, pivots, width)
    asked = stored.filter(F.pmod("vec_id", F.lit(query_every)) == 0).withColumn("query_hash", F.xxhash64("vector"))
    queries = store(asked.dropDuplicates(["vec_id", "query_hash"]).drop("row"), "queries")
    blocks, chunks = (max(1, -(-rows.count() // most)) for rows, most in ((queries, BLOCK_QUERIES), (stored, CHUNK_ROWS)))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # The grid: a query goes to every chunk, a row to every block.
    block = F.pmod(F.xxhash64("vec_id", "query_hash"), F.lit(blocks)).cast("int").alias("block")
    dealt = queries.select(block, numbers(chunks).alias("chunk"), "vec_id", "query_hash", "vector", "distance")
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk")
    spread = stored.select(numbers(blocks).alias("block"), chunk, "row", "vec_id", "vector", "distance")
    grid = dealt.groupBy("block", "chunk").cogroup(spread.groupBy("block", "chunk"))
    found = grid.applyInArrow(searched_tile(width, len(pivots), k), FOUND)
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

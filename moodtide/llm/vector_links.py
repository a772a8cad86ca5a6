"""Near-duplicate vectors by an inverted multi-index.

1. Equal vectors are one class with a count: copies are never paired with each other.
2. Each half of the (unit) vectors has a codebook of its own, fitted on at most ``SAMPLE`` classes. A class stands in
   the cell (nearest code of its first half, nearest code of its second half) of the product grid; all are indexed.
3. Every class visits cells in the order of the multi-sequence algorithm, that is by the sum of both halves' squared
   distances to the codes, until the sum exceeds that of its own cell by the margin. The margin is the one at which
   ``RECALL`` of planted pairs at exactly the linking cosine (the farthest that link) are met from one side or the other;
   planted pairs are sample vectors and copies moved in random directions. Cells that no linked vector can lie in, by the
   triangle inequality and the cell's radius, are left out, which loses nothing.
4. In a cell, residents and visitors are compared in tiles of bounded size by the exact cosine in double precision. A
   tile returns counts of links, and a chain of labels instead of all pairs. A pair that meets in two cells counts in
   the later one. Crowded cells are dealt into tiles, resident chunks against visitor chunks, nothing is capped.
5. Labels become components by rounds of smallest labels and shortcuts; hubs are looked up by broadcast.

Recall against brute force is measured in the tests (1.0 on all test tables, at least 0.99 on pairs at the threshold).

Defined cases: vectors that are NULL, empty, zero or hold NULL, NaN or infinite components link with nothing; a shorter
vector counts as filled up with zeros; rows equal in vector are different vectors that link; rows without an id link
and count, but name no component: one of only such rows has a NULL component_id and all its rows are kept; equal ids
in different rows stay different rows; an empty table gives an empty result; other columns are ignored. Vectors equal
in 128 bits of hashes count as equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moodtide.llm.common import looked_up
from moodtide.storage import store

COSINE = 0.9
RECALL = 0.999
SAMPLE = 20_000
CELL_ROWS = 128
MOST_CODES = 512
LLOYD_STEPS = 8
RESIDENTS, VISITORS = 1024, 2048
SEED = 11


def vector_classes(table: DataFrame) -> DataFrame:
    """class, low (smallest id), n, vector: one row per different vector that takes part."""
    classes = keyed_vectors(table).filter("sound").groupBy("ha", "hb").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    return classes.select(F.monotonically_increasing_id().alias("class"), "ha", "hb", "low", "n", "vector")


def keyed_vectors(table: DataFrame) -> DataFrame:
    """vec_id, vector (-0 as 0), sound, and 128 bits of hashes of the vector."""
    x = F.transform("embedding", lambda v: v + F.lit(0).cast("float"))
    kind = dict(table.dtypes)["embedding"]
    sound = F.forall("vector", lambda v: F.coalesce((v - v) == 0, F.lit(False))) & F.exists("vector", lambda v: v != 0)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast(kind).alias("vector"))
    return rows.select(
        "vec_id",
        "vector",
        F.coalesce(sound, F.lit(False)).alias("sound"),
        F.xxhash64(F.lit(1), "vector").alias("ha"),
        F.xxhash64(F.lit(2), F.reverse("vector")).alias("hb"),
    )


def unit_rows(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of length 1 and even width, in doubles; scaled before squaring, so that no square overflows."""
    lengths = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), width))
    out[np.repeat(np.arange(len(vectors)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
        vectors.flatten().to_numpy()
    )
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def squared(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(1)[:, None] + (codes**2).sum(1) - 2 * rows @ codes.T, 0)


def fit_codes(rows: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm on a bounded sample."""
    codes = rows[rng.permutation(len(rows))[:count]]
    for _ in range(LLOYD_STEPS):
        nearest = squared(rows, codes).argmin(1)
        sizes = np.bincount(nearest, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, rows)
        codes = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], codes)
    return codes


class Grid:
    """Codebooks of both halves."""

    def __init__(self, first: np.ndarray, second: np.ndarray, margin: float = 0.0):
        self.codes, self.half, self.margin = (first, second), first.shape[1], margin

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(rows[:, : self.half], self.codes[0]), squared(rows[:, self.half :], self.codes[1])

    def excess(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """By how much the cell of ``others`` is farther from ``rows`` than their own."""
        one, two = self.distances(rows)
        there = [d.argmin(1) for d in self.distances(others)]
        at = np.arange(len(rows))
        return one[at, there[0]] + two[at, there[1]] - one.min(1) - two.min(1)

    def fit_margin(self, rows: np.ndarray, cosine: float, recall: float, rng: np.random.Generator) -> None:
        """The margin that ``recall`` of planted pairs at ``cosine`` need."""
        away = rng.standard_normal(rows.shape)
        away -= (away * rows).sum(1, keepdims=True) * rows
        away /= np.maximum(np.sqrt((away**2).sum(1, keepdims=True)), 1e-300)
        others = cosine * rows + np.sqrt(1 - cosine**2) * away
        needed = np.minimum(self.excess(rows, others), self.excess(others, rows))
        self.margin = float(np.quantile(needed, recall, method="higher")) + 1e-9

    def visits(self, rows: np.ndarray, radius: tuple[np.ndarray, np.ndarray], reach: float) -> Iterator[tuple[int, np.ndarray]]:
        """Own cell and visited cells, nearest first, of every row.

        Codes of both halves are sorted by distance; for each of the first half, those of the second are taken while the sum
        is within the limit: the same cells that the multi-sequence queue would give up to there.
        """
        one, two = self.distances(rows)
        k = len(self.codes[1])
        for a, b in zip(one, two, strict=True):
            first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            own = int(first[0]) * k + int(second[0])
            left = a[first[0]] + b[second[0]] + self.margin - a[first]
            first, taken = first[left >= b[second[0]]], np.searchsorted(b[second], left[left >= b[second[0]]], "right")
            i = np.repeat(first, taken)
            j = second[np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)]
            least = np.maximum(np.sqrt(a[i]) - radius[0][i], 0) ** 2 + np.maximum(np.sqrt(b[j]) - radius[1][j], 0) ** 2
            near = least <= reach
            order = np.argsort(a[i[near]] + b[j[near]], kind="stable")
            yield own, (i[near] * k + j[near])[order]


def fit_grid(classes: DataFrame, width: int, cosine: float, recall: float) -> Grid:
    """Codebooks and margin from a sample of at most ``SAMPLE`` classes by lowest hash."""
    n = classes.count()
    sample = classes.select("vector", "ha", "hb").orderBy("ha", "hb").limit(SAMPLE).select("vector").toArrow()
    rows = unit_rows(sample["vector"].combine_chunks(), width)
    rng = np.random.default_rng(SEED)
    count = int(min(max(round(np.sqrt(n / CELL_ROWS)), 1), MOST_CODES, len(rows)))
    half = width // 2
    grid = Grid(fit_codes(rows[:, :half], count, rng), fit_codes(rows[:, half:], count, rng))
    grid.fit_margin(rows, cosine, recall, rng)
    return grid


def cell_table(classes: DataFrame, parts: tuple, width: int) -> DataFrame:
    """class, n, vector, cell, and the distances of both halves to their codes: the index."""
    shipped = classes.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Grid(*shipped.value)
        for batch in batches:
            one, two = grid.distances(unit_rows(batch["vector"], width))
            i, j = one.argmin(1), two.argmin(1)
            far = np.sqrt(one.min(1)), np.sqrt(two.min(1))
            arrays = [*(batch[c] for c in ("class", "n", "vector")), pa.array(i), pa.array(j), pa.array(far[0]), pa.array(far[1])]
            yield pa.RecordBatch.from_arrays(arrays, names=["class", "n", "vector", "i", "j", "far1", "far2"])

    kind = dict(classes.dtypes)["vector"]
    rows = classes.select("class", "n", "vector")
    return rows.mapInArrow(run, f"class long, n long, vector {kind}, i long, j long, far1 double, far2 double")


def with_visits(indexed: DataFrame, parts: tuple, width: int, cosine: float) -> DataFrame:
    """class, n, vector, cell (own), visited (other cells, sorted)."""
    spark, count = indexed.sparkSession, len(parts[0])
    # One row per code, at most MOST_CODES of each half.
    radius = [np.zeros(count), np.zeros(len(parts[1]))]
    for side, (code, far) in enumerate((("i", "far1"), ("j", "far2"))):
        for row in indexed.groupBy(code).agg(F.max(far).alias("far")).collect():
            radius[side][row[code]] = row["far"] * (1 + 1e-9) + 1e-9
    shipped = spark.sparkContext.broadcast((parts, tuple(radius)))
    reach = 2 - 2 * cosine + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, radius = shipped.value
        grid = Grid(*parts)
        for batch in batches:
            own, visited = [], []
            for cell, cells in grid.visits(unit_rows(batch["vector"], width), radius, reach):
                own.append(cell)
                visited.append(np.sort(cells[cells != cell]).astype(np.int64))
            arrays = [*(batch[c] for c in ("class", "n", "vector")), pa.array(own, pa.int64()), pa.array(visited, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["class", "n", "vector", "cell", "visited"])

    kind = dict(indexed.dtypes)["vector"]
    rows = indexed.select("class", "n", "vector")
    return rows.mapInArrow(run, f"class long, n long, vector {kind}, cell long, visited array<long>")


def tiles(visiting: DataFrame) -> DataFrame:
    """Rows dealt to tiles: cell, chunk (of residents), part (of visitors), resident, and the class's columns.

    Residents of a cell are cut into chunks, visitors into parts; a resident also visits the later chunks of its own cell.
    The sizes that decide this are one row per cell, at most ``MOST_CODES`` squared.
    """
    held = visiting.groupBy("cell").agg(F.count("*").alias("held"))
    coming = visiting.select(F.explode("visited").alias("cell")).groupBy("cell").agg(F.count("*").alias("coming"))
    chunks, parts = F.ceil(F.col("held") / RESIDENTS), F.ceil((F.coalesce("coming", F.lit(0)) + F.col("held")) / VISITORS)
    sizes = store(held.join(coming, "cell", "left").select("cell", chunks.alias("chunks"), parts.alias("parts")), "cell_sizes")
    sizes = F.broadcast(sizes)
    body = ["class", "n", "vector", F.col("cell").alias("own"), "visited"]
    deal = F.xxhash64("class")
    zero = F.lit(0).cast("long")
    residents = visiting.join(sizes, "cell").select(
        "cell", F.pmod(deal, "chunks").alias("chunk"), F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("resident"), *body,
    )
    calls = visiting.select(F.explode("visited").alias("at"), *body[:3], "cell", "visited")
    there = sizes.withColumnRenamed("cell", "at")
    visitors = calls.join(there, "at").select(
        F.col("at").alias("cell"), F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("chunk"),
        F.pmod(deal, "parts").alias("part"), F.lit(False).alias("resident"), *body,
    )
    later = visiting.join(sizes, "cell").filter("chunks > 1 AND pmod(xxhash64(class), chunks) + 1 < chunks")
    across = later.select(
        "cell", F.explode(F.sequence(F.pmod(deal, "chunks") + 1, F.col("chunks") - 1)).alias("chunk"),
        F.pmod(deal, "parts").alias("part"), F.lit(False).alias("resident"), *body,
    )
    return residents.unionByName(visitors).unionByName(across)


def local_labels(linked: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The smallest class that each row reaches through the links of a tile (rows x columns)."""
    rows, columns = linked.shape
    label_r, label_c = classes[:rows].copy(), classes[rows:].copy()
    i, j = np.nonzero(linked)
    while True:
        before = label_r.sum(), label_c.sum()
        np.minimum.at(label_c, j, label_r[i])
        np.minimum.at(label_r, i, label_c[j])
        if before == (label_r.sum(), label_c.sum()):
            return np.concatenate([label_r, label_c])


LINKS = "class long, links long, label long"


def compare_tile(tile: pa.Table, width: int, cosine: float) -> pa.Table:
    """Per class of the tile the number of other vectors it links with here, and the label it reaches."""
    at = tile["resident"].to_numpy()
    here, there = tile.filter(pa.array(at)), tile.filter(pa.array(~at))
    cell, part = tile["cell"][0].as_py(), tile["part"][0].as_py()
    classes = [t["class"].to_numpy() for t in (here, there)]
    counts = [t["n"].to_numpy() for t in (here, there)]
    rows = [unit_rows(t["vector"].combine_chunks(), width) if t.num_rows else np.zeros((0, width)) for t in (here, there)]
    out = []

    def tell(linked, left, right, n_left, n_right):
        i, j = linked.any(1), linked.any(0)
        labels = local_labels(linked, np.concatenate([left, right]))
        sums = linked @ n_right, n_left @ linked
        for some, keys, total, label in ((i, left, sums[0], labels[: len(left)]), (j, right, sums[1], labels[len(left) :])):
            out.append((keys[some], total[some], label[some]))

    if part == 0:
        linked = np.triu(rows[0] @ rows[0].T >= cosine, 1)
        tell(linked, classes[0], classes[0], counts[0], counts[0])
    if there.num_rows and here.num_rows:
        linked = rows[0] @ rows[1].T >= cosine
        # Both visit each other: the pair counts in the later cell.
        own = there["own"].to_numpy()
        cells, which = np.unique(own, return_inverse=True)
        seen = np.zeros((here.num_rows, len(cells)), bool)
        visited = here["visited"].combine_chunks()
        flat, lengths = visited.flatten().to_numpy(), visited.value_lengths().to_numpy()
        place = np.minimum(np.searchsorted(cells, flat), len(cells) - 1)
        hit = cells[place] == flat
        seen[np.repeat(np.arange(here.num_rows), lengths)[hit], place[hit]] = True
        linked &= ~(seen[:, which] & (own > cell)[None, :])
        tell(linked, classes[0], classes[1], counts[0], counts[1])
    columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in range(3)]
    return pa.table({name: pa.array(c.astype(np.int64)) for name, c in zip(("class", "links", "label"), columns, strict=True)})


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``edges`` (class, label) reaches.

    Rounds of telling neighbours the smallest label and of shortcuts; each is a written table.
    """
    pairs = edges.filter("class <> label").select(F.col("class").alias("node"), F.col("label").alias("other")).distinct()
    both = store(pairs.union(pairs.select("other", "node")).distinct(), "label_links")
    labels = store(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    last = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("total")).first()["total"]
        if total == last:
            return labels
        last = total
        held = labels.select(F.col("node").alias("other"), F.col("label").alias("near"))
        near = looked_up(both, ["other"], held).groupBy("node").agg(F.min("near").alias("near"))
        nearer = labels.join(near, "node").select("node", F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        short = looked_up(nearer, ["label"], far)
        labels = store(short.select("node", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")


def vector_links(table: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``table`` (vec_id, embedding)."""
    classes = store(vector_classes(table), "vector_classes")
    width = classes.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width")).first()["width"]
    keyed = keyed_vectors(table)
    if width == 0:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = max(2, width + width % 2)
    grid = fit_grid(classes, width, cosine, recall)
    parts = (*grid.codes, grid.margin)
    indexed = store(cell_table(classes, parts, width), "multi_index")
    visiting = store(with_visits(indexed, parts, width, cosine), "visits")

    compare = lambda tile: compare_tile(tile, width, cosine)
    found = store(tiles(visiting).groupBy("cell", "chunk", "part").applyInArrow(compare, LINKS), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    reached = smallest_reachable(found).withColumnRenamed("node", "class")
    named = classes.join(links, "class", "left").join(reached, "class", "left").select(
        "ha", "hb", "low", F.coalesce("label", "class").alias("label"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    named = store(named, "linked_classes").filter("n_links > 0")
    lows = named.groupBy("label").agg(F.min("low").alias("component_id"))
    known = looked_up(named, ["label"], lows).select("ha", "hb", "n_links", "component_id")
    rows = keyed.select("vec_id", F.when(F.col("sound"), F.col("ha")).alias("ha"), F.when(F.col("sound"), F.col("hb")).alias("hb"))
    joined = looked_up(rows, ["ha", "hb"], store(known, "known_links"))
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )

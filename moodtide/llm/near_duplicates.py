"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

Two texts are linked when the weighted Jaccard similarity of their five-word shingles is at least
0.8 (sum of the smaller weights over sum of the larger ones); groups are the connected parts of the
links. A shingle weighs

    tf * idf,   idf = 1 + ln((1 + N) / (1 + df)) / ln(1 + N)

with tf its occurrences in the text, df the documents that hold it and N all documents. The idf lies
between 1 and 2, so a passage that thousands share weighs little more than half of a unique one.
df counts exact copies too: a hot text's shingles lose weight against those that a variant changed.
By the formula at N = 100,000, a pair with 86 shingles shared and 10 different on each side has
similarity 0.808 alone, 0.783 with 1,000 copies of one text and 0.756 with 33,000, and is then not linked.

1. Document frequencies. Documents are dealt into chunks of bounded size, copies of one text into
   many. A chunk sends each of its distinct shingles once, with its count, to the partition of the
   shingle's hash; the partition adds up and answers with those that two or more documents hold.
   So a shingle of every document costs one entry per chunk.
2. Samples. A consistent weighted sample of a text is the shingle with the smallest a = c e^-r / y,
   where y = e^(r (t - b)), t = floor(ln(weight) / r + b), and r, c ~ Gamma(2, 1), b ~ U(0, 1) are
   drawn by the shingle's hash out of tables of random numbers; equal values go to the lower hash.
   Two texts draw the same (shingle, t) with the probability of their similarity. ``ROWS`` samples
   form a band; texts that share a band are candidates. At similarity 0.8 a pair is missed with
   probability (1 - 0.8^ROWS)^BANDS, 0.2 %.
3. Links. Every bucket first compares all its texts with one of them, the one found in the most
   company. What that connects needs no further test. Then all candidate pairs that are still
   unconnected are compared: pair by pair in buckets of up to ``SMALL`` texts, block by block in
   larger ones. There, similarity to the bucket's first text tells blocks apart: 1 - similarity is a
   metric, so blocks whose distances to it differ by more than 0.2 hold no link.

Equal texts are one text from the start (one class, by a 64-bit hash); a shingle only one document
holds is in no other text, so texts are compared by their other shingles and their total weight.

Defined cases: NULL is an empty text; texts without words group with equal texts only; a text of one
to four words has itself as its one shingle; ties go to the smaller id; repeated rows share a group;
NULL ids come after all others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from moodtide.llm.common import SHINGLE_WORDS, measured_bytes, packed, row_key, text_of, without_rows, words
from moodtide.storage import store

SIMILARITY = 0.8
BANDS, ROWS = 12, 4
TABLE_BITS = 16
SEED = 20240229
# Characters of text per chunk, and per partition of shingle hashes.
CHUNK_CHARS = 3_000_000
PART_CHARS = 10_000_000
LOW_BITS = 40
SMALL = 24
BLOCK_ROWS = 64
BIN = 0.05
BROADCAST_BYTES = 32 * 1024 * 1024
TILE = 4_096

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def list_parts(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    offsets = array.offsets.to_numpy().astype(np.int64)
    return array.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingle_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every shingle, from word hashes."""
    factors = mixed(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)
    word = mixed(flat.view(np.uint32).astype(np.uint64))
    sums = np.zeros(len(word), np.uint64)
    for k in range(SHINGLE_WORDS):
        sums[: len(word) - k] += word[k:] * factors[k]
    lengths, starts = np.diff(offsets), offsets[:-1]
    for n in range(1, SHINGLE_WORDS):
        at = starts[lengths == n]
        sums[at] = sum((word[at + k] * factors[k] for k in range(n)), np.uint64(n))
    counts = np.where(lengths >= SHINGLE_WORDS, lengths - SHINGLE_WORDS + 1, lengths > 0)
    ends = np.cumsum(counts)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)
    return mixed(sums[at]), np.repeat(np.arange(len(counts), dtype=np.uint32), counts)


def document_shingles(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hash, document) in order of hash, with occurrences."""
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    return h[at], doc[at], np.diff(at, append=len(h))


def places_of(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition and remaining bits of a hash, which together stand for the shingle."""
    return (h >> np.uint64(LOW_BITS)) % np.uint64(parts), h & np.uint64(2**LOW_BITS - 1)


def pack(low: np.ndarray) -> bytes:
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8].tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // LOW_BITS, 8), np.uint8)
    wide[:, : LOW_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, LOW_BITS // 8)
    return wide.view("<u8").ravel()


def runs_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    first = np.ones(len(sorted_values), bool)
    first[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(first)


SENT = "part long, chunk long, keys binary, counts binary"
ANSWER = "chunk long, part long, keys binary, counts binary"


def counted_shingles(parts: int):
    """Function of a chunk: its distinct shingles and their documents, by partition."""

    def send(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        h, doc, _ = document_shingles(*shingle_hashes(*list_parts(table["words"])))
        at = runs_of(h)
        part, low = places_of(h[at], parts)
        counts = np.diff(at, append=len(h)).astype("<u4")
        order = np.argsort(part, kind="stable")
        part, low, counts = part[order], low[order], counts[order]
        cuts = np.append(runs_of(part), len(part))
        rows = [(int(part[a]), chunk, pack(low[a:b]), counts_bytes(counts[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
        return arrow_rows(rows, ("part", "chunk", "keys", "counts"))

    return send


def counts_bytes(counts: np.ndarray) -> bytes:
    """Only the counts above one, as (place, count)."""
    many = np.flatnonzero(counts > 1)
    return np.stack((many, counts[many]), axis=1).astype("<u4").tobytes()


def counts_from(data: bytes, n: int) -> np.ndarray:
    counts = np.ones(n, np.int64)
    many = np.frombuffer(data, "<u4").reshape(-1, 2).astype(np.int64)
    counts[many[:, 0]] = many[:, 1]
    return counts


def arrow_rows(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    kinds = [pa.int64() if name in ("part", "chunk") else pa.binary() for name in names]
    return pa.table({name: pa.array(list(c), kind) for name, c, kind in zip(names, columns, kinds, strict=True)})


def added_counts(table: pa.Table) -> pa.Table:
    """Function of a partition: for every chunk those of its shingles that two or more documents hold."""
    rows = table.to_pylist()
    keys = [unpack(row["keys"]) for row in rows]
    sizes = [len(k) for k in keys]
    counts = np.concatenate([counts_from(row["counts"], n) for row, n in zip(rows, sizes, strict=True)])
    source = np.repeat(np.arange(len(rows), dtype=np.uint32), sizes)
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys, source, counts = keys[order], source[order], counts[order]
    at = runs_of(keys)
    total = np.add.reduceat(counts, at) if len(at) else counts
    total = np.repeat(total, np.diff(at, append=len(keys)))
    held = np.flatnonzero(total >= 2)
    held = held[np.argsort(source[held], kind="stable")]
    keys, source, total = keys[held], source[held], total[held].astype("<u8")
    cuts = np.append(runs_of(source), len(source))
    out = [
        (rows[source[a]]["chunk"], rows[source[a]]["part"], pack(keys[a:b]), total[a:b].tobytes())
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    return arrow_rows(out, ("chunk", "part", "keys", "counts"))


class Sampler:
    """Consistent weighted samples by tables of random numbers, one set per sample."""

    def __init__(self, plain_weight: float, samples: int = BANDS * ROWS):
        rng = np.random.default_rng(SEED)
        shape = samples, 2**TABLE_BITS
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.b = rng.random(shape, dtype=np.float32)
        self.factors = rng.integers(1, 2**63, samples, dtype=np.uint64) | np.uint64(1)
        self.plain = [self.value(i, slice(None), np.float32(np.log(plain_weight))) for i in range(samples)]

    def value(self, i: int, at, log_weight) -> tuple[np.ndarray, np.ndarray]:
        """ln(a) and t for entries ``at`` of table ``i``."""
        r, b = self.r[i][at], self.b[i][at]
        t = np.floor(log_weight / r + b)
        return self.log_c[i][at] - r * (t - b + 1), t

    def samples(self, h, starts, special, log_weight) -> np.ndarray:
        """(documents x samples) from shingles by document; ``special`` are those of another weight."""
        out = np.empty((len(starts), len(self.factors)), np.uint64)
        lengths = np.diff(starts, append=len(h))
        for i, factor in enumerate(self.factors):
            at = ((h * factor) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
            plain, t_plain = self.plain[i]
            a = plain[at]
            a[special], t_special = self.value(i, at[special], log_weight)
            least = np.minimum.reduceat(a, starts)
            tied = np.flatnonzero(a == np.repeat(least, lengths))
            of = np.searchsorted(starts, tied, side="right") - 1
            order = np.lexsort((h[tied], of))
            won = tied[order][runs_of(of[order])]
            t = t_plain[at[won]]
            where = np.searchsorted(special, won)
            where[where == len(special)] = 0
            if len(special):
                changed = special[where] == won
                t[changed] = t_special[where[changed]]
            out[:, i] = mixed(h[won] + t.astype(np.int64).astype(np.uint64) * MIX_A)
        return out


SIGNED = "class long, total double, keys binary, weights binary, bands array<long>"


def idf(df: np.ndarray, documents: int) -> np.ndarray:
    return 1 + np.log((1 + documents) / (1 + df)) / np.log(1 + documents)


def signed_texts(parts: int, documents: int):
    """Function of a chunk and its answers: weights, samples and bands of its distinct texts."""
    held: list[Sampler] = []

    def sign(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not held:
            held.append(Sampler(float(idf(np.array(1), documents))))
        flat, offsets = list_parts(table["words"])
        classes, first = np.unique(table["class"].to_numpy(), return_index=True)
        h, doc, tf = document_shingles(*shingle_hashes(flat, offsets))
        once = np.zeros(len(offsets) - 1, bool)
        once[first] = True
        kept = once[doc]
        h, doc, tf = h[kept], doc[kept], tf[kept]
        part, low = places_of(h, parts)
        asked = (part << np.uint64(LOW_BITS)) | low
        df = np.ones(len(h), np.int64)
        if len(answers):
            told = answers.to_pylist()
            known = np.concatenate([unpack(r["keys"]) | np.uint64(r["part"] << LOW_BITS) for r in told])
            found = np.concatenate([np.frombuffer(r["counts"], "<u8") for r in told]).astype(np.int64)
            order = np.argsort(known)
            known, found = known[order], found[order]
            at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[at] == asked
            df[hit] = found[at[hit]]
        weight = (tf * idf(df, documents)).astype(np.float32)
        order = np.argsort(doc, kind="stable")
        h, doc, df, tf, weight, asked = (x[order] for x in (h, doc, df, tf, weight, asked))
        starts = runs_of(doc)
        if not len(starts):
            return signed_rows([])
        special = np.flatnonzero((df > 1) | (tf > 1))
        samples = held[0].samples(h, starts, special, np.log(weight[special]))
        factors = mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        rows, ends = [], np.append(starts[1:], len(h))
        number = dict(zip(first.tolist(), classes.tolist(), strict=True))
        bands = np.stack(
            [mixed((samples[:, b * ROWS : (b + 1) * ROWS] * factors).sum(1, dtype=np.uint64) + np.uint64(b)) for b in range(BANDS)],
            axis=1,
        ).view(np.int64)
        totals = np.add.reduceat(weight.astype(np.float64), starts)
        for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
            shared = df[a:b] > 1
            rows.append((number[int(doc[a])], totals[i], asked[a:b][shared].tobytes(), weight[a:b][shared].tobytes(), bands[i]))
        return signed_rows(rows)

    return sign


def signed_rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = (pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    names = ("class", "total", "keys", "weights", "bands")
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two texts (total, keys, weights), keys without repetition."""
    _, i, j = np.intersect1d(a[1], b[1], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[2][i], b[2][j]).sum(dtype=np.float64))
    return both / (a[0] + b[0] - both)


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of candidate pairs, with the weights of both joined to them."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            held = [
                (row.total, np.frombuffer(row.keys, np.uint64), np.frombuffer(row.weights, np.float32),
                 row.total_b, np.frombuffer(row.keys_b, np.uint64), np.frombuffer(row.weights_b, np.float32))
                for row in part.itertuples()
            ]
            found = [similarity(row[:3], row[3:]) for row in held]
            yield pd.DataFrame({"a": part["a"], "b": part["b"], "similarity": found})

    left = texts.select(F.col("class").alias("a"), "total", "keys", "weights")
    right = texts.select(
        F.col("class").alias("b"), F.col("total").alias("total_b"), F.col("keys").alias("keys_b"), F.col("weights").alias("weights_b")
    )
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInPandas(run, "a long, b long, similarity double")


def small_broadcast(df: DataFrame, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if measured_bytes(df, F.lit(row_bytes)) <= BROADCAST_BYTES else df


def connected(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of each connected part. Labels move along links and are then
    replaced by the label of their label, so that the number of rounds grows with the logarithm of
    the longest path; every round is a written table."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = store(both.union(both.select("other", "node")).distinct(), "links")
    labels = store(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    last = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)")).alias("total")).first()["total"]
        if total == last:
            return labels
        last = total
        told = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        nearer = labels.join(told, "node").select("node", F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = store(
            nearer.join(jump, "label", "left").select("node", F.least("label", F.coalesce("far", "label")).alias("label")), "labels"
        )


def buckets(signed: DataFrame) -> DataFrame:
    """bucket, class: texts that share a band with another text."""
    every = signed.select("class", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    return every.join(shared.select("bucket"), "bucket").distinct()


def first_texts(members: DataFrame) -> DataFrame:
    """bucket, first, n: the text of each bucket whose buckets are the largest together."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"))
    company = members.join(sizes, "bucket").groupBy("class").agg(F.sum("n").alias("company"))
    chosen = F.max(F.struct("company", "class"))["class"].alias("first")
    return members.join(company, "class").groupBy("bucket").agg(chosen, F.count("*").alias("n"))


def open_members(members: DataFrame, firsts: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """bucket, n, class, label, near (similarity to the bucket's first text) of buckets in several parts."""
    known = tested.select(F.col("a").alias("first"), F.col("b").alias("class"), "similarity")
    placed = members.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "label", F.coalesce("label", "class")
    )
    parted = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    opened = placed.join(parted.select("bucket"), "bucket").join(firsts, "bucket")
    near = F.when(F.col("class") == F.col("first"), 1.0).otherwise(F.col("similarity"))
    return opened.join(known, ["first", "class"], "left").select("bucket", "n", "class", "label", near.alias("near"))


def small_pairs(opened: DataFrame, tested: DataFrame, limit: float) -> DataFrame:
    """All pairs of different parts within small buckets that were not compared yet."""
    rows = opened.filter(F.col("n") <= SMALL)
    left = rows.select("bucket", F.col("class").alias("a"), F.col("label").alias("label_a"), F.col("near").alias("near_a"))
    right = rows.select("bucket", F.col("class").alias("b"), F.col("label").alias("label_b"), F.col("near").alias("near_b"))
    may_link = F.abs(F.col("near_a") - F.col("near_b")) <= 1 - limit + 1e-6
    pairs = left.join(right, "bucket").filter((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & may_link)
    done = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.select("a", "b").distinct().join(done, ["a", "b"], "left_anti")


def block_links(opened: DataFrame, texts: DataFrame, limit: float) -> DataFrame:
    """Links between different parts within large buckets, compared block by block.

    A block holds texts of about the same similarity to the bucket's first text, of one part where
    the part is large. Blocks of one part, and blocks too far apart to hold a link, are not compared.
    """
    rows = opened.filter(F.col("n") > SMALL)
    large = rows.groupBy("bucket", "label").agg(F.count("*").alias("held")).filter(F.col("held") >= BLOCK_ROWS)
    step = F.floor(F.col("near") / BIN).cast("int")
    rows = rows.join(large, ["bucket", "label"], "left").select(
        "bucket", "class", "label", F.when(F.col("held").isNotNull(), F.col("label")).alias("part"), step.alias("step")
    )
    shelf = F.struct("part", "step")
    counts = rows.groupBy("bucket", shelf.alias("shelf")).agg(F.count("*").alias("held"))
    cut = F.ceil(F.col("held") / BLOCK_ROWS)
    cuts = counts.select(F.col("bucket").alias("in_bucket"), F.col("shelf").alias("of"), cut.alias("cut"))
    inside = F.col("of").eqNullSafe(F.col("shelf")) & (F.col("in_bucket") == F.col("bucket"))
    block = F.xxhash64("part", "step", F.pmod(F.xxhash64("class"), F.col("cut"))).alias("block")
    named = rows.withColumn("shelf", shelf).join(cuts, inside).select("bucket", "class", "label", "part", "step", block)
    named = store(named, "open_blocks")
    packed = named.join(texts, "class").groupBy("bucket", "block", "part", "step").agg(
        F.collect_list(F.struct("class", "label", "total", "keys", "weights")).alias("texts")
    )
    packed = store(packed, "packed_blocks")
    heads = packed.select("bucket", "block", "part", "step")
    others = heads.select("bucket", F.col("block").alias("block_b"), F.col("part").alias("part_b"), F.col("step").alias("step_b"))
    apart = (F.abs(F.col("step") - F.col("step_b")) - 1) * BIN > 1 - limit + 1e-6
    same = F.coalesce(F.col("part") == F.col("part_b"), F.lit(False))
    pairs = heads.join(others, "bucket").filter((F.col("block") <= F.col("block_b")) & ~apart & ~same)
    joined = (
        pairs.select("bucket", "block", "block_b")
        .join(packed.select("bucket", "block", "texts"), ["bucket", "block"])
        .join(packed.select("bucket", F.col("block").alias("block_b"), F.col("texts").alias("texts_b")), ["bucket", "block_b"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                a, b, found = compare_blocks(row["texts"], row["texts_b"], limit)
                arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(found, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "similarity"])

    return joined.select("texts", "texts_b").mapInArrow(run, "a long, b long, similarity double")


def compare_blocks(left: list[dict], right: list[dict], limit: float) -> tuple[list, list, list]:
    """Links between texts of different parts. Weights are cut into levels, so that the sum of smaller
    weights is a sum of products: one matrix product per tile of shingles and level."""

    def parts(texts):
        keys = [np.frombuffer(t["keys"], np.uint64) for t in texts]
        weights = [np.frombuffer(t["weights"], np.float32) for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(k) for k in keys])
        return np.concatenate(keys), np.concatenate(weights).astype(np.float64), of, np.array([t["total"] for t in texts])

    (ka, wa, ia, ta), (kb, wb, ib, tb) = parts(left), parts(right)
    common = np.intersect1d(ka, kb)
    both = np.zeros((len(left), len(right)))
    for start in range(0, len(common), TILE):
        tile = common[start : start + TILE]
        dense = []
        for keys, weights, of, n in ((ka, wa, ia, len(left)), (kb, wb, ib, len(right))):
            at = np.minimum(np.searchsorted(tile, keys), len(tile) - 1)
            hit = tile[at] == keys
            matrix = np.zeros((n, len(tile)))
            matrix[of[hit], at[hit]] = weights[hit]
            dense.append(matrix)
        x, y = dense
        # Most shingles weigh the same wherever they occur: a product of 0/1 matrices. The others one by one.
        top = np.maximum(x.max(0), y.max(0))
        even = ((x == 0) | (x == top)).all(0) & ((y == 0) | (y == top)).all(0)
        both += ((x[:, even] > 0) * top[even]) @ (y[:, even] > 0).T.astype(np.float64)
        for column in np.flatnonzero(~even):
            both += np.minimum(x[:, column, None], y[None, :, column])
    found = both / (ta[:, None] + tb[None, :] - both)
    label_a, label_b = (np.array([t["label"] for t in texts]) for texts in (left, right))
    class_a, class_b = (np.array([t["class"] for t in texts]) for texts in (left, right))
    i, j = np.nonzero((found >= limit) & (label_a[:, None] != label_b[None, :]))
    return class_a[i].tolist(), class_b[j].tolist(), found[i, j].tolist()


def signed_table(documents: DataFrame) -> DataFrame:
    """class, total, keys, weights, bands of the texts: see the steps 1 and 2 above."""
    measured = documents.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n, chars = measured["n"], measured["chars"]
    chunks, parts = max(1, -(-chars // CHUNK_CHARS)), max(1, -(-chars // PART_CHARS))
    hashes = F.transform(words(text_of("text")), lambda w: F.hash(w)).alias("words")
    rows = documents.select(row_key().alias("class"), hashes, F.xxhash64("doc_id", row_key()).alias("deal"))
    dealt = rows.select(F.pmod("deal", F.lit(chunks)).alias("chunk"), "class", "words").repartition("chunk")
    sent = dealt.groupBy("chunk").applyInArrow(counted_shingles(parts), SENT)
    answers = sent.groupBy("part").applyInArrow(added_counts, ANSWER)
    signed = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(signed_texts(parts, max(n, 1)), SIGNED)
    return store(signed, "signed_texts")


def text_labels(documents: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """node (class of a text), label: for all texts that are linked to a different text."""
    if limit < SIMILARITY:
        raise ValueError(f"bands find pairs from similarity {SIMILARITY} on, not from {limit}")
    signed = signed_table(documents)
    members = store(buckets(signed), "buckets")
    grouped = members.select("class").distinct()
    payload = signed.select("class", "total", "keys", "weights").join(small_broadcast(store(grouped, "candidates"), 16), "class")
    texts = store(payload.dropDuplicates(["class"]), "candidate_texts")
    firsts = store(first_texts(members), "first_texts")
    stars = members.join(firsts, "bucket").filter(F.col("class") != F.col("first"))
    pairs = stars.select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    tested = store(compare(pairs, texts), "first_pairs")
    links = tested.filter(F.col("similarity") >= limit).select("a", "b")
    labels = connected(links)
    opened = store(open_members(members, firsts, labels, tested), "open_buckets")
    more = compare(small_pairs(opened, tested, limit), texts).filter(F.col("similarity") >= limit)
    blocks = block_links(opened, texts, limit)
    added = store(more.union(blocks).select("a", "b").distinct(), "more_links")
    return labels if added.isEmpty() else connected(links.union(added))


def near_duplicate_groups(documents: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """doc_id, _row (hash of the text), class_id (smallest id of the group), group_rows: one row per document."""
    labels = text_labels(documents.select("doc_id", "text"), limit).withColumnRenamed("node", "_row")
    rows = documents.select("doc_id", row_key().alias("_row")).join(small_broadcast(labels, 24), "_row", "left")
    rows = store(rows.select("doc_id", "_row", F.coalesce("label", "_row").alias("_group")), "grouped_rows")
    groups = rows.groupBy("_group").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("group_rows"))
    many = groups.filter("group_rows > 1").select("_group", "class_id", "group_rows")
    joined = rows.join(small_broadcast(store(many, "groups"), 32), "_group", "left")
    return joined.select(
        "doc_id",
        "_row",
        F.when(F.col("group_rows").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("group_rows", F.lit(1).cast("long")).alias("group_rows"),
    )


def one_of_each_group(documents: DataFrame, limit: float = SIMILARITY) -> DataFrame:
    """The documents without near duplicates: of every group the row of the smallest id, then text hash, once.

    The rows to drop are joined out, so that the texts that stay are not shuffled where those are few.
    """
    labels = text_labels(documents.select("doc_id", "text"), limit).withColumnRenamed("node", "_row")
    rows = documents.select("doc_id", row_key().alias("_row")).join(small_broadcast(labels, 24), "_row", "left")
    keyed = rows.groupBy("doc_id", "_row").agg(F.first(F.coalesce("label", "_row")).alias("_group"), F.count("*").alias("n"))
    keyed = store(keyed, "grouped_keys")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
    first = keyed.groupBy("_group").agg(F.min(order).alias("first"), F.count("*").alias("keys")).filter("keys > 1")
    first = store(first.select("_group", "first"), "first_keys")
    other = ~F.struct("doc_id", "_row").eqNullSafe(F.struct("first.doc_id", "first._row"))
    dropped = store(keyed.join(small_broadcast(first, 40), "_group").filter(other).select("doc_id", "_row"), "dropped_rows")
    repeated = store(keyed.filter("n > 1").select("doc_id", "_row"), "repeated_rows")

    kept = without_rows(documents, dropped)
    if repeated.isEmpty():
        return kept
    # Of rows equal in id and text, one each.
    named = small_broadcast(repeated.select(F.col("doc_id").alias("_id"), F.col("_row").alias("_hash")), 32)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    once = packed(kept).join(named, same, "left_semi").dropDuplicates(["doc_id", "_row"]).select("_document.*")
    return without_rows(kept, repeated).unionByName(once)

"""Token-id files: one concatenated id array per shard, document boundaries as an Elias-Fano list.

A shard file is

    magic | header (8 unsigned 64-bit numbers) | low bits | high bits | select samples | ids

The boundary of document i (ids before the end of document i) is split: ``low_bits`` lower bits are
packed, the rest is written in unary into a bit vector, one set bit per document. That takes
``low_bits + 2`` bits per document, whatever the size of the shard. ``select(i)`` finds the i-th set
bit from a 32-bit sample every 256 set bits, so no table of 64-bit offsets exists. Ids are unsigned
16-bit numbers where the vocabulary allows it, else 32-bit ones, little-endian.

Tasks write shards of bounded size under names of their own and return them; Spark writes the list
of returned names as the manifest. A file left by a lost or repeated task is in no manifest and is
never read. Shards come in ascending order of document id.

Defined cases: NULL texts are empty (the end id alone); NULL ids come first; rows with one id are
ordered by a hash of their text; repeated rows are documents of their own; an empty table gives an
empty manifest; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from moodtide.llm.common import bounded_slices, row_key, store_texts, text_of
from moodtide.storage import scratch_path

MAGIC = b"MTOKENS1"
HEADER = "<8Q"
SELECT_EVERY = 256
# A shard ends with the document that brings it to so many ids.
SHARD_IDS = 2_000_000
# Ids that one task reads back, several shards.
TASK_IDS = 8_000_000
SLICE_BYTES = 4_000_000
# Distinct pieces that a task remembers.
KNOWN_PIECES = 2_000_000

# Two white-space characters next to each other: cutting there could part a token. Nor may a text begin
# with another white-space character than the space or the line break.
ODD_SPACES = r"\t\f\r\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = r" \n" + ODD_SPACES
UNCUT = rf"^[{ODD_SPACES}]|[{SPACES}][{SPACES}]"


# The printable bytes that byte-level vocabularies write as themselves. The others, in
# order, are written as the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PRINTABLE]
BYTE_SIGNS = {byte: chr(256 + i) for i, byte in enumerate(OTHERS)}
SPACE_SIGN = BYTE_SIGNS[ord(" ")]


def byte_signs(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_SIGNS)


class Names:
    """A growing list of distinct strings with a place for each. Short ones are held as numbers: looked up by a
    hash of their bytes and compared whole. Longer ones, and the second of two with one hash, stand in a dictionary."""

    WIDTH = 16

    def __init__(self):
        self.count, self.others = 0, {}
        self.hashes, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.bytes, self.lengths = np.empty((0, 2), np.uint64), np.empty(0, np.int64)

    def numbers(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bytes as two numbers, length, and hash of each name."""
        offsets = np.frombuffer(names.buffers()[1], np.int32)[names.offset : names.offset + len(names) + 1]
        data = np.frombuffer(names.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        data, lengths = np.append(data, np.zeros(self.WIDTH, np.uint8)), np.diff(offsets).astype(np.int64)
        place = np.arange(self.WIDTH)
        held = data[offsets[:-1, None] + place]
        held[place >= lengths[:, None]] = 0
        pair = held.view(np.uint64)
        mixed = pair[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ (pair[:, 1] + lengths.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return pair, lengths, mixed ^ (mixed >> np.uint64(29))

    def find(self, names: pa.Array) -> np.ndarray:
        """Place of each name, -1 where it is unknown."""
        if not len(names):
            return np.empty(0, np.int64)
        pair, lengths, hashes = self.numbers(names)
        out, odd = np.full(len(names), -1), lengths > self.WIDTH
        if len(self.hashes):
            near = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = np.flatnonzero(self.hashes[near] == hashes)
            near = near[same]
            equal = (self.lengths[near] == lengths[same]) & (self.bytes[near] == pair[same]).all(1)
            out[same[equal]] = self.at[near[equal]]
            odd[same[~equal]] = True
        if self.others and odd.any():
            out[odd] = [self.others.get(name, -1) for name in names.filter(pa.array(odd)).to_pylist()]
        return out

    def add(self, names: pa.Array) -> None:
        """Names that are not known yet, in their order."""
        pair, lengths, hashes = self.numbers(names)
        order = np.argsort(hashes, kind="stable")
        order = order[lengths[order] <= self.WIDTH]
        sorted_ = hashes[order]
        near = np.searchsorted(self.hashes, sorted_)
        # Among short names alone: one in the dictionary is only looked for there if its hash stands here.
        taken = np.zeros(len(order), bool)
        taken[1:] = sorted_[1:] == sorted_[:-1]
        if len(self.hashes):
            taken |= self.hashes[np.minimum(near, len(self.hashes) - 1)] == sorted_
        others = np.append(np.flatnonzero(lengths > self.WIDTH), order[taken])
        for i, name in zip(others.tolist(), names.take(pa.array(others)).to_pylist(), strict=True):
            self.others[name] = self.count + i
        order, near = order[~taken], near[~taken]
        self.hashes, self.at = np.insert(self.hashes, near, hashes[order]), np.insert(self.at, near, self.count + order)
        self.bytes, self.lengths = np.insert(self.bytes, near, pair[order], axis=0), np.insert(self.lengths, near, lengths[order])
        self.count += len(names)


class Encoder:
    """Token ids of whole texts by a byte-level ``tokenizers`` tokenizer, each distinct piece encoded once.

    Such a tokenizer never joins what stands before a single space or line break with what follows,
    nor letters with the full stop or comma after them, so texts are cut there; a piece keeps the
    white space before it. Texts with wider white space are encoded whole. Pieces of letters, the most
    of them, go straight to its model, the others to the tokenizer.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.marks = [(sign, self.ids_of(sign)) for sign in ".,"]
        self.newline = self.ids_of("\n").tolist()
        self.forget()

    def forget(self) -> None:
        """Known pieces: their names, and the place of each in one growing array of ids."""
        self.names = Names()
        self.ids, self.at, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int32), np.empty(0, np.int32)

    def ids_of(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def runs_of_letters(self, pieces: pa.Array, head: str, before: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for pieces of letters after white space: one call of the model each."""
        words, model = pc.utf8_slice_codeunits(pieces, 1).to_pylist(), self.tokenizer.model
        runs = [before + [token.id for token in model.tokenize(head + byte_signs(word))] for word in words]
        return np.fromiter(chain.from_iterable(runs), np.uint32), np.fromiter(map(len, runs), np.int64, len(runs))

    def learn(self, pieces: pa.Array) -> None:
        """Add ``pieces``, none of which is known, in their order."""
        rest = pc.utf8_slice_codeunits(pieces, 1)
        lettered = pc.match_substring_regex(rest, r"^\pL+$")
        marked = pc.match_substring_regex(rest, r"^\pL+[.,]$")
        if pc.any(marked).as_py():
            bare = self.places(pc.utf8_slice_codeunits(pieces.filter(marked), 0, -1))
            # What is known by now may hold some of the pieces.
            new = pa.array(self.names.find(pieces) < 0)
            if not pc.all(new).as_py():
                pieces, lettered, marked = (x.filter(new) for x in (pieces, lettered, marked))
        spaced = pc.starts_with(pieces, " ")
        at, sizes = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        parts, end = [self.ids], len(self.ids)

        def place(which: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            nonlocal end
            at[which], sizes[which] = end + np.cumsum(counts) - counts, counts
            parts.append(ids)
            end += len(ids)

        flags = [pc.and_(lettered, spaced), pc.and_not(lettered, spaced), pc.invert(pc.or_(lettered, marked))]
        near, lines, odd = (np.flatnonzero(f.to_numpy(zero_copy_only=False)) for f in flags)
        # The line break before letters is a token of its own.
        for which, head, before in ((near, SPACE_SIGN, []), (lines, "", self.newline)):
            place(which, *self.runs_of_letters(pieces.take(pa.array(which)), head, before))
        runs = [self.ids_of(piece) for piece in pieces.take(pa.array(odd)).to_pylist()]
        place(odd, np.concatenate([*runs, np.empty(0, np.uint32)]), np.array([len(run) for run in runs], np.int64))
        which = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        if len(which):
            # Letters with a mark after them are the letters' ids and the mark's.
            signs = pc.utf8_slice_codeunits(pieces.take(pa.array(which)), -1)
            for sign, mark in self.marks:
                has = pc.equal(signs, sign).to_numpy(zero_copy_only=False)
                counts = self.sizes[bare[has]].astype(np.int64)
                starts = np.cumsum(counts + len(mark)) - counts - len(mark)
                ids = np.empty(int(counts.sum()) + len(mark) * len(counts), np.uint32)
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                ids[np.repeat(starts, counts) + inside] = self.ids[np.repeat(self.at[bare[has]], counts) + inside]
                for i, token in enumerate(mark):
                    ids[starts + counts + i] = token
                place(which[has], ids, counts + len(mark))
        self.names.add(pieces)
        self.ids = np.concatenate(parts)
        self.at, self.sizes = np.append(self.at, at.astype(np.int32)), np.append(self.sizes, sizes.astype(np.int32))

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of each piece are."""
        pieces = pieces.dictionary_encode()
        names = pieces.dictionary
        found = self.names.find(names)
        new = found < 0
        if new.any():
            unknown = names.filter(pa.array(new))
            self.learn(unknown)
            found[new] = self.names.find(unknown)
        return found[pieces.indices.to_numpy()]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and the number of ids per text."""
        if self.names.count > KNOWN_PIECES:
            self.forget()
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, UNCUT)
        parts = pc.split_pattern(pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n"), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        flat = parts.flatten().dictionary_encode()
        spaced = pc.invert(pc.starts_with(flat.dictionary, "\n"))
        pieces = pc.binary_join_element_wise(pc.if_else(spaced, " ", ""), flat.dictionary, "")
        starts = pc.binary_join_element_wise("\n", flat.take(pa.array(offsets[:-1])).dictionary_decode(), "")
        first = self.places(starts)
        place = self.places(pieces)[flat.indices.to_numpy()]

        # A run of ids per piece, and the end id after the pieces of each text. A first piece was looked up
        # with a line break before it, which is one id; a whole text takes the place of its first piece.
        n, text = len(texts), np.arange(len(texts))
        at, runs = np.empty(len(place) + n, np.int32), np.empty(len(place) + n, np.int32)
        here = np.arange(len(place)) + np.repeat(text, np.diff(offsets))
        at[here], runs[here] = self.at[place], self.sizes[place]
        here = offsets[:-1] + text
        at[here], runs[here] = self.at[first] + 1, self.sizes[first] - 1
        is_whole = whole.to_numpy(zero_copy_only=False)
        wholes = [self.ids_of(t) for t in texts.filter(whole).to_pylist()]
        lengths = np.array([len(ids) for ids in wholes], np.int64)
        pool = np.concatenate([self.ids, np.array([end_id], np.uint32), *wholes])
        runs[here[is_whole]], at[here[is_whole]] = lengths, len(self.ids) + 1 + np.cumsum(lengths) - lengths
        last = offsets[1:] + text
        at[last], runs[last] = len(self.ids), 1
        ends = np.cumsum(runs, dtype=np.int64)
        moved = np.repeat((at - (ends - runs)).astype(np.int32), runs)
        moved += np.arange(len(moved), dtype=np.int32)
        return pool[moved], np.diff(ends[last], prepend=0)


def pack_boundaries(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Elias-Fano parts of a non-decreasing list: low bits each, low part, high part, select samples."""
    n, top = len(ends), int(ends[-1]) if len(ends) else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = ((ends.astype(np.uint64)[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    at = (ends >> low_bits) + np.arange(n)
    high = np.zeros(int(at[-1]) + 1 if n else 0, dtype=np.uint8)
    high[at] = 1
    samples = at[::SELECT_EVERY].astype("<u4")
    packed = np.packbits(low.ravel(), bitorder="little"), np.packbits(high, bitorder="little")
    return low_bits, packed[0].tobytes(), packed[1].tobytes(), samples.tobytes()


class Shard:
    """A shard file in memory: random access to boundaries and ids."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token-id file")
        self.n, self.total, self.low_bits, low, high, samples, width, _ = struct.unpack_from(HEADER, data, len(MAGIC))
        at = len(MAGIC) + struct.calcsize(HEADER)
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.samples = np.frombuffer(data, "<u4", samples // 4, at + low + high)
        self.ids = np.frombuffer(data, f"<u{width}", self.total, at + low + high + samples)

    def select(self, i: int) -> int:
        """Position of set bit ``i`` of the high part."""
        sample = int(self.samples[i // SELECT_EVERY])
        left, byte = i % SELECT_EVERY, sample // 8
        bits = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        bits[: sample % 8] = 0
        while left >= bits.sum():
            left, byte = left - int(bits.sum()), byte + 1
            bits = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        return byte * 8 + int(np.flatnonzero(bits)[left])

    def end(self, i: int) -> int:
        """Ids before the end of document ``i``."""
        first = i * self.low_bits
        held = np.unpackbits(self.low[first // 8 : (first + self.low_bits + 7) // 8], bitorder="little")
        low = held[first % 8 : first % 8 + self.low_bits].astype(np.int64)
        return ((self.select(i) - i) << self.low_bits) + int((low << np.arange(self.low_bits)).sum())

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.end(i - 1) if i else 0 : self.end(i)]

    def ends(self) -> np.ndarray:
        """All boundaries at once."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        low = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return ((at - np.arange(self.n)) << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits))


def shard_bytes(ids: np.ndarray, counts: np.ndarray, wide: bool) -> bytes:
    low_bits, low, high, samples = pack_boundaries(np.cumsum(counts))
    width = 4 if wide else 2
    sizes = len(counts), len(ids), low_bits, len(low), len(high), len(samples), width, 0
    return b"".join((MAGIC, struct.pack(HEADER, *sizes), low, high, samples, ids.astype(f"<u{width}").tobytes()))


def save(folder: str, name: str, data: bytes) -> None:
    """Write under another name, then move: a file with its final name is whole."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    with system.open_output_stream(f"{path}/.{name}") as out:
        out.write(data)
    system.move(f"{path}/.{name}", f"{path}/{name}")


def load(folder: str, name: str) -> Shard:
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{path}/{name}") as read:
        return Shard(read.read())


MANIFEST = "task int, seq int, file string, n_docs long, n_tokens long, doc_ids array<long>"


def write_token_files(documents: DataFrame, folder: str, tokenizer_json: str, end_id: int = 2) -> DataFrame:
    """Encode ``documents`` (doc_id, text) into shards under ``folder`` (a URI or absolute path).

    Returns the manifest, a written table: task, seq, file, n_docs, n_tokens, doc_ids and the number
    of ids in all shards before (start). The text is shuffled once, by ranges of the id.
    """
    spark = documents.sparkSession
    shipped = spark.sparkContext.broadcast(tokenizer_json)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shipped.value)
        task, seq = TaskContext.get().partitionId(), 0
        held_ids, held_counts, held_docs, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{task:06d}-{seq:06d}-{uuid.uuid4().hex}.mtok"
            ids, counts = np.concatenate(held_ids), np.concatenate(held_counts)
            save(folder, name, shard_bytes(ids, counts, encode.wide))
            row = {"task": [task], "seq": [seq], "file": [name], "n_docs": [len(counts)], "n_tokens": [len(ids)]}
            docs = pa.array([pa.concat_arrays(held_docs).to_pylist()], pa.list_(pa.int64()))
            schema = pa.schema([("task", pa.int32()), ("seq", pa.int32()), ("file", pa.string())])
            schema = schema.append(pa.field("n_docs", pa.int64())).append(pa.field("n_tokens", pa.int64()))
            arrays = [pa.array(row[f.name], f.type) for f in schema] + [docs]
            return pa.RecordBatch.from_arrays(arrays, schema=schema.append(pa.field("doc_ids", docs.type)))

        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            ids, counts = encode.encode(batch["text"], end_id)
            held_ids.append(ids)
            held_counts.append(counts)
            held_docs.append(batch["doc_id"])
            held += len(ids)
            if held >= SHARD_IDS:
                yield flush()
                held_ids, held_counts, held_docs, held, seq = [], [], [], 0, seq + 1
        if held_counts:
            yield flush()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    ordered = rows.repartitionByRange("doc_id", row_key()).sortWithinPartitions("doc_id", row_key())
    manifest = store_texts(ordered.mapInArrow(shards, MANIFEST), "token_manifest")
    return with_starts(manifest)


def with_starts(manifest: DataFrame) -> DataFrame:
    """Ids before each shard. Tasks are summed first; the two windows run on one short row per shard."""
    before = Window.partitionBy("task").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = manifest.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("task_start"))
    within = manifest.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("shard_start"))
    return within.join(tasks, "task").select(
        *manifest.columns, (F.col("task_start") + F.col("shard_start")).alias("start")
    )


DOCUMENT_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: id, ids before it, number of ids, checksum of its 32-bit ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = load(folder, row["file"])
                ends = shard.ends()
                begins = np.concatenate(([0], ends[:-1]))
                ids = shard.ids.astype("<u4")
                sums = [zlib.crc32(ids[a:b].data) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins + row["start"], pa.int64()),
                        pa.array(ends - begins, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    held = manifest.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("ids")).first()["ids"]
    spread = manifest.select("file", "doc_ids", "start").repartition(max(1, -(-held // TASK_IDS)), "file")
    return spread.mapInArrow(rows, DOCUMENT_ROWS)


def token_files(spark: SparkSession, documents: DataFrame, tokenizer_json: str, end_id: int = 2) -> DataFrame:
    """Write the files into the shared folder and read every document back from them."""
    folder = scratch_path(spark, "tokens")
    return read_documents(write_token_files(documents, folder, tokenizer_json, end_id), folder)

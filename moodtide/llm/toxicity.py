"""Toxicity scores: a bidirectional gated recurrent network with attention pooling, in numpy.

Every word enters as two vectors: one by the hash of the word, one as the mean over the hashes of
its character trigrams. A network reads windows of ``WINDOW`` words that overlap by half; attention
over the hidden states of both directions pools a window, and a text scores as its highest window.

Training. The driver fits the network on a bounded sample of labelled rows: at most ``TOXIC_ROWS`` and
``CLEAN_ROWS`` texts of at most ``TRAIN_CHARS`` characters, by the lowest hashes of their ids. It
starts on windows that carry the label of their text, and goes on with the highest window of each
text only, since a toxic text need not be toxic throughout. A fifth of the sample is held back to
turn the highest window into a probability. All texts are scored whole.

Defined cases: NULL and empty texts hold no window and score as a window without evidence; labels
other than 0 and 1 are ignored; without labels of both kinds every score is 0; repeated rows are scored
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.common import bounded_slices, store_texts, text_of
from moodtide.llm.quality import segment_hashes, spread_bits

WINDOW, STRIDE = 24, 12
WORD_BITS, CHAR_BITS = 15, 12
SIZE, HIDDEN, ATTEND = 8, 8, 8
TOXIC_ROWS, CLEAN_ROWS, TRAIN_CHARS = 1_200, 3_000, 20_000
# Steps on windows with the label of their text, then on the highest windows, chosen anew every ROUND steps.
FIRST_STEPS, STEPS, ROUND, BATCH = 400, 600, 100, 96
RATE = 0.01
SEED = 11
SLICE_BYTES = 1_000_000
BLOCK = 4_096
AROUND = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class Words:
    """Distinct words of some texts and the windows over them."""

    def __init__(self, texts: pa.Array):
        pieces = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        flat = pieces.flatten()
        # White space at an end of a text splits off an empty piece.
        full = pc.not_equal(flat, "")
        offsets = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))[offsets - offsets[0]]
        flat = flat.filter(full).dictionary_encode()
        trimmed = pc.utf8_trim(flat.dictionary, AROUND).dictionary_encode()
        tokens = trimmed.indices.to_numpy()[flat.indices.to_numpy()] if len(flat) else np.empty(0, np.int32)
        self.size = len(trimmed.dictionary)
        self._hash(trimmed.dictionary)
        self._window(tokens, offsets)

    def _hash(self, words: pa.Array) -> None:
        marked = pc.binary_join_element_wise("^", words, "$$", "").cast(pa.large_string())
        bounds = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + self.size + 1]
        raw = np.frombuffer(marked.buffers()[2], np.uint8) if self.size else np.empty(0, np.uint8)
        self.word = (segment_hashes(raw, bounds[:-1], bounds[1:]) >> np.uint64(64 - WORD_BITS)).astype(np.int32)
        counts = np.diff(bounds) - 2
        self.char_at = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) + np.repeat(bounds[:-1] - self.char_at, counts)
        codes = (raw[at].astype(np.uint64) << np.uint64(16)) | (raw[at + 1].astype(np.uint64) << np.uint64(8)) | raw[at + 2]
        self.char = (spread_bits(codes) >> np.uint64(64 - CHAR_BITS)).astype(np.int32)
        self.chars = counts

    def _window(self, tokens: np.ndarray, offsets: np.ndarray) -> None:
        length = np.diff(offsets)
        per_text = np.where(length > 0, np.maximum(0, -(-(length - WINDOW) // STRIDE)) + 1, 0)
        self.text = np.repeat(np.arange(len(length)), per_text)
        first = np.cumsum(per_text) - per_text
        start = (np.arange(len(self.text)) - first[self.text]) * STRIDE
        at = (offsets[:-1][self.text] + start)[:, None] + np.arange(WINDOW)
        inside = at < offsets[1:][self.text][:, None]
        # One number past the last word stands for nothing.
        self.windows = np.where(inside, tokens[np.minimum(at, max(len(tokens) - 1, 0))] if len(tokens) else 0, self.size)
        self.first = first[per_text > 0]
        self.with_words = per_text > 0


    def only(self, windows: np.ndarray) -> tuple[Words, np.ndarray]:
        """The words of some windows alone, and the windows in their numbers."""
        used, inverse = np.unique(windows, return_inverse=True)
        inverse, used = inverse.reshape(windows.shape), used[used < self.size]
        part = object.__new__(Words)
        part.size, part.word, part.chars = len(used), self.word[used], self.chars[used]
        part.char_at = np.cumsum(part.chars) - part.chars
        part.char = self.char[np.arange(part.chars.sum()) + np.repeat(self.char_at[used] - part.char_at, part.chars)]
        return part, np.minimum(inverse, part.size)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, forward pass and gradients. Gates of a direction stand side by side: reset, update, new."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        # Words that training never met stay close to nothing.
        self.p = {"word": normal(2**WORD_BITS, SIZE, scale=0.05), "char": normal(2**CHAR_BITS, SIZE, scale=0.05)}
        for d in "fb":
            self.p[f"w{d}"] = normal(2 * SIZE, 3 * HIDDEN, scale=0.3)
            self.p[f"u{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.p[f"c{d}"] = np.zeros(3 * HIDDEN, np.float32)
        self.p |= {"a": normal(2 * HIDDEN, ATTEND, scale=0.3), "ac": np.zeros(ATTEND, np.float32), "av": normal(ATTEND, scale=0.3)}
        self.p |= {"o": normal(2 * HIDDEN, scale=0.3), "oc": np.zeros(1, np.float32)}
        self.slope, self.shift = 1.0, 0.0

    def inputs(self, words: Words) -> np.ndarray:
        """Vector of each distinct word, and a last one for nothing."""
        x = np.zeros((words.size + 1, 2 * SIZE), np.float32)
        if words.size:
            x[:-1, :SIZE] = self.p["word"][words.word]
            x[:-1, SIZE:] = np.add.reduceat(self.p["char"][words.char], words.char_at) / words.chars[:, None]
        return x

    def read(self, gates: np.ndarray, u: np.ndarray, windows: np.ndarray, there: np.ndarray, steps, keep: bool):
        """Hidden state after each step, and what the gradients need."""
        h, states, saved = np.zeros((len(windows), HIDDEN), np.float32), [None] * WINDOW, []
        for t in steps:
            g, m = gates[windows[:, t]], there[:, t, None]
            s = h @ u
            ru = sigmoid(g[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            r, z = ru[:, :HIDDEN], ru[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            after = np.where(m, new + z * (h - new), h)
            if keep:
                saved.append((t, h, s[:, 2 * HIDDEN :], r, z, new, m))
            h = states[t] = after
        return states, saved

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: bool = False):
        p, there = self.p, windows < len(x) - 1
        sides = []
        for d, steps in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            sides.append(self.read(x @ p[f"w{d}"] + p[f"c{d}"], p[f"u{d}"], windows, there, steps, keep))
        h = np.concatenate((np.stack(sides[0][0], 1), np.stack(sides[1][0], 1)), axis=2)
        seen = np.tanh(h @ p["a"] + p["ac"])
        e = np.where(there, seen @ p["av"], np.float32(-1e9))
        e = np.exp(e - e.max(1, keepdims=True)) * there
        share = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,btd->bd", share, h)
        return pooled @ p["o"] + p["oc"][0], (there, sides, h, seen, share, pooled)

    def gradients(self, x, words: Words, windows, kept, d_logit) -> dict[str, np.ndarray]:
        p = self.p
        there, sides, h, seen, share, pooled = kept
        g = {"o": pooled.T @ d_logit, "oc": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["o"]
        d_share = np.einsum("bd,btd->bt", d_pooled, h)
        d_e = share * (d_share - (share * d_share).sum(1, keepdims=True))
        g["av"] = np.einsum("bt,bta->a", d_e, seen)
        d_seen = d_e[:, :, None] * p["av"] * (1 - seen**2)
        g["a"], g["ac"] = np.einsum("btd,bta->da", h, d_seen), d_seen.sum((0, 1))
        d_h = share[:, :, None] * d_pooled[:, None, :] + d_seen @ p["a"].T
        d_x = np.zeros((*windows.shape, 2 * SIZE), np.float32)
        for side, d in enumerate("fb"):
            u, d_u, d_after = p[f"u{d}"], np.zeros_like(p[f"u{d}"]), np.zeros((len(windows), HIDDEN), np.float32)
            d_gates = np.zeros((*windows.shape, 3 * HIDDEN), np.float32)
            for t, before, sn, r, z, new, m in reversed(sides[side][1]):
                total = d_after + d_h[:, t, side * HIDDEN : (side + 1) * HIDDEN]
                d_new = total * m * (1 - z) * (1 - new**2)
                d_z = total * m * (before - new) * z * (1 - z)
                d_r = d_new * sn * r * (1 - r)
                d_s = np.concatenate((d_r, d_z, d_new * r), axis=1)
                d_gates[:, t] = np.concatenate((d_r, d_z, d_new), axis=1)
                d_u += before.T @ d_s
                d_after = total * np.where(m, z, 1) + d_s @ u.T
            flat = d_gates.reshape(-1, 3 * HIDDEN)
            g[f"u{d}"], g[f"c{d}"] = d_u, flat.sum(0)
            g[f"w{d}"] = x[windows.ravel()].T @ flat
            d_x += d_gates @ p[f"w{d}"].T
        by_word = np.zeros_like(x)
        np.add.at(by_word, windows.ravel(), d_x.reshape(-1, 2 * SIZE))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        used = np.unique(windows)
        used = used[used < words.size]
        np.add.at(g["word"], words.word[used], by_word[used, :SIZE])
        counts = words.chars[used]
        at = np.arange(counts.sum()) + np.repeat(words.char_at[used] - (np.cumsum(counts) - counts), counts)
        np.add.at(g["char"], words.char[at], np.repeat(by_word[used, SIZE:] / counts[:, None], counts, axis=0))
        return g

    def window_logits(self, words: Words) -> np.ndarray:
        x = self.inputs(words)
        return np.concatenate([self.forward(x, words.windows[i : i + BLOCK])[0] for i in range(0, len(words.windows), BLOCK)])

    def logits(self, words: Words) -> np.ndarray:
        """Highest window of each text; without a window, the constant."""
        out = np.full(len(words.with_words), self.p["oc"][0], np.float32)
        if len(words.windows):
            out[words.with_words] = np.maximum.reduceat(self.window_logits(words), words.first)
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Rounded, since single-precision sums differ in their last digits from batch to batch."""
        return np.round(sigmoid(self.slope * self.logits(Words(texts)).astype(np.float64) + self.shift), 6)


class Adam:
    def __init__(self, params: dict[str, np.ndarray]):
        self.params, self.t = params, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            near = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.params[k] -= (rate * near[0] / (np.sqrt(near[1]) + 1e-7)).astype(np.float32)


def train(texts: list[str], labels: np.ndarray) -> Network | None:
    """A network fitted on some texts; None without both labels."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(SEED)
    net = Network()
    adam = Adam(net.p)
    order = rng.permutation(len(texts))
    held = order[: len(texts) // 5] if len(set(labels[order[: len(texts) // 5]].tolist())) == 2 else order
    fitted = np.setdiff1d(order, held) if len(held) < len(order) else order
    if len(set(labels[fitted].tolist())) < 2:
        fitted = order
    words, y = Words(pa.array([texts[i] for i in fitted], pa.string())), labels[fitted].astype(np.float32)
    if not len(words.windows):
        return None

    def learn(part: np.ndarray, rate: float) -> None:
        local, windows = words.only(words.windows[part])
        of, x = words.text[part], net.inputs(local)
        logit, kept = net.forward(x, windows, keep=True)
        d = (sigmoid(logit) - y[of]) / len(part)
        adam.step(net.gradients(x, local, windows, kept, d.astype(np.float32)), rate)

    per_text = np.bincount(words.text, minlength=len(y))
    first = np.cumsum(per_text) - per_text
    kinds = [np.flatnonzero((per_text > 0) & (y == label)) for label in (0, 1)]
    if not all(map(len, kinds)):
        return None

    def drawn() -> np.ndarray:
        """As many clean as toxic texts, whatever their length."""
        return np.concatenate([rng.choice(kind, BATCH // 2) for kind in kinds])

    for _ in range(FIRST_STEPS):
        part = drawn()
        learn(first[part] + (rng.random(len(part)) * per_text[part]).astype(np.int64), RATE)
    highest = np.zeros(len(y), np.int64)
    for step in range(STEPS):
        if step % ROUND == 0:
            highest[per_text > 0] = np.lexsort((-net.window_logits(words), words.text))[words.first]
        learn(highest[drawn()], RATE * (1 - step / STEPS) + RATE / 20)
    calibrate(net, Words(pa.array([texts[i] for i in held], pa.string())), labels[held])
    return net


def calibrate(net: Network, words: Words, y: np.ndarray) -> None:
    """Logistic regression of the label on the highest window, by Newton steps with a small penalty."""
    x = net.logits(words).astype(np.float64)
    z = np.stack((x, np.ones_like(x)), axis=1)
    ones = y.sum()
    aim = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (p - aim) + 1e-3 * (w - [1, 0]))
        w -= np.clip(step, -1, 1)
    net.slope, net.shift = max(float(w[0]), 1e-3), float(w[1])


def training_sample(documents: DataFrame, labels: DataFrame, may_learn: Column) -> tuple[list[str], np.ndarray]:
    """Texts and labels: the ids are chosen first, so only the chosen rows' texts move."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    usable = usable.filter(may_learn & F.col("label").isin(0, 1)).dropDuplicates(["doc_id"])
    sizes = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text_of("text")).alias("chars"))
    fit = usable.join(sizes.filter(F.col("chars") <= TRAIN_CHARS).select("doc_id").distinct(), "doc_id")
    fit = fit.withColumn("order", F.xxhash64("doc_id"))
    chosen = [fit.filter(F.col("label") == y).orderBy("order", "doc_id").limit(n) for y, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    ids = chosen[0].union(chosen[1]).select("doc_id", "label")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.filter(F.length("text") <= TRAIN_CHARS).join(F.broadcast(ids), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    held = one.toArrow().sort_by("doc_id")
    return held["text"].to_pylist(), held["label"].to_numpy().astype(np.int64)


def toxicity_scores(documents: DataFrame, labels: DataFrame, may_learn: Column) -> DataFrame:
    """doc_id and score of every document; ``labels``: doc_id, label, used where ``may_learn`` holds."""
    net = train(*training_sample(documents, labels, may_learn))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            found = net.scores(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found)], names=["doc_id", "score"])

    return store_texts(rows.mapInArrow(score, "doc_id long, score double"), "toxicity_scores")

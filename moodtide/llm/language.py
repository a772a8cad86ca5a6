"""Language identification by Bayesian fusion of evidence.

    P(language | all) ~ P(text | language) * P(declared | language) * P(suffix | language) * P(language | host)

- Text: a multinomial model over hashed byte trigrams of the lower-case text, with everything but
  letters as space. ``und`` (no known language) gives every trigram the same probability. Trigrams
  overlap threefold, so their sum counts a third.
- Declared language and address suffix: P(value | language), estimated by grouped aggregation over
  all rows, each counted by its text probabilities, smoothed towards an even table.
- Host: P(language | host) is smoothed towards its domain, that towards its suffix, and that towards
  the whole table. A row's own text counts are taken out of its host's counts first.

The text model is fitted on a sample of at most ``TRAIN_ROWS`` distinct texts with a declared language,
those of the lowest hashes. All other counts and all scores cover all rows and whole texts.

Defined cases: without text, a declared value, a suffix or a host that evidence is left out; rows
without any evidence get the most frequent language, and are rejected if that stays under the
threshold; repeated rows are scored alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.common import bounded_slices, measured_bytes, row_key, store_texts, text_of, without_rows
from moodtide.storage import store

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BUCKET_BITS = 14
TRAIN_ROWS = 8_000
OVERLAP = 3
THRESHOLD = 0.5
SMOOTH = 0.5
HOST_WEIGHT = 8.0
SLICE_BYTES = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
EVIDENCE = ("declared", "suffix", "host")


def document_records(documents: DataFrame) -> DataFrame:
    """Documents: the declared language is their ``lang``, the host their ``source``."""
    declared = F.lower(F.trim(F.substring_index("lang", "-", 1)))
    none = F.lit(None).cast("string")
    return documents.select(
        "doc_id", none.cast("long").alias("page_id"), text_of("text").alias("text"),
        declared.alias("declared"), none.alias("suffix"), F.col("source").alias("host"),
    )


MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[#a-z0-9]+;"
HTML_LANGUAGE = r"""(?is)<html\b[^>]*\blang\s*=\s*["']?([a-z]+)"""
ADDRESS = r"(?i)^[a-z]+://(?:[^/@]*@)?([^/:?#]+)(?::\d+)?(?:/([a-z]{2})(?=[/?#]|$))?"


def page_records(pages: DataFrame) -> DataFrame:
    """Pages: the language their markup declares; the suffix is the last host label and a two-letter first folder."""
    host = F.nullif(F.lower(F.regexp_extract("url", ADDRESS, 1)), F.lit(""))
    suffix = F.concat_ws("/", F.substring_index(host, ".", -1), F.lower(F.regexp_extract("url", ADDRESS, 2)))
    declared = F.nullif(F.lower(F.regexp_extract("html", HTML_LANGUAGE, 1)), F.lit(""))
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", F.regexp_replace(text_of("html"), MARKUP, " ").alias("text"),
        declared.alias("declared"), F.when(host.isNotNull(), suffix).alias("suffix"), host.alias("host"),
    )


def letter_table() -> np.ndarray:
    """Bytes that count: ASCII letters and parts of longer characters; the rest is space."""
    table = np.full(256, 32, np.uint32)
    letters = np.r_[ord("a") : ord("z") + 1, 128:256]
    table[letters] = letters
    return table


def trigram_buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte's trigram and the bounds of the texts; what is no trigram gets the last bucket."""
    texts = pc.utf8_lower(texts).cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    letters = letter_table()[raw]
    codes = np.full(len(letters), 0x202020, np.uint32)
    codes[:-2] = (letters[:-2] << np.uint32(16)) | (letters[1:-1] << np.uint32(8)) | letters[2:]
    buckets = ((codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
    buckets[codes == 0x202020] = 2**BUCKET_BITS
    for back in (1, 2):  # a trigram does not run into the next text
        buckets[np.maximum(bounds[1:] - back, bounds[:-1])[bounds[1:] > bounds[:-1]]] = 2**BUCKET_BITS
    return buckets, bounds


def fit_text_model(labelled: DataFrame, languages: Sequence[str] = LANGUAGES, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log probability of every bucket (rows) in every language and in none (columns)."""
    labelled = labelled.filter(F.col("declared").isin(*languages) & (F.length("text") > 0)).select("declared", "text")
    hashed = labelled.withColumn("_hash", F.xxhash64("declared", "text"))
    chosen = store(hashed.select("_hash").distinct().orderBy("_hash").limit(rows), "training_hashes")
    copies = hashed.join(F.broadcast(chosen), "_hash", "left_semi")
    sample = copies.groupBy("_hash").agg(F.first("declared").alias("declared"), F.first("text").alias("text"))
    sample = sample.select("declared", "text").repartition(4)
    shape = len(languages), 2**BUCKET_BITS + 1

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            buckets, bounds = trigram_buckets(batch["text"])
            for text, declared in enumerate(batch["declared"].to_pylist()):
                part = np.bincount(buckets[bounds[text] : bounds[text + 1]], minlength=shape[1])
                total[languages.index(declared)] += part
        names = pa.array(np.repeat(np.arange(shape[0]), shape[1]), pa.int32())
        places = pa.array(np.tile(np.arange(shape[1]), shape[0]), pa.int32())
        arrays = [names, places, pa.array(total.ravel(), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["language", "bucket", "n"])

    counted = sample.mapInArrow(counts, "language int, bucket int, n long").filter("n > 0")
    held = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.full(shape, SMOOTH)
    table[held["language"].to_numpy(), held["bucket"].to_numpy()] += held["n"].to_numpy()
    table = table[:, :-1]
    even = np.full((1, shape[1] - 1), 1.0)
    model = np.log(np.concatenate((table / table.sum(1, keepdims=True), even / even.sum())))
    return np.concatenate((model, np.zeros((len(model), 1))), axis=1).T.astype(np.float32)


def text_likelihoods(records: DataFrame, model: np.ndarray) -> DataFrame:
    """Keys and evidence of every record, with the text's log likelihood in every language and in none (heard),
    and the probabilities these alone give (shares)."""
    shipped = records.sparkSession.sparkContext.broadcast(model)
    keys = [name for name in records.columns if name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in records.schema if f.name != "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for batch in bounded_slices(batches, "text", SLICE_BYTES):
            buckets, bounds = trigram_buckets(batch["text"])
            full = np.flatnonzero(bounds[1:] > bounds[:-1])
            heard = np.zeros((batch.num_rows, table.shape[1]))
            for column in range(table.shape[1]):
                if len(full):
                    each = np.ascontiguousarray(table[:, column])[buckets]
                    heard[full, column] = np.add.reduceat(each, bounds[full], dtype=np.float64) / OVERLAP
            powers = np.exp(heard - heard.max(1, keepdims=True))
            lists = []
            for values in (heard, powers / powers.sum(1, keepdims=True)):
                offsets = np.arange(0, values.size + 1, table.shape[1], dtype=np.int32)
                lists.append(pa.ListArray.from_arrays(offsets, values.ravel()))
            yield pa.RecordBatch.from_arrays([batch[k] for k in keys] + lists, names=[*keys, "heard", "shares"])

    return records.mapInArrow(score, f"{schema}, heard array<double>, shares array<double>")


def parts(name: str, classes: int) -> list[Column]:
    return [F.get(name, F.lit(i)) for i in range(classes)]


def total(values: Sequence[Column]) -> Column:
    return sum(values[1:], values[0])


def summed(rows: DataFrame, by: str, source: str, classes: int) -> DataFrame:
    """Sums of a list column per value of ``by``, as a list named after it."""
    return rows.groupBy(by).agg(F.array(*map(F.sum, parts(source, classes))).alias(f"{by}_counts"))


def joined(rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Left join with a stored table, by broadcast where it is measured to be small."""
    small = measured_bytes(table, F.coalesce(F.octet_length(on), F.lit(0)) + 128) <= BROADCAST_BYTES
    return rows.join(F.broadcast(table) if small else table, on, "left")


def whole(table: DataFrame, name: str, classes: int) -> Column:
    """The sums of a list column over all rows of a stored table, and its rows, as a scalar."""
    sums = (F.coalesce(F.sum(p), F.lit(0.0)) for p in parts(name, classes))
    return table.agg(F.struct(F.array(*sums).alias("counts"), F.count("*").alias("rows"))).scalar()


def value_likelihoods(rows: DataFrame, name: str, classes: int) -> DataFrame:
    """ln P(value | language) of an evidence column, as a list."""
    known = rows.filter(F.col(name).isNotNull())
    counts = store(summed(known, name, "shares", classes), f"{name}_counts")
    table = counts.withColumn("all", whole(counts, f"{name}_counts", classes))
    logs = [
        F.log((own + SMOOTH) / (F.get(F.col("all.counts"), F.lit(i)) + SMOOTH * F.col("all.rows")))
        for i, own in enumerate(parts(f"{name}_counts", classes))
    ]
    return store(table.select(name, F.array(*logs).alias(f"{name}_logs")), f"{name}_logs")


def smoothed(counts: str, above: Sequence[Column], classes: int) -> Column:
    own = parts(counts, classes)
    return F.array(*((c + HOST_WEIGHT * a) / (total(own) + HOST_WEIGHT) for c, a in zip(own, above, strict=True)))


def host_priors(rows: DataFrame, classes: int) -> DataFrame:
    """Per host its soft counts (host_counts) and its domain's smoothed shares (base)."""
    known = rows.filter(F.col("host").isNotNull())
    hosts = store(
        summed(known, "host", "shares", classes).withColumn("domain", F.substring_index("host", ".", -2)), "host_counts"
    )
    domains = summed(hosts, "domain", "host_counts", classes)
    domains = store(domains.withColumn("top", F.substring_index("domain", ".", -1)), "domain_counts")
    tops = store(summed(domains, "top", "domain_counts", classes), "top_counts")
    tops = tops.withColumn("all", whole(tops, "top_counts", classes))
    everywhere = parts("all.counts", classes)
    even = [(c + 1) / (total(everywhere) + classes) for c in everywhere]
    tops = store(tops.select("top", smoothed("top_counts", even, classes).alias("top_shares")), "top_shares")
    base = smoothed("domain_counts", parts("top_shares", classes), classes).alias("base")
    domains = store(domains.join(tops, "top").select("domain", base), "domain_shares")
    return store(joined(hosts, domains, "domain").drop("domain"), "host_priors")


def identify(records: DataFrame, model: np.ndarray, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Keys of the records with language, posterior, text_language, declared and accepted.

    ``records`` has text, declared, suffix, host and any key columns.
    """
    names = [*languages, UNKNOWN]
    classes = len(names)
    rows = store_texts(text_likelihoods(records, model), "text_likelihoods")
    fused = rows
    for name in ("declared", "suffix"):
        fused = joined(fused, value_likelihoods(rows, name, classes), name)
    fused = joined(fused, host_priors(rows, classes), "host")

    def prior(i: int) -> Column:
        others = [F.greatest(c - s, F.lit(0.0)) for c, s in zip(parts("host_counts", classes), parts("shares", classes), strict=True)]
        return F.log((others[i] + HOST_WEIGHT * F.get("base", F.lit(i))) / (total(others) + HOST_WEIGHT))

    nothing = F.lit(0.0)
    logs = [
        F.get("heard", F.lit(i))
        + F.coalesce(F.get("declared_logs", F.lit(i)), nothing)
        + F.coalesce(F.get("suffix_logs", F.lit(i)), nothing)
        + F.coalesce(prior(i), nothing)
        for i in range(classes)
    ]
    keys = [name for name in records.columns if name not in ("text", *EVIDENCE)]
    weighed = fused.select(*keys, "declared", "heard", F.array(*logs).alias("logs"))

    def named(values: str) -> Column:
        return F.element_at(F.array(*map(F.lit, names)), F.array_position(values, F.array_max(values)).cast("int"))

    top = F.array_max("logs")
    share = 1 / F.aggregate("logs", F.lit(0.0), lambda held, log: held + F.exp(log - top))
    found = weighed.select(
        *keys, named("logs").alias("language"), share.alias("posterior"), named("heard").alias("text_language"), "declared"
    )
    return found.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("posterior") >= THRESHOLD))


def accepted_documents(documents: DataFrame) -> DataFrame:
    """The documents whose language is one of ours with a posterior of at least the threshold."""
    records = document_records(documents).withColumn("_row", row_key())
    model = fit_text_model(records.select("declared", "text"))
    rejected = identify(records.drop("page_id"), model).filter(~F.col("accepted"))
    return without_rows(documents, store(rejected.select("doc_id", "_row").distinct(), "rejected"))

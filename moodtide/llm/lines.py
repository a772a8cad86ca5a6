"""Line dedup by a tree of line templates.

As in log parsing, a line goes down a tree of fixed depth: first by its number of tokens, then by its
first ``DEPTH`` tokens, with every token that holds a digit as a variable ``<*>``. The lines of one
leaf share a template where they agree: at each place, a token that at least ``MIN_DOCUMENTS``
documents of the leaf hold there is constant, any other one a variable. A template is recurring
when at least ``MIN_DOCUMENTS`` documents hold a line of it and at least ``MIN_CONSTANT`` of its tokens
are constant. Lines of recurring templates are dropped, except for the first one of each template
(lowest document id, then text hash, then line number), so that nothing vanishes altogether.

Leaves that too few documents reach are set aside by counts alone. Only lines of the others are taken
apart, and each distinct line once, however often it occurs. DataFrame functions only.

Defined cases: NULL and empty texts have no lines; blank lines are always kept; a line of fewer than
``MIN_TOKENS`` tokens is kept; rows equal in id and text are one document; NULL ids come after all
others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.common import measured_bytes, packed, row_key, text_of
from moodtide.storage import store

DEPTH = 3
MIN_TOKENS = 3
MIN_DOCUMENTS = 3
MIN_CONSTANT = 0.6
VARIABLE = "<*>"
BROADCAST_BYTES = 32 * 1024 * 1024


def tokens(line: Column) -> Column:
    """Tokens between blanks, those with a digit as a variable."""
    spaced = F.translate(line, "\t\r", "  ")
    masked = F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, "[^ ]*[0-9][^ ]*", VARIABLE)).otherwise(spaced)
    return F.array_remove(F.split(masked, " "), "")


def leaf(parts: Column) -> Column:
    return F.xxhash64(F.size(parts), F.slice(parts, 1, DEPTH))


def document_lines(documents: DataFrame) -> DataFrame:
    """doc_id, _row, _line (number from 0), _text, _leaf, _same (hash of the tokens); one row per line long enough.

    A written table: the text is cut into lines and tokens once, and most readers need the narrow columns only.
    """
    rows = documents.select("doc_id", row_key().alias("_row"), F.posexplode(F.split(text_of("text"), "\n")).alias("_line", "_text"))
    long = rows.withColumn("_tokens", tokens(F.col("_text"))).filter(F.size("_tokens") >= MIN_TOKENS)
    hashed = long.select(
        "doc_id", "_row", "_line", "_text", leaf(F.col("_tokens")).alias("_leaf"), F.xxhash64("_tokens").alias("_same")
    )
    return store(hashed, "lines")


def document() -> Column:
    return F.xxhash64("doc_id", "_row")


def recurring_lines(lines: DataFrame) -> DataFrame:
    """_leaf, _same, _doc, _text of the lines in leaves that enough documents reach, once per document."""
    # A leaf can only hold a recurring template if enough documents reach it.
    busy = store(
        lines.select("_leaf", document().alias("_doc")).distinct().groupBy("_leaf").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= MIN_DOCUMENTS).select("_leaf"), "busy_leaves",
    )
    small = measured_bytes(busy, F.lit(16)) <= BROADCAST_BYTES
    inside = lines.join(F.broadcast(busy) if small else busy, "_leaf", "left_semi")
    held = inside.select("_leaf", "_same", "_text", document().alias("_doc"))
    return store(held.groupBy("_leaf", "_same", "_doc").agg(F.first("_text").alias("_text")), "leaf_lines")


def constant_tokens(places: DataFrame, held: DataFrame) -> DataFrame:
    """_leaf, _at, _token held by at least ``MIN_DOCUMENTS`` documents.

    A document may hold a token in many lines, so the documents of the lines are no more than an upper limit. Their
    bits, one of 63 by document, are a lower one. Where the two leave it open the documents are counted.
    """
    support = places.filter(F.col("_token") != VARIABLE).groupBy("_leaf", "_at", "_token").agg(
        F.sum("_docs").alias("_most"), F.bit_count(F.bit_or("_bits")).alias("_least")
    )
    support = store(support.filter(F.col("_most") >= MIN_DOCUMENTS), "token_support")
    sure = support.filter(F.col("_least") >= MIN_DOCUMENTS).select("_leaf", "_at", "_token")
    unclear = support.filter(F.col("_least") < MIN_DOCUMENTS).select("_leaf", "_at", "_token")
    small = measured_bytes(unclear, F.octet_length("_token") + 48) <= BROADCAST_BYTES
    found = places.drop("_docs", "_bits").join(F.broadcast(unclear) if small else unclear, ["_leaf", "_at", "_token"])
    found = store(found, "unclear_tokens")
    small = measured_bytes(found, F.octet_length("_token") + 56) <= BROADCAST_BYTES
    docs = held.select("_leaf", "_same", "_doc").join(F.broadcast(found) if small else found, ["_leaf", "_same"])
    docs = docs.select("_leaf", "_at", "_token", "_doc")
    counted = docs.distinct().groupBy("_leaf", "_at", "_token").agg(F.count("*").alias("n"))
    return sure.union(counted.filter(F.col("n") >= MIN_DOCUMENTS).drop("n"))


def templates(held: DataFrame) -> DataFrame:
    """_same, _template for lines of recurring templates. ``held``: _leaf, _same, _doc, _text."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_doc", F.lit(63)).cast("int"))
    once = held.groupBy("_leaf", "_same").agg(F.first("_text").alias("_text"), F.count("*").alias("_docs"), F.bit_or(bit).alias("_bits"))
    distinct = store(once.select("_leaf", "_same", tokens(F.col("_text")).alias("_tokens"), "_docs", "_bits"), "distinct_lines")
    places = distinct.select("_leaf", "_same", "_docs", "_bits", F.posexplode("_tokens").alias("_at", "_token"))
    constant = constant_tokens(places, held)
    marked = places.drop("_docs", "_bits").join(constant.withColumn("_constant", F.lit(True)), ["_leaf", "_at", "_token"], "left")
    shape = F.transform(F.sort_array(F.collect_list(F.struct("_at", F.when(F.col("_constant"), F.col("_token")).alias("t")))), lambda p: p["t"])
    built = marked.groupBy("_leaf", "_same").agg(
        F.xxhash64("_leaf", shape).alias("_template"), F.count("_constant").alias("_fixed"), F.count("*").alias("_size")
    )
    return built.filter(F.col("_fixed") >= MIN_CONSTANT * F.col("_size")).select("_same", "_template")


def dropped_lines(documents: DataFrame) -> DataFrame:
    """doc_id, _row, _line of the lines to drop."""
    named = document_lines(documents)
    held = recurring_lines(named)
    known = store(templates(held), "line_templates")
    small = measured_bytes(known, F.lit(24)) <= BROADCAST_BYTES
    shipped = F.broadcast(known) if small else known
    docs = held.select("_same", "_doc").join(shipped, "_same").select("_template", "_doc").distinct()
    recurring = docs.groupBy("_template").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_DOCUMENTS).select("_template")
    chosen = store(known.join(recurring, "_template"), "recurring_templates")
    found = named.select("doc_id", "_row", "_line", "_same").join(F.broadcast(chosen) if small else chosen, "_same")
    found = store(found.select("doc_id", "_row", "_line", "_template"), "recurring_lines")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row", "_line")
    first = found.groupBy("_template").agg(F.min(order).alias("_first"))
    first = first.select(F.col("_first.doc_id").alias("_doc_1"), F.col("_first._row").alias("_row_1"), F.col("_first._line").alias("_line_1"))
    kept = first.distinct()
    here = F.broadcast(kept) if measured_bytes(store(kept, "first_lines"), F.lit(32)) <= BROADCAST_BYTES else kept
    same = F.col("doc_id").eqNullSafe(F.col("_doc_1")) & (F.col("_row") == F.col("_row_1")) & (F.col("_line") == F.col("_line_1"))
    return found.join(here, same, "left_anti").select("doc_id", "_row", "_line")


def without_recurring_lines(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents``, the text without its dropped lines, and the numbers of lines
    and of dropped lines (n_lines, n_dropped; columns of these names are replaced)."""
    dropped = store(dropped_lines(documents.select("doc_id", "text")), "dropped_lines")
    per_text = dropped.groupBy("doc_id", "_row").agg(F.collect_set("_line").alias("_gone"))
    per_text = store(per_text.select(F.col("doc_id").alias("_id"), F.col("_row").alias("_hash"), "_gone"), "dropped_by_text")
    small = measured_bytes(per_text, F.size("_gone") * 4 + 48) <= BROADCAST_BYTES
    here = F.broadcast(per_text) if small else per_text
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_hash"))
    text = F.col("_document.text")
    split = F.split(text_of(text), "\n")
    kept = F.array_join(F.filter(split, lambda _, i: ~F.array_contains("_gone", i)), "\n")
    others = [F.col(f"_document.`{name}`") for name in documents.columns if name not in ("text", "n_lines", "n_dropped")]
    return packed(documents).join(here, same, "left").select(
        *others,
        F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("text"),
        F.when(F.length(text_of(text)) > 0, F.size(split)).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )

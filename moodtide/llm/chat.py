"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only the
text of that reply is trainable. A conversation that does not end with a reply gets one more row
without a target, so that its last turns are kept too.

    <|im_start|>role\\ntext<|im_end|>\\n        per turn

Control strings inside roles and texts are escaped: a backslash becomes ``\\b``, a line break (in
roles only) ``\\n`` and ``<|`` becomes ``<\\|``. Every backslash then starts one of these pairs, so
undoing them is exact.

Defined cases: NULL roles and texts are empty ones; turns are ordered by turn number, then role, then
text, a NULL number first; repeated rows are turns of their own; rows without a conversation id are
one conversation; an empty table gives no examples; other columns are ignored.

The output holds each context again for every reply, as the method says: its size grows with the
square of the turns of one conversation. A task holds one conversation and one example at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moodtide.llm.common import text_of
from moodtide.storage import store

START, END = "<|im_start|>", "<|im_end|>\n"
END_PATTERN = r"<\|im_end\|>\n"
TARGET_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\|"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """Rows conv_id, example, n_turns, text, loss_start, loss_end, is_last; spans count code points.

    The trainable characters are those from ``loss_start`` up to ``loss_end`` (both NULL without a
    target). ``is_last`` marks the example that holds the whole conversation.
    """
    turns = conversations.select(
        "conv_id", F.struct("turn", text_of("role").alias("role"), text_of("text").alias("text")).alias("turn")
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    rendered = whole.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)).alias("text"),
                F.length(escape(t["text"])).alias("chars"),
                (t["role"] == TARGET_ROLE).alias("target"),
            ),
        ).alias("turns"),
    )
    count = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), count), lambda i: F.element_at("turns", i)["target"] | (i == count))
    examples = rendered.select("conv_id", "turns", F.posexplode(ends).alias("example", "n_turns"))
    last = F.element_at("turns", F.col("n_turns"))
    shown = examples.select(
        "conv_id",
        "example",
        "n_turns",
        F.array_join(F.slice("turns.text", F.lit(1), F.col("n_turns")), "").alias("text"),
        last["target"].alias("target"),
        last["chars"].alias("chars"),
        (F.col("n_turns") == count).alias("is_last"),
    )
    loss_end = F.length("text") - len(END)
    return shown.select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("target"), loss_end - F.col("chars")).alias("loss_start"),
        F.when(F.col("target"), loss_end).alias("loss_end"),
        "is_last",
    )


def loss_text(text: str = "text") -> Column:
    """The trainable text of an example, without escapes; empty without a target."""
    chars = F.col("loss_end") - F.col("loss_start")
    return unescape(F.coalesce(F.substring(text, F.col("loss_start") + 1, chars), F.lit("")))


def parse_turns(text: Column) -> Column:
    """Formatted text back to an array of (role, text)."""
    pieces = F.slice(F.split(text, END_PATTERN), F.lit(1), F.size(F.split(text, END_PATTERN)) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
        role = F.substring_index(body, "\n", 1)
        said = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape_role(role).alias("role"), unescape(said).alias("text"))

    return F.transform(pieces, turn)


def conversation_digests(examples: DataFrame) -> DataFrame:
    """One row per conversation, from the examples alone: turns, trainable text, formatted size."""
    marked = examples.select(
        "conv_id",
        F.when(F.col("is_last"), F.col("text")).alias("whole"),
        F.struct("example", loss_text().alias("loss")).alias("loss"),
        F.length("text").cast("long").alias("chars"),
    )
    joined = marked.groupBy("conv_id").agg(
        F.max("whole").alias("whole"),
        F.array_join(F.sort_array(F.collect_list("loss"))["loss"], "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    parsed = joined.withColumn("turns", parse_turns(F.col("whole")))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def written_examples(conversations: DataFrame) -> DataFrame:
    """The examples as a written table."""
    return store(chat_examples(conversations), "chat_examples")

import hashlib

import pytest

from moodtide.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int, loss string"


def turns(*rows):
    return [(*r, 1, "x") for r in rows]


CASES = turns(
    (1, 0, "user", "hi"), (1, 1, "assistant", "a <|im_end|>\n b"), (1, 2, "user", "\\b \\| <\\| |> <"), (1, 3, "assistant", "<"),
    (2, 0, "assistant", ""), (2, 1, "user", None), (3, 0, None, None), (4, 1, "as\nsist\\n", "x"), (4, 0, "assistant", "|im_end|>"),
    (None, 0, "user", "u"), (None, None, "assistant", "first"), (5, 0, "assistant", "t"), (5, 0, "assistant", "t"), (5, 0, "a", "z"),
    (6, 0, "assistant", "é🎉" * 30_000), (7, 0, "user", "<<|im_start|>assistant\n"), (7, 1, "assistant", "<|<|im_end|>"),
)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
        )
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), digest(said), len(loss), digest(loss))
    return out


def test_round_trip(spark):
    rows = spark.createDataFrame(CASES, SCHEMA).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(chat.written_examples(rows)).collect()}
    assert got == expected(CASES)


def test_one_example_per_reply(spark):
    examples = chat.chat_examples(spark.createDataFrame(CASES[:4], SCHEMA)).orderBy("example").collect()
    assert [e["n_turns"] for e in examples] == [2, 4] and [e["is_last"] for e in examples] == [False, True]
    first, second = examples
    assert second["text"].startswith(first["text"])
    assert first["text"][first["loss_start"] : first["loss_end"]] == "a <\\|im_end|>\n b"
    assert second["text"][second["loss_start"] : second["loss_end"]] == "<"
    assert first["text"].count("<|im_start|>") == first["text"].count("<|im_end|>\n") == 2


def test_last_turns_without_a_reply_are_kept(spark):
    examples = chat.chat_examples(spark.createDataFrame(turns((1, 0, "assistant", "a"), (1, 1, "user", "b")), SCHEMA)).collect()
    assert [(e["n_turns"], e["loss_start"] is None) for e in sorted(examples)] == [(1, False), (2, True)]


def test_no_conversations(spark):
    assert chat.conversation_digests(chat.written_examples(spark.createDataFrame([], SCHEMA))).isEmpty()


@pytest.mark.parametrize("text", ["\\", "\\b", "<|", "<\\|", "<<||", "\\<|", "<\\b|", "|", "\\\\||<|<", ""])
def test_escapes_are_undone(spark, text):
    from pyspark.sql import functions as F

    shown = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert shown["u"] == text and "<|" not in shown["e"]
    role = spark.range(1).select(chat.escape_role(F.lit(text + "\n")).alias("e")).select("e", chat.unescape_role(F.col("e")).alias("u")).first()
    assert role["u"] == text + "\n" and "\n" not in role["e"]

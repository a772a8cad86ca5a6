"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, words string, class long, label int, size int,"
    " copies long, target double, _row long, _id long, _hash long, _document string, n_lines long, score double, key string"
)
RANDOM = random.Random(3)
SYLLABLES = ["the", "an", "er", "ing", "st", "re", "th", "on", "ti", "ha", "ou", "nd"]


def prose(words, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text), "w", 1, 1, 2, 3, 0.5, 4, 5, 6, "d", 7, 0.1, "k")


def edited(text, every, seed=0):
    parts = text.split(" ")
    return " ".join(f"changed{seed}x{i}" if every and i % every == every - 1 else w for i, w in enumerate(parts))


@pytest.fixture(scope="session")
def messy(spark):
    base = prose(120, 1)
    rows = [
        row(0, base), row(1, base), row(2, edited(base, 60)), row(3, edited(base, 3)), row(4, prose(80, 2), "fr", None),
        row(5, None, None, None), row(6, "", "de", "src1"), row(7, "  \n \t ", None, "src1"), row(8, "one two", "xx", "src2"),
        row(8, "one two", "xx", "src2"), row(8, "one two", "xx", "src2"), row(None, prose(50, 3)), row(None, None),
        row(9, prose(20_000, 4), "en", "src1"), row(10, "\n".join(f"at {i} o'clock the log line {i} ended" for i in range(9))),
        row(11, "at 77 o'clock the log line 78 ended\n" + prose(30, 5)), row(12, "at 1 o'clock the log line 2 ended"),
        row(13, "Ünï çødé ñ 中文 🎉 " + prose(30, 6), "es"), row(14, base.upper() + "!"), row(10, prose(40, 7)),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)

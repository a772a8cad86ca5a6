import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from moodtide.llm.queries import tokenizer_json
from moodtide.llm.token_files import SELECT_EVERY, Encoder, Shard, shard_bytes, token_files
from moodtide.storage import scratch_path, store

JSON = tokenizer_json()
PLAIN, FAST = Tokenizer.from_str(JSON), Encoder(JSON)
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\nb", "a\n\nb", "\na", "\n", "a\n", "\n a", "a  b", "a b", "x\ty z", "don't we'll", "it's.",
    "word.,", "word. word, (word) 12.5", "ñandú, straße. été", "中文 字.", "🎉 é", "<|endoftext|> a <|endoftext|>", "a<|endoftext|>\nb", "é x̀.", "\x1c a\x85b", "A.B c,D",
    "\xa0", "\xa0<|endoftext|>", "\xa0a", "\x85", "\u3000b", "\ta", "\t", "\x1c", "\r\na", "\u2003 a", "\x0b<|endoftext|>\xa0", "<|endoftext|>\xa0", "a.", "b,", "\nc.",
]


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]


def check(texts):
    ids, counts = FAST.encode(pa.array(texts, pa.string()), 2)
    expected = [ids_of(t) for t in texts]
    assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_odd_texts():
    check([*ODD, None])
    check(ODD[::-1])


WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2003\u200a\u2028\u2029\u202f\u205f\u3000"
PARTS = st.sampled_from([*WHITE, *"ab.,'é中1", "<|endoftext|>", "word", "ing.", "Not,", "'ll"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=8).map("".join) | st.text(max_size=8), min_size=1, max_size=5))
def test_any_text(texts):
    check(texts)


def test_forgetting_changes_nothing():
    FAST.forget()
    check(ODD)
    check(ODD)


def test_long_and_short_pieces_of_one_hash():
    """The hash is of the first 16 bytes and the length: a piece of 17 bytes shares it with one of 16."""
    rng = random.Random(1)
    FAST.forget()
    check(["x xxxxxxxabcdefghz xxxxxxxbbcdefgh", "xxxxxxxbbcdefgh xxxxxxxabcdefghz"])
    check([" ".join("".join(rng.choices("ab", k=rng.randint(13, 20))) for _ in range(60)) for _ in range(300)])


@pytest.mark.parametrize("counts", [[1], [1] * 1000, [100_000, 1, 1], list(range(1, 700)), [1, 1, 5000] * 300])
@pytest.mark.parametrize("wide", [False, True])
def test_elias_fano(counts, wide):
    ids = np.arange(sum(counts), dtype=np.uint32) % 50_000
    shard = Shard(shard_bytes(ids, np.array(counts), wide))
    ends = np.cumsum(counts)
    assert shard.ends().tolist() == ends.tolist()
    for i in {0, len(counts) // 2, len(counts) - 1, min(SELECT_EVERY, len(counts) - 1)}:
        assert shard.end(i) == ends[i] and len(shard.document(i)) == counts[i]
    assert shard.ids.tolist() == ids.tolist()


def test_boundaries_take_little_space():
    counts = np.full(10_000, 300)
    size = len(shard_bytes(np.zeros(counts.sum(), np.uint32), counts, False)) - 2 * counts.sum()
    assert size < 10_000 * (8 + 2 + 1) / 8 + 1000


def test_documents_come_back(spark, messy):
    got = store(token_files(spark, messy, JSON), "token_documents").collect()
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert len(got) == len(rows)
    crc = lambda t: (len(ids_of(t)), zlib.crc32(np.array(ids_of(t), "<u4").tobytes()))
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], key=repr) == sorted([(d, *crc(t)) for d, t in rows], key=repr)
    in_order = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in in_order] == np.cumsum([0, *(r["n_tokens"] for r in in_order)])[:-1].tolist()
    ids = [r["doc_id"] for r in in_order]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_no_documents(spark, no_documents):
    assert token_files(spark, no_documents, JSON).isEmpty()


def test_stray_files_are_not_read(spark, tmp_path):
    from moodtide.llm import token_files as module

    folder = scratch_path(spark, "stray")
    rows = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    manifest = module.write_token_files(rows, folder, JSON)
    module.save(folder, "999999-000000-lost.mtok", b"half a file")
    assert module.read_documents(manifest, folder).count() == 2

import os
import random

import pytest

from inkwell.llm import encode

pytestmark = pytest.mark.skipif(not os.path.exists(encode.TOKENIZER), reason="no vocabulary here")


@pytest.fixture(scope="module")
def codec():
    return encode.Codec.load(encode.TOKENIZER, encode.PATTERN)


def test_tree_equals_plain(codec):
    rng = random.Random(1)
    parts = ["a", "b", "é", "中", "文字", "'", "s", "'ll", " ", "  ", "\n", "\r\n", "\t", "1", "23", ".", "...", "t", "<|endoftext|>", "'ve", "ing", "the", "​", "\x1c", "\x85", " ", "😀", "ǅ", "Ⅷ", "́"]
    for _ in range(3_000):
        text = "".join(rng.choices(rng.sample(parts, rng.choice([1, 2, 4, 20])), k=rng.randint(0, 300)))
        for leaf in (8, 40):
            assert codec.encode(text, leaf).tolist() == codec.plain(text).tolist(), repr(text)


def test_against_the_other_library(codec):
    tokenizers = pytest.importorskip("tokenizers")
    path = os.path.join(os.path.dirname(encode.TOKENIZER), "byte_bpe_50k.json")
    other = tokenizers.Tokenizer.from_file(path)
    other.encode_special_tokens = True
    for text in ["", " ", "Hello  world's 123", "<|endoftext|>", "中文" * 900, "a" * 5_000, "\n\n  x y"]:
        assert codec.encode(text, 64).tolist() == other.encode(text, add_special_tokens=False).ids


def test_table(spark, codec):
    long = "ab" * 3_000 + " and then " + "中文字" * 2_000
    rows = [(1, "liver cells", 7), (2, "", 7), (3, None, 7), (4, long, 7), (4, long, 7), (5, "liver cells", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = [tuple(r) for r in encode.encode_corpus(df, giant_chars=1_000, leaf_chars=100).collect()]
    assert sorted(k for k, _ in out) == [1, 2, 3, 4, 4, 5]
    want = {1: codec.plain("liver cells").tolist(), 2: [], 3: [], 4: codec.plain(long).tolist(), 5: codec.plain("liver cells").tolist()}
    assert all(ids == want[k] for k, ids in out)
    assert encode.encode_corpus(df.filter("false")).count() == 0


def test_threads_encode_the_parts_of_a_long_text(spark, codec):
    """One scan: a giant text is encoded in its own row, by threads, to the same ids."""
    text = ("liver cells and 中文字 " * 60_000) + "ab" * 100_000
    assert len(text) > encode.THREADED_CHARS
    want = codec.plain(text).tolist()
    assert codec.encode(text).tolist() == want
    df = spark.createDataFrame([(1, text), (2, "x")], "doc_id bigint, text string")
    plan = encode.encode_corpus(df)
    assert {r.doc_id: r.ids for r in plan.collect()} == {1: want, 2: codec.plain("x").tolist()}

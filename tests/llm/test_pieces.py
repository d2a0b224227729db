import random

import pytest

from inkwell.llm import pieces


def stepwise(text, limit, overlap):
    """The greedy cuts one after the other."""
    import numpy as np

    kinds, n, end, out = pieces.boundaries(text), len(text), 0, []
    while end < n:
        at = np.array([end])
        start, after = int(pieces.overlap_starts(at, kinds, overlap)[0]), int(pieces.successors(at, kinds, n, limit, overlap)[0])
        out.append((start, after))
        end = after
    return out


def test_same_as_stepwise_and_lossless():
    rng = random.Random(2)
    for _ in range(1_500):
        text = "".join(rng.choices(["a", "é", " ", ". ", "\n\n", "\n# ", "。", "\r\n\r\n", "x" * 20, "😀"], weights=[5, 2, 3, 1, 0.5, 0.3, 0.3, 0.2, 0.5, 0.3], k=rng.randint(0, 200)))
        limit, overlap = rng.choice([(7, 0), (20, 3), (50, 20)])
        got = pieces.cuts(text, limit, overlap)
        if len(text) > limit:
            assert got == stepwise(text, limit, overlap)
        assert got[0][0] == 0 and got[-1][1] == len(text)
        assert all(b - a <= limit for a, b in got)
        assert all(max(0, e - overlap) <= s < e or s == e and not overlap for (_, e), (s, _) in zip(got, got[1:]))


def test_natural_boundaries():
    text = "# One\n\n" + "word " * 8 + "end.\n\n# Two\n\n" + "more " * 20
    start = pieces.cuts(text, 80, 0)
    assert text[start[0][1] :].startswith("# Two")
    sentences = "Aa bb cc dd. " * 20
    assert all(sentences[:e].endswith(". ") for _, e in pieces.cuts(sentences, 60, 0)[:-1])
    assert [e - s for s, e in pieces.cuts("x" * 1_000, 100, 10)] == [100] * 11 or len(pieces.cuts("x" * 1_000, 100, 10)) == 11


def test_table(spark, rows_of):
    df = spark.createDataFrame([(1, "a" * 25, "k"), (1, "a" * 25, "k"), (2, "", "k"), (3, None, "k"), (4, "b" * 10, "k")], "row_id bigint, text string, piece string")
    out = pieces.split_texts(df, limit=10, overlap=2)
    assert rows_of(out.filter("row_id = 1").groupBy("piece").count()) == [(1, 2), (2, 2), (3, 2)]
    assert rows_of(out.filter("row_id > 1")) == [(2, 1, 0, 0, 1, ""), (4, 1, 0, 10, 1, "b" * 10)]
    assert pieces.split_texts(df.filter("false")).count() == 0
    with pytest.raises(ValueError):
        pieces.split_texts(df, limit=10, overlap=5)


def test_very_long_text(spark):
    text = ("Some words. " * 5 + "y" * 50) * 20_000
    found = pieces.cuts(text)
    assert "".join(text[max(s, p):e] for (s, e), p in zip(found, [0, *[e for _, e in found]])) == text
    assert max(e - s for s, e in found) <= pieces.LIMIT


@pytest.mark.parametrize("text", ["word and more words then " * 40_000, "x" * 1_000_000, "Some words. " * 80_000, ("ab " * 3_000 + "y" * 90_000) * 8])
def test_all_cuts_in_few_rounds(text, monkeypatch):
    """Successors are computed for all starts at once, whatever the text is made of; not cut after cut."""
    calls = []
    whole = pieces.successors
    monkeypatch.setattr(pieces, "successors", lambda *a: calls.append(1) or whole(*a))
    found = pieces.cuts(text)
    assert len(found) >= 100 and len(calls) <= 4

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.llm import neardup

WORDS = [f"w{i}" for i in range(400)]


def brute(rows, least=0.8):
    import re

    sets = {k: set(re.findall(r"[^\W_]+", f"{q or ''} {a or ''}".lower())) for k, q, a in rows}
    keys = sorted(sets)
    return {(x, y) for i, x in enumerate(keys) for y in keys[i + 1 :] if sets[x] and sets[y] and len(sets[x] & sets[y]) >= least * len(sets[x] | sets[y]) - 1e-9}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "qa_id bigint, q string, a string, words string")


def test_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        if k and rng.random() < 0.6:
            base = list(rng.choice(rows)[2].split())
            for _ in range(rng.randint(0, 4)):
                if rng.random() < 0.5 and base:
                    base.pop(rng.randrange(len(base)))
                else:
                    base.insert(rng.randint(0, len(base)), rng.choice(WORDS))
            rng.shuffle(base)
        else:
            base = rng.choices(WORDS, k=rng.choice([1, 2, 5, 9, 20, 40, 90, 200]))
        rows.append((k, "Q" if rng.random() < 0.2 else None, " ".join(base).upper() if rng.random() < 0.2 else " ".join(base)))
    rows += [(900, None, None), (901, "", " "), (902, "?!", None)]
    df = frame(spark, rows)
    got = {tuple(r) for r in neardup.near_pairs(df, "qa_id", [F.col("q"), F.col("a")]).collect()}
    assert got == brute(rows) and len(got) > 100
    # With nearly every key crowded the pairs come over two chunks, and none is lost.
    sets, members = neardup.copy_classes(df, "qa_id", [F.col("q"), F.col("a")])
    once = {tuple(r)[:2] for r in neardup.near_sets(sets).collect()}
    for hot in (0, 1, 3):
        assert {tuple(r)[:2] for r in neardup.near_sets(sets, hot=hot).collect()} == once


def test_crowded_chunks(spark):
    """Records of one template share chunks of common words; those are indexed again, and the near ones found."""
    rng = random.Random(6)
    common = [f"c{i}" for i in range(40)]
    rows = [(k, " ".join([*common, *(f"r{rng.randrange(10**6)}" for _ in range(9))]), None) for k in range(300)]
    rows += [(1_000 + k, rows[k][1] + " more", None) for k in range(0, 300, 3)]
    df = frame(spark, rows)
    sets, _ = neardup.copy_classes(df, "qa_id", [F.col("q"), F.col("a")])
    got = {tuple(r)[:2] for r in neardup.near_sets(sets, hot=20).collect()}
    assert got == brute(rows) and len(got) >= 100


def test_groups_and_copies(spark, rows_of):
    rows = [(1, "a b c d e", None), (2, "e d c b a", None), (3, "a b c d e f", None), (4, "b c d e f g", ""), (5, "z", None), (6, None, None)]
    got = rows_of(neardup.near_groups(frame(spark, rows), "qa_id", [F.col("q"), F.col("a")]))
    # 3 and 4 share five of seven words, which is too little.
    assert got == [(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 0), (5, 5, 0), (6, 6, 0)]


def test_empty_and_hot_group(spark):
    df = frame(spark, [(k, "same words in all of them", "x") for k in range(60)] + [(100 + k, f"other{k}", None) for k in range(60)])
    assert neardup.near_pairs(df, "qa_id", [F.col("q"), F.col("a")]).count() == 60 * 59 // 2
    assert neardup.near_pairs(df.filter("false"), "qa_id", [F.col("q"), F.col("a")]).count() == 0
    twice = df.limit(5).union(df.limit(5))
    assert neardup.near_pairs(twice, "qa_id", [F.col("q"), F.col("a")]).count() == neardup.near_pairs(twice.distinct(), "qa_id", [F.col("q"), F.col("a")]).count()


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 5_000), st.integers(1, 5_000))
def test_two_classes_and_pigeonhole(a, b):
    small, large = sorted((a, b))
    if small < 0.8 * large:
        return
    import math

    m = neardup.chunks_of(small, 0.8)
    low, high = neardup.chunks_of(math.ceil(large * 0.8 - 1e-9), 0.8), neardup.chunks_of(large, 0.8)
    assert low <= m <= high
    assert neardup.most_differing(small, 0.8) <= 2 * m - 3

import random

import pytest

from inkwell.llm import leaks


def words(rng, n):
    return [f"w{rng.randint(0, 300)}" for _ in range(n)]


def test_against_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, 20)), " ".join(words(rng, rng.choice([3, 12, 40]))), "x") for i in range(30)]
    docs = []
    for d in range(200):
        body = words(rng, rng.randint(0, 60))
        if rng.random() < 0.6:
            _, q, a, _ = rng.choice(items)
            source = rng.choice((q, a)).split()
            n = rng.randint(8, 16)
            start = rng.randint(0, max(0, len(source) - n))
            body[5:5] = source[start : start + n]
        text = "".join(w.upper() + rng.choice([" ", ", ", "\n", "_", " -- "]) for w in body)
        docs.append((d, text, 1))
    docs += [(900, None, 1), (901, "", 1), (902, "short", 1)]
    corpus, held = spark.createDataFrame(docs, "doc_id bigint, text string, seed int"), spark.createDataFrame(items, "item_id bigint, question string, answer string, at string")
    grams = {}
    for i, q, a, _ in items:
        for t in (q, a):
            w = t.split()
            for k in range(len(w) - 11):
                grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = set()
    for d, t, _ in docs:
        w = leaks._WORD.findall((t or "").lower())
        for k in range(len(w) - 11):
            want |= {(d, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    found = leaks.find_leaks(corpus, held)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 20
    assert leaks.leaked_items(found).count() == len(want)


def test_substitutions(spark):
    base = [f"t{i}" for i in range(12)]
    held = spark.createDataFrame([(1, " ".join(base), None)], "item_id bigint, question string, answer string")
    docs = []
    for p in range(12):
        changed = list(base)
        changed[p] = "other"
        docs.append((p, " ".join(changed)))
    docs.append((50, " ".join(["x", "y", *base[2:]])))
    corpus = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert leaks.find_leaks(corpus, held).count() == 0
    got = leaks.find_leaks(corpus, held, substitutions=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(12)) and {r.substituted for r in got} == {1}
    with pytest.raises(ValueError):
        leaks.find_leaks(corpus, held, substitutions=5)


def test_stretches(spark, rows_of):
    """Hits of one alignment are one stretch over a substituted word; another place is another one."""
    rng = random.Random(8)
    base = words(rng, 30)
    changed = [*base[:15], "other", *base[16:]]
    held = spark.createDataFrame([(1, " ".join(base), None)], "item_id bigint, question string, answer string")
    corpus = spark.createDataFrame([(1, " ".join(["x", *changed, "y", *base[:12]])), (2, " ".join(base[3:17])), (2, " ".join(base[3:17])), (3, " ".join(changed[10:21]))], "doc_id bigint, text string")
    windows = leaks.find_leaks(corpus, held, substitutions=1)
    found = [(r.doc_id, r.at, r.item_at, r.words) for r in leaks.stretches(windows).orderBy("doc_id", "at").collect()]
    assert found == [(1, 1, 0, 30), (1, 32, 0, 12), (2, 0, 3, 14)]
    assert rows_of(leaks.leaked_items(windows)) == [(1, 1, 30), (2, 1, 14)]


def test_bitmap_grows_with_the_seeds(spark):
    few = spark.createDataFrame([(i * 7_919,) for i in range(100)], "seed bigint")
    many = spark.range(200_000).selectExpr("xxhash64(id) as seed")
    assert len(leaks.seed_bitmap(few)) * 8 == 1 << leaks.FEWEST_BITS
    assert len(leaks.seed_bitmap(many)) * 8 == 1 << 23


def test_empty_sides(spark):
    held = spark.createDataFrame([(1, "a " * 20, None)], "item_id bigint, question string, answer string")
    corpus = spark.createDataFrame([(1, "a " * 40)], "doc_id bigint, text string")
    assert leaks.leaked_items(leaks.find_leaks(corpus, held)).count() == 1
    assert leaks.find_leaks(corpus.filter("false"), held).count() == 0
    assert leaks.find_leaks(corpus, held.filter("false")).count() == 0

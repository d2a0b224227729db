import pytest
from pyspark.sql import functions as F

from inkwell.operators import concepts, filters, relational, reshape


def test_repeat_sub(spark, rows_of):
    schema = "t string, n int, a string, b string"
    rows = [("x", 1, "Up", None), ("x", 2, "g1", "1"), ("x", 3, "Down", " "), ("x", 4, "g2", "2"), ("y", 1, "g", "1"), ("y", 2, "Late", ""), ("y", 3, "h", "2")]
    out = reshape.repeat_sub(spark.createDataFrame(rows, schema), "t", "n", ["a", "b"])
    assert out.columns[0] == "subheading"
    # A table that does not begin with a subheading stays whole.
    assert rows_of(out.select("t", "n", "subheading", "a")) == [
        ("x", 2, "Up", "g1"), ("x", 4, "Down", "g2"), ("y", 1, None, "g"), ("y", 2, None, "Late"), ("y", 3, None, "h"),
    ]
    pairs = [("z", i, a, b) for i, (a, b) in enumerate([("A", None), ("B", None), ("C", None), ("g", "1")])]
    assert reshape.repeat_sub(spark.createDataFrame(pairs, schema), "t", "n", ["a", "b"]).count() == 4
    with pytest.raises(ValueError):
        reshape.repeat_sub(spark.createDataFrame(rows, schema), "t", "n", ["a", "b"], name="a")


def test_collapse(spark, rows_of):
    df = spark.createDataFrame([("t", 1, "a", 5), ("t", 2, None, None), ("t", 3, " ", 7), ("t", 4, "-", None)], "t string, n int, x string, y int")
    assert rows_of(reshape.collapse_rows(df, "t", "n", ["x", "y"], na_string="-")) == [("t", 1, "x=a; y=5"), ("t", 3, "y=7")]
    grid = spark.createDataFrame([("t", ["x", "y"], [["1", None], [None, ""], ["", "2"]])], "t string, h array<string>, r array<array<string>>")
    assert rows_of(reshape.collapse_grid(grid, "t", "h", "r")) == [("t", 1, "x=1"), ("t", 3, "y=2")]


def test_paths(spark, rows_of):
    rows = [("g", 1, "carb", 3), ("g", 2, "ferment", 4), ("g", 3, "glycolysis", 5), ("g", 4, "lipid", 4), ("h", 1, "NA", 1), ("h", 2, "end", 2)]
    df = spark.createDataFrame(rows, "g string, n int, name string, level int")
    assert rows_of(reshape.path_rows(df, "g", "n", "name", "level").select("g", "n", "path")) == [
        ("g", 1, "carb"), ("g", 2, "carb; ferment"), ("g", 3, "carb; ferment; glycolysis"), ("g", 4, "carb; lipid"), ("h", 1, ""), ("h", 2, "end"),
    ]
    assert rows_of(reshape.path_string(df, "g", "n", "name", "level")) == [("g", "carb; lipid"), ("h", "end")]
    deep = spark.createDataFrame([("d", i, f"x{i}", i) for i in range(1, 40)] + [("d", 40, "y", None), (None, 1, "z", 2)], "g string, n int, name string, level int")
    paths = {(r.g, r.n): r.path for r in reshape.path_rows(deep, "g", "n", "name", "level").collect()}
    assert paths["d", 39] == paths["d", 40] == "; ".join(f"x{i}" for i in range(1, 40)) and paths[None, 1] == "z"
    assert reshape.path_rows(deep.filter("false"), "g", "n", "name", "level").count() == 0


def test_islands_and_text(spark, rows_of):
    df = spark.createDataFrame([("d", 1, "a", "x"), ("d", 2, "a", "y"), ("d", 3, None, "z"), ("d", 4, None, "w"), ("d", 5, "a", "v")], "d string, n int, s string, t string")
    marked = relational.islands(df, "d", "n", "s")
    assert rows_of(relational.joined_text(marked, ["d", "island"], "n", "t", " ")) == [("d", 1, "x y"), ("d", 2, "z w"), ("d", 3, "v")]


def test_relational(spark, rows_of):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, t string")
    assert rows_of(relational.first_per_value(df, F.col("t"), "id").select("id")) == [(1,), (3,), (4,), (5,)]
    last = relational.last_per_key(spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, None)], "k string, n int, v string"), "k", "n")
    assert rows_of(last) == [("j", 1, None), ("k", 2, "new")]
    counts = relational.status_counts(spark.createDataFrame([("a", "saved"), ("a", "saved"), ("b", "error")], "archive string, status string"))
    assert rows_of(counts) == [(None, "error", 1), (None, "saved", 2), ("a", "saved", 2), ("b", "error", 1)]
    judged = spark.createDataFrame([("yes",), ("no",), (None,), ("yes",)], "correct string")
    assert rows_of(relational.accuracy(judged)) == [(0.5, 2, 2)]
    assert rows_of(relational.accuracy(judged.filter("false"))) == [(0.0, 0, 0)]
    assert relational.budgeted_search(df, "t", [], 3, "id").count() == 0


def test_through_cache(spark, rows_of):
    df = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h2"), (4, "h3")], "id int, hash string")
    cache = spark.createDataFrame([("h1", "old")], "hash string, v string")
    calls = spark.sparkContext.accumulator(0)

    def compute(missing):
        def run(frames):
            for f in frames:
                calls.add(len(f))
                yield f[["hash"]].assign(v="new")

        return missing.mapInPandas(run, "hash string, v string")

    rows, new = relational.through_cache(df, "hash", cache, "v", compute)
    new = spark.createDataFrame(new.collect(), "hash string, v string")
    assert rows_of(rows.select("id", "v")) == [(1, "old"), (2, "new"), (3, "new"), (4, "new")]
    # With the new entries in the cache nothing is left to compute.
    before = calls.value
    again, none = relational.through_cache(df, "hash", cache.unionByName(new), "v", compute)
    assert none.count() == 0 and again.count() == 4 and calls.value == before


def test_filters(spark, rows_of):
    df = spark.createDataFrame([(1, "CC BY 4.0", "Research-Article", "weight-loss"), (2, "CC BY-ND 4.0", "research-article", "diabetes"), (3, "CC BY-NC-ND 4.0", None, "x"), (4, None, "research-article", "obesity"), (5, "cc by", "research-article", "prediabetes")], "n int, l string, t string, s string")
    assert rows_of(df.select("n", filters.ingest_status(F.col("l"), F.col("t"), filters.on_topic(F.col("s"))).alias("x"))) == [(1, "saved"), (2, "filtered"), (3, "filtered"), (4, "filtered"), (5, "filtered")]
    assert rows_of(df.filter(filters.license_allowed(F.col("l"))).select("n")) == [(1,), (3,), (5,)]
    assert rows_of(df.filter(filters.within_budget(F.col("s"), 21, spare=20)).select("n")) == [(1,), (2,), (3,), (4,), (5,)]


def test_concepts(spark, rows_of):
    texts = spark.createDataFrame([(1, "Kidney cortex, kidneys, KIDNEY and liver"), (2, None), (3, "none")], "id int, text string")
    found = concepts.mentions(texts, ["kidney", "Kidney cortex", "liver"], "id")
    assert rows_of(found) == [(1, 0, "kidney cortex"), (1, 24, "kidney"), (1, 35, "liver")]
    aliases = spark.createDataFrame([("Kidney", "C2", 0.9), ("kidney", "C1", 0.9), ("liver", "C3", 0.5), ("kidney cortex", "C4", 0.7)], "alias string, concept string, score double")
    assert rows_of(concepts.concepts_of(concepts.link(found, aliases, "id"), "id")) == [(1, ["C4", "C1"])]
    assert concepts.mentions(texts, [], "id").count() == 0

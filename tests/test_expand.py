import pytest

from inkwell.operators import expand


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "n int, text string")


def test_separate_text(spark, rows_of):
    df = frame(spark, "ybt and hmu, ybt", "none", None, "Hmu xhmu")
    out = expand.separate_text(df, ["hmu", "ybt"])
    assert out.columns == ["match", "n", "text"]
    assert rows_of(out.select("n", "match")) == [(1, "hmu"), (1, "ybt")]
    assert rows_of(expand.separate_text(df, r"(h)mu").select("n", "match")) == [(1, "hmu"), (4, "hmu")]
    assert expand.separate_text(df.filter("false"), "x").count() == 0
    with pytest.raises(ValueError):
        expand.separate_text(df, [])


def test_separate_refs(spark, rows_of):
    df = frame(spark, "as in [7-9,15] and (9-7) or (1-2-3)", "[x]", None, "(2007)")
    assert rows_of(expand.separate_refs(df).select("n", "id")) == [(1, 7), (1, 8), (1, 9), (1, 15), (4, 2007)]
    assert rows_of(expand.separate_refs(df, most=500).select("n", "id")) == [(1, 7), (1, 8), (1, 9), (1, 15)]


def test_separate_genes(spark, rows_of):
    df = frame(spark, "the YbtA and hmuRST but log2 or ybtE in Abc123")
    assert rows_of(expand.separate_genes(df).select("match", "gene")) == [("Abc123", "abc123"), ("YbtA", "ybtA"), ("hmuRST", "hmuR"), ("hmuRST", "hmuS"), ("hmuRST", "hmuT"), ("ybtE", "ybtE")]
    assert rows_of(expand.separate_genes(df, None, ["in"]).select("gene")) == [("in",)]
    for wrong in ({"operon": 4}, {"pattern": None}):
        with pytest.raises(ValueError):
            expand.separate_genes(df, **wrong)


def test_separate_tags(spark, rows_of):
    df = frame(spark, "YPO1970-74, YPO0001-YPO0003, YPO1998-02 YPO0778-0776 YPO12- .")
    got = rows_of(expand.separate_tags(df, "YPO").select("match", "id"))
    assert [i for m, i in got if m == "YPO1970-74"] == [f"YPO{n}" for n in range(1970, 1975)]
    assert [i for m, i in got if m == "YPO0001-YPO0003"] == ["YPO0001", "YPO0002", "YPO0003"]
    # The end keeps its width: 1998-02 falls and gives nothing.
    assert not [i for m, i in got if m in ("YPO1998-02", "YPO0778-0776")]
    assert ("YPO12-", "YPO12") in got
    many = frame(spark, "YPO1-2-3 YPO7")
    with pytest.raises(Exception, match="several dashes"):
        expand.separate_tags(many, "YPO").collect()
    assert rows_of(expand.separate_tags(many, "YPO", strict=False).select("id")) == [("YPO7",)]


def test_sentence_rows(spark, rows_of):
    df = spark.createDataFrame([(1, "A. B\r\n\r\n \rC"), (2, None), (3, "")], "k int, text string")
    assert rows_of(expand.sentence_rows(df, "k")) == [(1, 1, 1, "A."), (1, 1, 2, "B"), (1, 2, 1, "C")]


def test_wide_ranges_are_none(spark, rows_of):
    df = spark.createDataFrame([(1, "see [1-2000000000] and (3-5) and [2147483600-2147483647]"), (2, "AB000001-999999999 to AB0007-9")], "id_ int, text string")
    assert rows_of(expand.separate_refs(df).filter("id < 100").select("id_", "id")) == [(1, 3), (1, 4), (1, 5)]
    assert expand.separate_refs(df).count() == 3 + 48
    assert rows_of(expand.separate_tags(df, "AB").select("id")) == [("AB0007",), ("AB0008",), ("AB0009",)]
    assert rows_of(expand.separate_refs(df, widest=2).select("id")) == []

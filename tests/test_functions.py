import pytest
from pyspark.sql import functions as F

from inkwell.functions import markup as M
from inkwell.functions import text as T
from inkwell.functions import vector as V


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("  a \n b ", "a b"),
        ("see ( 12, 15 ) and (Vionnet et al. 1992)", "see [12, 15] and (Vionnet et al. 1992)"),
        ("in (2007) [ 33 ] ( x )", "in [2007] [33] (x)"),
        ("level . ok , no ?", "level. ok, no?"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_paragraph(spark, raw, expected):
    assert one(spark, T.normalize_paragraph(F.col("t")), t=("string", raw)) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("One. Two!  Three? four", ["One.", "Two!", "Three?", "four"]), ("", []), ("  ", []), ("p = 0.5 stays. Yes...", ["p = 0.5 stays.", "Yes..."]), (None, None)],
)
def test_sentences(spark, raw, expected):
    assert one(spark, T.sentences(F.col("t")), t=("string", raw)) == expected


@pytest.mark.parametrize(
    "url, code",
    [
        ("https://creativecommons.org/licenses/by-nc/4.0/", "CC BY-NC 4.0"),
        ("http://creativecommons.org/publicdomain/zero/1.0/", "CC0 1.0"),
        ("https://creativecommons.org/publicdomain/zero", "CC0 1.0"),
        ("HTTP://Example.org/Terms", "http://example.org/terms"),
        ("", ""),
        (None, ""),
    ],
)
def test_license_code(spark, url, code):
    assert one(spark, T.license_code(F.col("u")), u=("string", url)) == code


def test_small_functions(spark):
    assert one(spark, T.zero_pad(F.col("n"), F.lit(4)), n=("int", 7)) == "0007"
    assert one(spark, T.zero_pad(F.col("n"), F.lit(2)), n=("int", 12345)) == "12345"
    assert one(spark, T.stem(F.col("p")), p=("string", "a/b/PMC1.tar.xml")) == "PMC1.tar"
    assert one(spark, T.int_if_digits(F.col("y")), y=("string", "1997")) == 1997
    assert one(spark, T.int_if_digits(F.col("y")), y=("string", "1997a")) is None
    assert one(spark, T.unfold(F.col("t")), t=("string", "a\n    b")) == "a b"
    assert one(spark, T.word_count(F.col("t")), t=("string", " a b c ")) == 3
    assert one(spark, T.word_count(F.col("t")), t=("string", "  ")) == 0
    assert one(spark, T.fill("a {} b {}", F.col("t"), F.lit("y")), t=("string", "x")) == "a x b y"
    with pytest.raises(ValueError):
        T.fill("{} {}", F.lit("x"))


def test_context(spark):
    assert one(spark, T.join_articles(F.col("t")), t=("array<string>", ["p", "q"])) == "# Article 1/2:\n\np\n\n# Article 2/2:\n\nq"


def test_math_and_emphasis(spark):
    assert one(spark, M.math_format(F.col("t")), t=("string", "x = 1; p > 0.05; 50%; 1/2")) == r"$x = 1$; $p \leq 0.05$; $50\%$; $\frac{1}{2}$"
    said = "In the lab Yersinia pestis grew. Escherichia coli did not; Recal gene"
    assert one(spark, M.species_emphasis(F.col("t")), t=("string", said)) == said.replace("Yersinia pestis", "*Yersinia pestis*")
    assert one(spark, M.gene_emphasis(F.col("t")), t=("string", "the Recal gene and Abcprotein")) == "the *Recal* gene and Abcprotein"


def test_reference_line(spark):
    names = ("number", "authors", "title", "journal", "year", "volume", "pages", "doi", "pmid")
    line = M.reference_line(*[F.col(n) for n in names])
    make = lambda *v: one(spark, line, **{n: ("int" if n == "number" else "string", x) for n, x in zip(names, v)})
    assert make(1, "Bell A", "T", "J", "1997", "3", "1-2", "10.1/x", "9") == "1. Bell A. **T**. *J* (1997) **3** 1-2. DOI: 10.1/x"
    assert make(2, None, "T", None, None, "", None, None, "9") == "2. **T**. PMID: 9"
    assert make(3, None, None, None, None, None, None, None, None) == "3. "


def test_table_and_section(spark):
    table = M.table_markdown(F.lit("Table 1"), F.col("h"), F.col("r"))
    out = one(spark, table, h=("array<string>", ["a", "b\nc"]), r=("array<array<string>>", [["1", None], ["x\ny", " z "]]))
    assert out == "**Table 1**\n\n| a | b c |\n| --- | --- |\n| 1 |  |\n| x y | z |"
    section = M.section(F.col("p"), F.col("f"))
    assert one(spark, section, p=("string", "Abstract; Aim"), f=("array<string>", ["one", "two.", "**Figure 1:** *c*", "three"])) == "### Aim\n\none two.\n\n**Figure 1:** *c*\n\nthree"
    assert one(spark, section, p=("string", "Methods"), f=("array<string>", [])) == "## Methods"
    five = one(spark, M.paragraphs_of(F.col("f")), f=("array<string>", ["a", "b", "c", "d", "e"]))
    assert five == ["a b c d", "e"]


def test_front_matter(spark):
    df = spark.createDataFrame([("T: x", ["A B"], None, 1997, "", None, "CC0 1.0")], "t string, a array<string>, j string, y int, p string, d string, l string")
    assert df.select(M.front_matter("t", "a", "j", "y", "p", "d", "l")).first()[0] == "---\ntitle: 'T: x'\nauthors:\n- A B\nyear: 1997\nlicense: CC0 1.0\n---\n\n# T: x"


def test_vectors(spark):
    assert one(spark, V.cosine(F.col("a"), F.col("b")), a=("array<float>", [1.0, 0.0]), b=("array<float>", [1.0, 1.0])) == pytest.approx(2**-0.5)
    assert one(spark, V.normalize(F.col("a")), a=("array<float>", [3.0, 4.0])) == pytest.approx([0.6, 0.8])
    assert one(spark, V.normalize(F.col("a")), a=("array<float>", [0.0, 0.0])) is None
    assert one(spark, V.cosine(F.col("a"), F.col("a")), a=("array<float>", [0.0])) is None

"""Operators that give several rows for one: matches, citations, genes, locus tags, sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text as T

# The forms of a citation and of a gene, and words of a gene's form that are none.
NOT_GENES = ("TraDIS", "taqDNA", "log2", "log10", "ecoRI", "bamHI", "chr1", "chr2")

CITATION = r"(?:\(|\[)[0-9, -]+(?:\]|\))"
GENE = r"\b[A-Za-z][a-z]{2}[A-Z0-9]+\b"

#: A range of more numbers than this is taken for none: it is no list of references or loci.
WIDEST = 10_000


def _front(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *[c for c in df.columns if c not in names])


def pattern_of(pattern: str | list[str]) -> str:
    """A pattern as it is; a list of words as whole words."""
    if isinstance(pattern, str):
        return pattern
    if not pattern:
        raise ValueError("give at least one word")
    return "|".join(rf"\b{word}\b" for word in pattern)


def matches(text: Column, pattern: str) -> Column:
    """Whole matches, the first of each, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def separate_text(df: DataFrame, pattern: str | list[str], column: str = "text") -> DataFrame:
    """One row for each distinct match of a row, ``match`` first; rows without one vanish."""
    regex = pattern_of(pattern)
    found = df.filter(F.coalesce(F.col(column).rlike(regex), F.lit(False)))
    return _front(found.withColumn("match", F.explode(matches(F.col(column), regex))), "match")


def separate_refs(df: DataFrame, column: str = "text", most: int | None = None, widest: int = WIDEST) -> DataFrame:
    """One row for each cited number, ``id`` and ``match`` first; ranges are spelled out.

    What is no number, a falling range, a range of three and one of more than
    ``widest`` numbers give none; with ``most``, numbers above it (years) neither.
    """
    found = separate_text(df, CITATION, column)
    items = F.split(F.regexp_replace("match", r"[\[\]() ]", ""), ",")

    def numbers(item: Column) -> Column:
        ends = F.split(item, "-")
        first, last = F.get(ends, F.lit(0)).try_cast("int"), F.get(ends, F.lit(1)).try_cast("int")
        single = F.when(first.isNotNull() & (F.size(ends) == 1), F.array(first))
        fits = (F.size(ends) == 2) & (first <= last) & (last.cast("bigint") - first < widest)
        span = F.when(fits, F.sequence(first, F.least(F.greatest(first, last), (first.cast("bigint") + widest).try_cast("int"))))
        return F.coalesce(single, span, F.array().cast("array<int>"))

    out = found.withColumn("id", F.explode(F.flatten(F.transform(items, numbers))))
    return _front(out if most is None else out.filter(F.col("id") <= most), "id", "match")


def separate_genes(df: DataFrame, pattern: str | None = GENE, genes: list[str] | None = None, operon: int = 6, column: str = "text") -> DataFrame:
    """One row for each gene, ``gene`` and ``match`` first.

    A match of at least ``operon`` characters whose tail is not all digits is
    an operon: a gene for each character of the tail.
    """
    if operon <= 4:
        raise ValueError("operon must be above 4")
    parts = ([pattern] if pattern else []) + ([pattern_of(genes)] if genes else [])
    if not parts:
        raise ValueError("give a pattern or genes")
    found = separate_text(df, "|".join(parts), column).filter(~F.col("match").isin(*NOT_GENES))
    match = F.col("match")
    tail = F.substring(match, 4, 1 << 20)
    stem = F.lower(F.substring(match, 1, 3))
    each = F.transform(F.filter(F.split(tail, ""), lambda c: c != ""), lambda c: F.concat(stem, c))
    plain = F.array(F.concat(F.lower(F.substring(match, 1, 1)), F.substring(match, 2, 1 << 20)))
    is_operon = (F.length(match) >= operon) & ~tail.rlike("^[0-9]+$")
    return _front(found.withColumn("gene", F.explode(F.when(is_operon, each).otherwise(plain))), "gene", "match")


def separate_tags(df: DataFrame, pattern: str, column: str = "text", strict: bool = True, widest: int = WIDEST) -> DataFrame:
    """One row for each locus tag, ``id`` and ``match`` first; ranges such as ``AB0970-74`` are spelled out.

    A prefix alone stands for tags of it.  The end of a range may repeat the
    prefix or leave out leading digits.  A match of several dashes is an error
    or, if not ``strict``, left out; a range of more than ``widest`` tags gives none.
    """
    regex = pattern if any(c.isdigit() for c in pattern) else f"{pattern}[0-9{pattern}-]+"
    found = separate_text(df, regex, column)
    match = F.regexp_replace("match", "-+$", "")
    dashes = F.regexp_count(match, F.lit("-"))
    found = found.withColumn("__match", match).withColumn("__dashes", dashes)
    if strict:
        wrong = F.concat(F.lit("a tag of several dashes: "), F.col("match"))
        found = found.withColumn("__match", F.when(F.col("__dashes") > 1, F.raise_error(wrong).cast("string")).otherwise(F.col("__match")))
    else:
        found = found.filter(F.col("__dashes") <= 1)
    ends = F.split("__match", "-")
    prefix = F.regexp_extract(ends[0], "^([^0-9]*)", 1)
    first = F.regexp_extract(ends[0], "([0-9]+)$", 1)
    last = F.regexp_extract(F.get(ends, F.lit(1)), "([0-9]+)$", 1)
    # The end takes from the start the leading digits that it leaves out.
    full = F.when(F.length(last) < F.length(first), F.concat(F.substring(first, F.lit(1), F.length(first) - F.length(last)), last)).otherwise(last)
    low, high = first.try_cast("bigint"), full.try_cast("bigint")
    span = F.when((low <= high) & (high - low < widest), F.sequence(low, F.least(F.greatest(low, high), low + widest)))
    tags = F.transform(F.coalesce(span, F.array().cast("array<bigint>")), lambda n: F.concat(prefix, T.zero_pad(n, F.length(first))))
    out = found.withColumn("id", F.explode(F.when(F.size(ends) == 1, F.array(F.col("__match"))).otherwise(tags)))
    return _front(out.drop("__match", "__dashes"), "id", "match")


def sentence_rows(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, paragraph, sentence, text)``: the normalised sentences of every line of a text, both numbered from 1."""
    lined = df.select(key, F.posexplode(T.lines(F.col(text))).alias("paragraph", "line"))
    said = lined.select(key, (F.col("paragraph") + 1).alias("paragraph"), F.posexplode(T.sentences(T.normalize_paragraph(F.col("line")))).alias("sentence", "text"))
    return said.withColumn("sentence", F.col("sentence") + 1)

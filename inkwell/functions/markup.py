"""Markdown building blocks as Column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkwell.functions.text import BLANK

# Genera, and endings of species names, that are set in italics.
GENERA = (
    "Yersinia", "Escherichia", "Salmonella", "Bacillus", "Staphylococcus",
    "Streptococcus", "Pseudomonas", "Mycobacterium", "Clostridium", "Vibrio",
    "Listeria", "Campylobacter", "Helicobacter", "Legionella", "Chlamydia",
)
SPECIES_ENDINGS = ("is", "us", "um", "a", "ae", "ii", "ensis", "icus", "alis")

# What is set as mathematics, and how.
MATH_RULES = (
    (rf"\b([a-zA-Z]){BLANK}*={BLANK}*([0-9.]+)", r"\$$1 = $2\$"),
    (rf"\b(p|P){BLANK}*[<>=]{BLANK}*([0-9.]+)", r"\$$1 \\leq $2\$"),
    (rf"\b(n|N){BLANK}*={BLANK}*([0-9,]+)", r"\$n = $2\$"),
    (r"([0-9.]+)%", r"\$$1\\%\$"),
    (r"([0-9.]+)/([0-9.]+)", r"\$\\frac{$1}{$2}\$"),
)


def math_format(text: Column) -> Column:
    """Equations, probabilities, counts, percentages and fractions set as mathematics, in this order; later rules also see what earlier ones wrote."""
    for pattern, replacement in MATH_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def gene_emphasis(text: Column) -> Column:
    """A capitalised word in italics where `` gene`` follows it, or ``protein`` without a blank."""
    return F.regexp_replace(text, r"\b([A-Z][a-z]+[0-9]*)\b(?=\s+gene|protein)", "*$1*")


def species_emphasis(text: Column) -> Column:
    """``Genus species`` in italics inside a sentence, where either word is a known one and a blank follows."""
    genus, ending = "|".join(GENERA), "|".join(SPECIES_ENDINGS)
    pattern = rf"(?<!^)(?<!\. )\b((?:{genus})\s+[a-z]+|[A-Z][a-z]+\s+[a-z]*(?:{ending}))\b(?=\s)"
    return F.regexp_replace(text, pattern, "*$1*")


def reference_line(number: Column, authors: Column, title: Column, journal: Column, year: Column, volume: Column, pages: Column, doi: Column, pmid: Column) -> Column:
    """One entry of a list of references; absent parts are left out, a DOI goes before a PubMed id."""
    absent = lambda c: F.when(c.isNull() | (c == ""), None).otherwise(c)
    source = F.nullif(
        F.concat_ws(
            " ",
            F.concat(F.lit("*"), absent(journal), F.lit("*")),
            F.concat(F.lit("("), absent(year), F.lit(")")),
            F.concat(F.lit("**"), absent(volume), F.lit("**")),
            absent(pages),
        ),
        F.lit(""),
    )
    link = F.coalesce(F.concat(F.lit("DOI: "), absent(doi)), F.concat(F.lit("PMID: "), absent(pmid)))
    body = F.concat_ws(". ", absent(authors), F.concat(F.lit("**"), absent(title), F.lit("**")), source, link)
    return F.concat(number.cast("string"), F.lit(". "), body)


def table_markdown(name: Column, header: Column, rows: Column) -> Column:
    """A table as Markdown: bold name, header, rule, rows; line ends in cells become spaces and nulls empty."""
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\n", " "))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, cell), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(header, lambda _: F.lit("---")), " | "), F.lit(" |"))
    body = F.array_join(F.transform(rows, line), "\n")
    return F.concat_ws("\n", F.concat(F.lit("**"), name, F.lit("**\n")), line(header), rule, F.when(F.size(rows) > 0, body))


def heading(path: Column) -> Column:
    """The heading of a section path: its last part, the deeper the more parts there are."""
    parts = F.filter(F.transform(F.split(path, ";"), lambda p: F.trim(p)), lambda p: p != "")
    level = F.least(F.size(parts) + 1, F.lit(6))
    return F.concat(F.repeat(F.lit("#"), level), F.lit(" "), F.element_at(parts, -1))


def is_figure(fragment: Column) -> Column:
    return fragment.startswith("**") & fragment.endswith("*") & fragment.contains(":")


def is_table(fragment: Column) -> Column:
    return fragment.startswith("**") & fragment.contains("|")


def paragraphs_of(fragments: Column, most: int = 4) -> Column:
    """Fragments put together until one ends a sentence or ``most`` are reached; figures and tables stand alone."""
    none = F.array().cast("array<string>")

    def close(state: Column) -> Column:
        return F.when(F.size(state["open"]) > 0, F.concat(state["done"], F.array(F.array_join(state["open"], " ")))).otherwise(state["done"])

    def step(state: Column, fragment: Column) -> Column:
        alone = is_figure(fragment) | is_table(fragment)
        grown = F.concat(state["open"], F.array(fragment))
        full = (F.size(grown) >= most) | fragment.rlike("[.!?]$")
        done = (
            F.when(alone, F.concat(close(state), F.array(fragment)))
            .when(full, F.concat(state["done"], F.array(F.array_join(grown, " "))))
            .otherwise(state["done"])
        )
        return F.struct(done.alias("done"), F.when(alone | full, none).otherwise(grown).alias("open"))

    return F.aggregate(fragments, F.struct(none.alias("done"), none.alias("open")), step, close)


def format_paragraph(paragraph: Column) -> Column:
    """Mathematics and emphasis, but for figures and tables."""
    set_ = species_emphasis(gene_emphasis(math_format(paragraph)))
    return F.when(is_figure(paragraph) | is_table(paragraph), paragraph).otherwise(set_)


def section(path: Column, fragments: Column) -> Column:
    """A section: its heading and paragraphs, the heading alone if there are none."""
    body = F.array_join(F.transform(paragraphs_of(fragments), format_paragraph), "\n\n")
    return F.concat_ws("\n\n", heading(path), F.nullif(F.trim(body), F.lit("")))


@F.pandas_udf(StringType())
def front_matter(title: pd.Series, authors: pd.Series, journal: pd.Series, year: pd.Series, pmcid: pd.Series, doi: pd.Series, license: pd.Series) -> pd.Series:
    """The YAML head of a document with its title as heading; absent fields are left out."""
    import yaml

    out = []
    for t, a, j, y, p, d, c in zip(title, authors, journal, year, pmcid, doi, license):
        fields = {"title": t, "authors": list(a) if a is not None else None, "journal": j, "year": None if pd.isna(y) else int(y), "pmcid": p, "doi": d, "license": c}
        kept = {k: v for k, v in fields.items() if v}
        head = f"---\n{yaml.safe_dump(kept, sort_keys=False, allow_unicode=True)}---" if kept else ""
        out.append("\n\n".join(x for x in (head, f"# {t}" if t else "") if x))
    return pd.Series(out)

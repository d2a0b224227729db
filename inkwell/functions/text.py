"""Scalar text functions as Column expressions.

White space is every Unicode blank, the no-break space included, spelled out as
a character class so that other engines can state the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\t-\r\x{85}\p{Z}]"


def collapse_blanks(text: Column) -> Column:
    """Runs of blanks to one space."""
    return F.regexp_replace(text, f"{BLANK}+", " ")


def strip(text: Column) -> Column:
    """Without blanks at either end."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def normalize_paragraph(text: Column) -> Column:
    """The text of a paragraph in its canonical spacing.

    In this order: blanks collapse; a parenthesis of digits, commas, dashes and
    blanks alone becomes a bracket; blanks inside brackets and parentheses and
    before punctuation go; the ends are stripped.  Null stays null.
    """
    steps = (
        (f"{BLANK}+", " "),
        (r"\( ?([0-9 ,-]+?) ?\)", "[$1]"),
        (r"\[ +", "["),
        (r" +\]", "]"),
        (r"\( +", "("),
        (r" +\)", ")"),
        (r" +([.,;:?!])", "$1"),
        ("^ +| +$", ""),
    )
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def sentences(text: Column) -> Column:
    """The sentences of a paragraph: cut after ``.``, ``!`` or ``?`` and blanks; stripped, empty ones left out."""
    marked = F.regexp_replace(text, f"([.!?]+){BLANK}+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), strip), lambda s: s != "")


def lines(text: Column) -> Column:
    """The lines of a text, whatever their ends, blank ones left out."""
    return F.filter(F.split(text, r"\r\n|\r|\n"), lambda s: strip(s) != "")


def license_code(url: Column) -> Column:
    """The short code of a licence address: ``CC0 1.0``, ``CC BY-NC 4.0``; any other address in lower case, none as ``''``."""
    low = F.lower(F.coalesce(url, F.lit("")))
    zero = low.rlike(r"publicdomain/zero|creativecommons\.org/zero")
    version = F.regexp_extract(low, r"zero/([0-9.]+)", 1)
    kind, number = (F.regexp_extract(low, r"licenses/([a-z-]+)/([0-9.]+)", g) for g in (1, 2))
    return (
        F.when(low == "", "")
        .when(zero, F.concat(F.lit("CC0 "), F.when(version == "", "1.0").otherwise(version)))
        .when(kind != "", F.concat(F.lit("CC "), F.upper(kind), F.lit(" "), number))
        .otherwise(low)
    )


def is_blank(value: Column) -> Column:
    """Null, empty or a single blank."""
    return value.isNull() | value.isin("", " ", " ")


def int_if_digits(text: Column) -> Column:
    """A number if the text is all digits, else null."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def unfold(text: Column) -> Column:
    """A line end with its indentation to one space."""
    return F.regexp_replace(text, f"[\r\n]{BLANK}*", " ")


def zero_pad(number: Column, width: Column) -> Column:
    """A number with leading zeros up to a width; a longer one stays whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(width, F.length(digits)), F.lit("0"))


def stem(path: Column) -> Column:
    """A path's file name without directories and last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]+)?$", 1)


def cache_key(*parts: Column) -> Column:
    """The md5 of the UTF-8 text of all parts."""
    return F.md5(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]))


def join_articles(texts: Column) -> Column:
    """Several articles under numbered headings as one context."""
    total = F.size(texts)
    numbered = F.transform(texts, lambda t, i: F.concat(F.lit("# Article "), (i + 1).cast("string"), F.lit("/"), total.cast("string"), F.lit(":\n\n"), t))
    return F.array_join(numbered, "\n\n")


def fill(template: str, *values: Column) -> Column:
    """A prompt template with each ``{}`` in turn replaced by a value."""
    parts = template.split("{}")
    if len(parts) != len(values) + 1:
        raise ValueError(f"the template has {len(parts) - 1} slots for {len(values)} values")
    pieces = [F.lit(parts[0])]
    for value, after in zip(values, parts[1:]):
        pieces += [F.coalesce(value, F.lit("")), F.lit(after)]
    return F.concat(*pieces)


def word_count(text: Column) -> Column:
    """The number of stretches between blanks."""
    bare = strip(text)
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"{BLANK}+")))

"""Several values packed into one field: the cheapest dialect splits it.

A dialect says which characters separate values, whether quotes enclose one,
whether joining words separate, and what a comma means.  Every dialect parses
every form of field found in the data; a value costs the bits of its shape in a
code built from the shapes' counts over all forms of the table, an unseen shape the
bits of spelling it out.  The dialect with the shortest description parses the
fields of that form.

Fields of one form are parsed alike by every dialect, so that one of them
stands for all.  A form counts once in the code, not once for each field: were
fields counted, one house style of a third of the rows would set the code of
all others (on the test tables that splits four in ten values wrongly).  Forms
are made before anything is shuffled, so that a form that a third of the rows
share is one row; rows find their form's dialect by a salted join.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import cut_lineage

SALTS = 16
SPELL_BITS = 2.5
ESCAPE_BITS = 4.0
REPEAT_BITS = 1.0
DIALECT_BITS = 0.5
UNBALANCED_BITS = 20.0

# Words that join or end a list of authors, and suffixes of a name.
JOINING = ("and", "&", "und", "et", "y", "e")
_ET_AL = re.compile(r"(?:^|[\s,;])\s*et\s+al\b\.?\s*$", re.IGNORECASE)
_SUFFIX = re.compile(r"(?:Jr|Sr|I{2,3}|IV|V|\d(?:st|nd|rd|th))\.?", re.IGNORECASE)
_LETTERS = re.compile(r"[^\W\d_]+")
_SHAPE_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+|\s+|.", re.DOTALL)
_INITIALS = re.compile(r"A\.(?: ?A\.)+")
_INDENTED = re.compile(r"\s*\n[^\S\n]+")  # a folded line; a bare line end may separate values
_REPEATED = re.compile(r"(.{2,40}?)\1{2,}")


@dataclass(frozen=True)
class Dialect:
    """How a field is packed."""

    separators: str
    quoted: bool
    joined: bool
    comma: str  # "separates", "inside", or "either": inside before initials or a suffix

    @property
    def bits(self) -> float:
        """The cost of stating the dialect: each separator and each rule."""
        return DIALECT_BITS * (len(self.separators) + self.quoted + self.joined + (self.comma == "either"))


def _dialects() -> tuple[Dialect, ...]:
    single = [(s, "inside") for s in (";", "|", "/", "\t", "\n", "•", "；", "、")]
    mixed = [(",", "separates"), (",", "either"), (";,", "either"), ("|,", "either"), (";|,", "either"), (";|", "inside"), ("", "inside")]
    return tuple(
        Dialect(separators, quoted, joined, comma)
        for separators, comma in [*single, *mixed]
        for quoted in (False, True)
        for joined in (False, True)
    )


DIALECTS = _dialects()
_BY_COST = sorted(range(len(DIALECTS)), key=lambda k: (DIALECTS[k].bits, k))


def _is_initials(item: str) -> bool:
    letters = "".join(_LETTERS.findall(item))
    return bool(letters) and len(letters) <= 4 and letters.isupper() and not re.search(r"\d", item)


def _is_tail(item: str) -> bool:
    """Initials or a suffix: what stays with the name before it."""
    return bool(_SUFFIX.fullmatch(item)) or _is_initials(item)


@cache
def _delimiter(separators: str, quoted: bool, joined: bool) -> re.Pattern | None:
    """What may end a value: a quoted stretch, a separator or a joining word."""
    parts = []
    if quoted:
        parts.append(r'"(?P<quote>(?:[^"]|"")*)"')
    if separators:
        parts.append(f"(?P<separator>[{re.escape(separators)}])")
    if joined:
        parts.append(r"(?<![^\s,;|])(?:and|&)(?=\s)")
    return re.compile("|".join(parts), re.IGNORECASE) if parts else None


def _segments(text: str, dialect: Dialect) -> Iterator[tuple[str, str, bool]]:
    """``(value, the separator before it, whether it was quoted)``."""
    start, before = 0, ""
    delimiter = _delimiter(dialect.separators, dialect.quoted, dialect.joined)
    at = 0
    while delimiter and (found := delimiter.search(text, at)):
        at = found.end()
        groups = found.groupdict()
        if groups.get("quote") is not None:
            if text[start : found.start()].strip():
                at = found.start() + 1  # a quote inside a value is a mark like others
                continue
            yield groups["quote"].replace('""', '"'), before, True
            before, start = " ", at
            continue
        yield text[start : found.start()], before, False
        before, start = groups.get("separator") or "and", at
    yield text[start:], before, False


def parse(text: str, dialect: Dialect) -> list[str]:
    """The values of a field in order, blanks collapsed; empty places and "et al." are none."""
    fold = _INDENTED.sub(" ", text.strip())
    out: list[str] = []
    open_name = False
    for raw, before, quoted in _segments(fold, dialect):
        value = " ".join(raw.split())
        if not quoted:
            value = _ET_AL.sub("", value).strip()
            value = value.strip(" ,;|") if dialect.comma != "inside" else value.rstrip(" ,").lstrip(" ,;|")
        if not value:
            open_name = open_name and before == ","
            continue
        if dialect.comma == "either" and before == "," and open_name and not quoted and _is_tail(value):
            out[-1] += f", {value}"
            continue
        out.append(value)
        open_name = not quoted
    return out


def shape(value: str) -> str:
    """The form of a value: words by their case and length class, marks as they are."""
    out = []
    for token in _SHAPE_TOKEN.findall(value):
        if token.isspace():
            out.append("\n" if "\n" in token else "\t" if "\t" in token else " ")
        elif token[0].isalpha():
            if token.lower() in ("and", "et", "al", "of", "for", "on", "jr", "sr"):
                out.append(token.lower())
            elif token.isupper():
                out.append("A" if len(token) <= 4 else "AAAAA")
            else:
                out.append("Aa" if token[0].isupper() else "a")
        else:
            out.append("9" if token.isdigit() else token)
    return _INITIALS.sub("A.", "".join(out))


def form_of(text: str) -> str:
    """The form of a whole field: its shape, where what repeats stands twice."""
    return _REPEATED.sub(r"\1\1", shape(_INDENTED.sub(" ", text.strip())))


def _applies(dialect: Dialect, text: str, marks: set[str]) -> bool:
    """Whether each rule of the dialect has something to do in the text; else a cheaper one parses it alike."""
    if not all(s in marks for s in dialect.separators) or (dialect.quoted and '"' not in marks):
        return False
    return not dialect.joined or "&" in marks or "and" in text.lower()


def _shape_cost(value_shape: str) -> float:
    """The bits of spelling out a shape; a quote that is opened in one value and closed in another is dear."""
    return SPELL_BITS * len(_SHAPE_TOKEN.findall(value_shape)) + UNBALANCED_BITS * (value_shape.count('"') % 2)


def dialect_of_forms(forms: DataFrame, rounds: int = 3) -> DataFrame:
    """``(form, dialect)`` from ``(form, sample)``: the dialect of the shortest description of each form."""

    def parses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for form, sample in zip(frame["form"], frame["sample"]):
                seen: dict[tuple[str, ...], int] = {}
                marks = set(_INDENTED.sub(" ", sample.strip()))
                for number in _BY_COST:
                    if not _applies(DIALECTS[number], sample, marks):
                        continue
                    seen.setdefault(tuple(shape(v) for v in parse(sample, DIALECTS[number])), number)
                rows += [(form, number, 1.0 / len(seen), list(values)) for values, number in seen.items()]
            yield pd.DataFrame(rows, columns=["form", "dialect", "weight", "shapes"])

    parsed = cut_lineage(forms.mapInPandas(parses, "form string, dialect int, weight double, shapes array<string>"))
    costs = F.array(*[F.lit(d.bits) for d in DIALECTS])

    def bits(dialect: str) -> Column:
        return F.get(costs, F.col(dialect))

    @F.pandas_udf("double")
    def spelled(shapes: pd.Series) -> pd.Series:
        return shapes.map(_shape_cost)

    used = parsed
    best = None
    for _ in range(rounds):
        counts = used.select(F.explode(F.array_distinct("shapes")).alias("shape"), "weight").groupBy("shape").agg(F.sum("weight").alias("count"))
        counts = cut_lineage(counts)
        total = float(counts.agg(F.sum("count")).head()[0] or 1.0)
        code = counts.select("shape", (-F.log2(F.col("count") / total) + spelled("shape") / F.col("count")).alias("code"))
        values = parsed.select("form", "dialect", F.explode_outer("shapes").alias("shape"))
        # A code book holds a shape once: the bits of spelling it are shared by its uses.
        # A value of the same shape as another one of its field costs little.
        values = values.groupBy("form", "dialect", "shape").agg(F.count("*").alias("times"))
        unbalanced = UNBALANCED_BITS * F.pmod(F.regexp_count(F.coalesce("shape", F.lit("")), F.lit('"')), F.lit(2))
        known = F.coalesce("code", F.lit(math.inf)) + unbalanced
        cost = F.least(known, spelled(F.coalesce("shape", F.lit(""))) + ESCAPE_BITS)
        scored = values.join(code, "shape", "left").groupBy("form", "dialect").agg(F.sum(cost + (F.col("times") - 1) * REPEAT_BITS).alias("bits"))
        best = scored.groupBy("form").agg(F.min_by("dialect", F.struct(F.col("bits") + bits("dialect"), "dialect")).alias("dialect"))
        best = cut_lineage(best)
        used = parsed.join(best, ["form", "dialect"])
    return best


def split_packed(rows: DataFrame, key: str, packed: str, value: str = "value") -> DataFrame:
    """``(key, pos, value)``: one row for each value of the packed field, ``pos`` from 1.

    A null, empty or blank field gives no row, a field of one value one row.
    Repeated rows of one key give the same rows once.  Other columns are
    dropped.  An empty table gives an empty result.
    """
    kind = rows.schema[key].dataType.simpleString()
    fields = rows.select(key, F.col(packed).alias("__packed")).filter(F.col("__packed").isNotNull())
    # Equal rows of a key meet here, one row each, instead of value by value at the end; the same shuffle spreads the scan.
    fields = fields.dropDuplicates([key, "__packed"])

    def form(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["form"] = [form_of(t) for t in frame["__packed"]]
            yield frame

    formed = cut_lineage(fields.mapInPandas(form, f"`{key}` {kind}, __packed string, form string"))
    forms = formed.groupBy("form").agg(F.min("__packed").alias("sample"))
    chosen = dialect_of_forms(forms)
    salted = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    matched = formed.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(salted, ["form", "salt"])

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [
                (k, pos, v)
                for k, text, number in zip(frame[key], frame["__packed"], frame["dialect"])
                for pos, v in enumerate(parse(text, DIALECTS[number]), 1)
            ]
            yield pd.DataFrame(out, columns=[key, "pos", value]).astype({"pos": "int32"})

    out = matched.select(key, "__packed", "dialect").mapInPandas(split, f"`{key}` {kind}, pos int, `{value}` string")
    # A key may have several different fields, which may have values in common.
    several = formed.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(key)
    if several.isEmpty():
        return out
    return out.distinct()

"""Schemas of the relations the engine reads and makes."""

from __future__ import annotations

from pyspark.sql import types as t


_TYPES = {"string": t.StringType(), "int": t.IntegerType(), "float": t.FloatType(), "boolean": t.BooleanType()}


def _type(text: str) -> t.DataType:
    return t.ArrayType(_type(text[6:-1])) if text.startswith("array<") else _TYPES[text]


def _struct(text: str) -> t.StructType:
    """Fields as ``name type`` between commas; needs no session, as a DDL parse would."""
    return t.StructType([t.StructField(name, _type(kind)) for name, kind in (field.split() for field in text.split(","))])


METADATA = _struct(
    "pmc_id string, pmid string, doi string, title string, authors array<string>, year int, month int, day int, "
    "license_url string, license string, journal string, journal_abbrev string, issn string"
)
TEXT = _struct("section string, paragraph int, sentence int, text string")
REFERENCE = _struct("id int, pmid string, authors string, year string, title string, journal string, volume string, pages string, doi string")
TABLE = _struct("pos int, label string, caption string, header array<string>, rows array<array<string>>")
COLLAPSED = _struct("table string, row int, text string")
CLUSTER = _struct("texts array<string>, embeds array<array<float>>, avg_similarity float")
EMBED_CACHE = _struct("hash string, embedding array<float>")
ARTICLE = t.StructType(
    [
        t.StructField("error", t.StringType()),
        t.StructField("article_type", t.StringType()),
        t.StructField("meta", t.StructType([f for f in METADATA.fields if f.name != "license"])),
        t.StructField("sections", t.ArrayType(_struct("pos int, section string, kind string, paragraph int, text string"))),
        t.StructField("tables", t.ArrayType(TABLE)),
        t.StructField("refs", t.ArrayType(REFERENCE)),
        t.StructField("topic_text", t.StringType()),
    ]
)
QA = _struct("question string, answer string, strict boolean")
RUBRIC = _struct("difficulty string, askability int, synthesizability int, abstractiveness int, conflict_synthesis int, strict boolean")
JUDGEMENT = _struct("extracted_final_answer string, reasoning string, correct string, strict boolean")
RECORD = t.StructType(
    [
        t.StructField("sample_id", t.IntegerType()),
        t.StructField("qa", QA),
        t.StructField("rubric", RUBRIC),
        t.StructField("judge_with_context", JUDGEMENT),
        t.StructField("judge_without_context", JUDGEMENT),
    ]
)
QA_CACHE = t.StructType([t.StructField("hash", t.StringType()), t.StructField("response", RECORD)])

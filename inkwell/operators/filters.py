"""Predicates of the ingest and of accepted question-answer records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions import text as T

# Marks of licences that forbid derivatives, topics of interest, and difficulties worth keeping.
REFUSED_LICENSES = ("BY-ND", "BY ND")
TOPIC = r"\b(obesity|weight[\s\-]?loss|diabetes|diabetic)\b"
HARD_DIFFICULTY = ("graduate", "phd")
SCORES = ("askability", "synthesizability", "abstractiveness", "conflict_synthesis")


def license_allowed(license: Column, refused: tuple[str, ...] = REFUSED_LICENSES) -> Column:
    """A licence is given and holds none of the refused marks."""
    upper = F.upper(F.coalesce(license, F.lit("")))
    out = upper != ""
    for mark in refused:
        out = out & ~upper.contains(mark)
    return out


def is_type(article_type: Column, wanted: str = "research-article") -> Column:
    return F.lower(F.coalesce(article_type, F.lit(""))) == wanted


def on_topic(*texts: Column, pattern: str = TOPIC) -> Column:
    """Any of the texts (title, abstract, keywords) names the topic; null says nothing."""
    joined = F.lower(F.concat_ws(" ", *texts))
    return F.coalesce(joined.rlike(pattern), F.lit(False))


def ingest_status(license: Column, article_type: Column, topic: Column, error: Column | None = None) -> Column:
    """``error``, ``filtered`` or ``saved``: licence, then type, then topic."""
    failed = F.lit(False) if error is None else error.isNotNull()
    passed = license_allowed(license) & is_type(article_type) & topic
    return F.when(failed, "error").when(passed, "saved").otherwise("filtered")


def within_budget(text: Column, most: int, spare: int = 0, counter=T.word_count) -> Column:
    """A text has at most ``most`` tokens with ``spare`` for what is put around it; null has none."""
    return F.coalesce(counter(text), F.lit(0)) + spare <= most


def accepted(record: str, difficulties: tuple[str, ...] = HARD_DIFFICULTY, least: int = 4) -> Column:
    """A record whose every part is there, answered with context but not without, hard enough and scored ``least`` in all."""
    c = lambda path: F.col(f"{record}.{path}")
    whole = c("qa").isNotNull() & c("rubric").isNotNull() & c("judge_with_context").isNotNull() & c("judge_without_context").isNotNull()
    judged = (c("judge_with_context.correct") == "yes") & (c("judge_without_context.correct") == "no")
    scored = c("rubric.difficulty").isin(*difficulties)
    for score in SCORES:
        scored = scored & (c(f"rubric.{score}") >= least)
    return F.coalesce(whole & judged & scored, F.lit(False))


def is_hard(record: str) -> Column:
    """Accepted and of the highest difficulty."""
    return accepted(record, ("phd",))


def valid_record(record: str) -> Column:
    """The parts that are there keep to their domains: enumerations, scores of 0 to 5, the strict flag."""
    c = lambda path: F.col(f"{record}.{path}")
    absent = lambda path, ok: c(path).isNull() | F.coalesce(ok, F.lit(False))
    out = absent("qa", c("qa.question").isNotNull() & c("qa.answer").isNotNull() & c("qa.strict"))
    rubric = c("rubric.difficulty").isin("high school", *HARD_DIFFICULTY) & c("rubric.strict")
    for score in SCORES:
        rubric = rubric & c(f"rubric.{score}").between(0, 5)
    out = out & absent("rubric", rubric)
    for judge in ("judge_with_context", "judge_without_context"):
        out = out & absent(judge, c(f"{judge}.correct").isin("yes", "no") & c(f"{judge}.strict"))
    return out

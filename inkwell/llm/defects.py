"""Defects of question-answer pairs.

Languages are told apart by naive Bayes over character n-grams, fitted on a
bounded sample of labelled texts (``PER_LANGUAGE`` of each language); a pair is
in two languages if each text's own language is near certain against the
other's.  Whether an answer breaks off is told by the likelihood that a
sentence ends after its last characters, from n-gram counts inside all answers
(not at their ends, which may be broken).  Whether it declines is told by a
classifier of sentences (``refusals``).  The models hash n-grams into tables of
fixed size, which is what tasks add up and share, however many rows there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.refusals import Refusals, fit_refusals
from inkwell.session import spread

PER_LANGUAGE = 300
LANGUAGE_BITS = 16
CERTAIN = 0.98  # least posterior of a text's own language
ORDERS = (1, 2, 3)  # each character is counted in so many n-grams, by which the evidence is divided
SENTENCES = 12  # one in so many sentences of the sample is a statement for the classifier of refusals
END_BITS = 18
# Length, and whether letters count alike.  The longest is kept under two hashes, of which the emptier bucket counts.
END_ORDERS = ((1, True), (3, True), (6, True), (7, False), (7, False))
END_WEIGHT = 4.0
END_LEAST = 0.3
SHORT_WORDS, SHORT_CHARS = 4, 15
CHUNK = 1 << 14

# Names of languages in other codes.
LANGUAGE_CODES = {"eng": "en", "ger": "de", "deu": "de", "fre": "fr", "fra": "fr", "spa": "es", "por": "pt", "chi": "zh", "zho": "zh"}

# Answers that stand for none.
NO_CONTENT = {"", "n/a", "na", "null", "none", "nil", "nan", "empty", "blank", "no answer", "tbd"}

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?。])\s*(?=\S)|\n+")
_DIGIT = re.compile(r"\d")
_SYMBOL = re.compile(r"[A-Za-z]*(?:\d|[a-z][A-Z])[A-Za-z0-9]*")
_BOUNDARY = re.compile(r"[^\s](?=\n|[^\S\n]+[A-ZÀ-ÖØ-Þ\"“«¿¡\[(-])|[。！？](?=.)")
_OPENING = {")": "(", "]": "[", "”": "“", "»": "«", "）": "（", "’": "‘"}
_CODE = re.compile(r"[^\W_]*(?:\d|[^\W\d_A-Z][A-Z]|[A-Z]{2})[^\W_]*")
_LETTER = re.compile(r"[^\W\d_]")
_ELLIPSIS = re.compile(r"(?:\.\.\.|…)[\])]?$")
_QUOTED = re.compile(r"«[^»]*»|“[^”]*”|„[^“”]*[“”]")
_LEAD = re.compile(r"^\s*(?:question|q|frage|pregunta|pergunta|问题)\s*[:：.]\s*", re.IGNORECASE)


def language(label: Column) -> Column:
    """A language label in its two-letter code."""
    known = F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair])
    low = F.lower(F.trim(label))
    return F.coalesce(F.try_element_at(known, low), F.when(F.length(low) >= 2, F.substring(low, 1, 2)))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)


def _windows(codes: np.ndarray, order: int, bits: int, salt: int = 0) -> np.ndarray:
    """The bucket of every n-gram."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    total = np.full(n, order + (salt << 8), dtype=np.uint64)
    for k in range(order):
        total = (total ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return (total >> np.uint64(64 - bits)).astype(np.int64)


def language_grams(text: str) -> np.ndarray:
    """Buckets of a text's letter n-grams of one to three; marks and codes (words of a digit or an inner capital) are left out."""
    words = " ".join(_WORD.findall(_SYMBOL.sub(" ", text).lower()))
    codes = _codes(f" {words} ")
    return np.concatenate([_windows(codes, order, LANGUAGE_BITS) for order in ORDERS])


@dataclass
class Languages:
    names: list[str]
    logs: np.ndarray

    def scores(self, text: str) -> np.ndarray:
        """The log-likelihood of a text in each language."""
        return self.logs[:, language_grams(text)].sum(axis=1)


def fit_languages(labelled: DataFrame, text: str, label: str, key: str, per_language: int = PER_LANGUAGE) -> tuple[Languages, list[str]]:
    """Naive Bayes from ``per_language`` labelled texts of each language, those of the smallest key hashes; and one in ``SENTENCES`` of their sentences."""
    rows = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), language(F.col(label)).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.length("t") > 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k")
    sample = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_language).select("lang", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        picked: set[tuple[str, str]] = set()
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = tables.setdefault(lang, np.zeros(1 << LANGUAGE_BITS, dtype=np.int64))
                table += np.bincount(language_grams(body), minlength=len(table))
                picked |= {(lang, s[:400]) for s in _SENTENCE.split(body) if len(s) > 3 and crc32(s.encode("utf-8", "replace")) % SENTENCES == 0}
        for lang, table in tables.items():
            where = np.flatnonzero(table)
            said = sorted(s for x, s in picked if x == lang)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(where) + len(said)), pa.string()),
                    pa.array([*where.tolist(), *[-1] * len(said)], pa.int64()),
                    pa.array([*table[where].tolist(), *[0] * len(said)], pa.int64()),
                    pa.array([*[None] * len(where), *said], pa.string()),
                ],
                names=["lang", "bucket", "n", "said"],
            )

    counts = sample.mapInArrow(count, "lang string, bucket bigint, n bigint, said string").groupBy("lang", "bucket", "said").agg(F.sum("n").alias("n")).toPandas()
    said = sorted(counts.loc[counts["bucket"] < 0, "said"])
    counts = counts[counts["bucket"] >= 0]
    names = sorted(counts["lang"].unique())
    table = np.full((len(names), 1 << LANGUAGE_BITS), 0.5)
    for i, name in enumerate(names):
        part = counts[counts["lang"] == name]
        table[i, part["bucket"]] += part["n"]
    return Languages(names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)), said


@dataclass
class Endings:
    """Of every n-gram bucket, how often a sentence ends after it and how often it occurs, inside texts."""

    ends: np.ndarray
    all: np.ndarray

    def likelihood(self, text: str) -> float:
        """How likely a sentence ends where this text does: the lesser of its last character's and its longest n-gram's, which leans on the shorter ones."""
        views = ending_views(text)
        p = last = before = float(self.ends[0].sum() / max(self.all[0].sum(), 1))
        fewest = -1
        for i, (order, alike) in enumerate(END_ORDERS):
            if len(views[alike]) < order:
                break
            bucket = _windows(views[alike][-order:], order, END_BITS, i)[0]
            seen, ended = self.all[i, bucket], self.ends[i, bucket]
            if not alike and 0 <= fewest <= seen:
                continue
            p = (ended + END_WEIGHT * before) / (seen + END_WEIGHT)
            if alike:
                before = p
            else:
                fewest = seen
            last = p if i == 0 else last
        return min(p, last)


def ending_views(text: str) -> dict[bool, np.ndarray]:
    """A text's characters as the ending model sees them: digits alike, letters alike or as they are but for those of codes and symbols."""
    plain = _CODE.sub(lambda m: _LETTER.sub("a", m[0]), text.rstrip())
    plain = _DIGIT.sub("0", plain)
    return {True: _codes(_LETTER.sub("a", plain)), False: _codes(plain)}


def sentence_ends(text: str) -> np.ndarray:
    """Whether a sentence ends after each character but the last: before a line end, or blanks and a capital or mark."""
    ends = np.zeros(max(len(text) - 1, 0), dtype=bool)
    for found in _BOUNDARY.finditer(text):
        ends[found.start()] = True
    return ends


def is_closed(text: str) -> bool:
    """Ends in a closing bracket or quote that was opened in the text."""
    last = text.rstrip()[-1:]
    if last in _OPENING:
        return text.count(_OPENING[last]) >= text.count(last)
    return last == '"' and text.count('"') % 2 == 0


def fit_endings(answers: DataFrame, text: str) -> Endings:
    """The ending model over all rows.

    Tasks hand on tables of fixed size, those parts of them that are not zero;
    they are added up in two levels, so that no task adds more than the root of
    the tasks' number.
    """
    orders, size = len(END_ORDERS), 1 << END_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, orders, size), dtype=np.int64)
        waiting: list[list[list[np.ndarray]]] = [[[] for _ in END_ORDERS] for _ in range(2)]
        held = 0

        def settle() -> None:
            for kind in range(2):
                for i in range(orders):
                    if waiting[kind][i]:
                        table[kind, i] += np.bincount(np.concatenate(waiting[kind][i]), minlength=size)
                        waiting[kind][i].clear()

        for batch in batches:
            for body in batch.column(0).to_pylist():
                views, plain = ending_views(body), body.rstrip()
                ended = sentence_ends(plain)
                # After letters and digits a single character's count tells all there is to tell.
                marks = np.array([not c.isalnum() for c in plain[:-1]], dtype=bool)
                for i, (order, alike) in enumerate(END_ORDERS):
                    found = _windows(views[alike], order, END_BITS, i)[:-1]
                    keep = np.ones(len(found), dtype=bool) if order == 1 else marks[order - 1 :]
                    waiting[1][i].append(found[keep])
                    waiting[0][i].append(found[keep & ended[order - 1 :]])
                held += len(plain)
                if held > 2_000_000:
                    settle()
                    held = 0
        settle()
        flat = table.reshape(-1, CHUNK)
        where = [i for i in range(len(flat)) if flat[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(where, pa.int32()), pa.array([flat[i].tobytes() for i in where], pa.binary())], names=["chunk", "counts"]
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, dtype=np.int64)
        for c in frame["counts"]:
            total += np.frombuffer(c, dtype=np.int64)
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "counts": [total.tobytes()]})

    # A task's table is a hundred times its rows if it has few: not more tasks than a few for each slot.
    slots = answers.sparkSession.sparkContext.defaultParallelism
    rows = answers.select(text).filter(F.length(text) > 0).coalesce(4 * slots)
    parts = rows.mapInArrow(count, "chunk int, counts binary")
    if slots > 16:
        share = int((4 * slots) ** 0.5)
        salted = parts.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(share)))
        parts = salted.groupBy("chunk", "share").applyInPandas(add, "chunk int, counts binary")
    table = np.zeros((2 * orders * size // CHUNK, CHUNK), dtype=np.int64)
    for row in parts.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        table[row.chunk] = np.frombuffer(bytes(row.counts), dtype=np.int64)
    ends, whole = table.reshape(2, orders, size)
    return Endings(ends, whole)


def is_empty(answer: str | None) -> bool:
    """No answer, or nothing in it that says anything."""
    if answer is None:
        return True
    low = answer.strip().strip("[](){}<>\"'").strip().lower()
    return low in NO_CONTENT or not _WORD.search(low)


def is_copied(question: str | None, answer: str) -> bool:
    """The words of the question, once or several times, with or without a lead, and nothing else."""
    asked = _WORD.findall((question or "").lower())
    said = _WORD.findall(_LEAD.sub("", answer).lower())
    if not asked or len(said) < len(asked):
        return False
    times, rest = divmod(len(said), len(asked))
    return rest == 0 and said == asked * times


def certainty(scores: np.ndarray, own: int, other: int) -> float:
    """The posterior of one language against another, equal before; the n-grams of the ``ORDERS`` say the same thing as often."""
    return float(1 / (1 + np.exp(np.clip((scores[other] - scores[own]) / len(ORDERS), -500, 500))))


def is_foreign(languages: Languages, question: str | None, answer: str) -> bool:
    """Question and answer are each near certain to be in their own language rather than in the other's."""
    if not question or len(languages.names) < 2:
        return False
    own = _QUOTED.sub(" ", answer)  # a quotation may be in another language
    asked, said = languages.scores(question), languages.scores(own if len(_WORD.findall(own)) >= SHORT_WORDS else answer)
    q, a = int(asked.argmax()), int(said.argmax())
    return q != a and certainty(asked, q, a) > CERTAIN and certainty(said, a, q) > CERTAIN


def is_short(answer: str) -> bool:
    """A name, a number with its unit: no sentence that could break off."""
    return len(answer.strip()) <= SHORT_CHARS and len(_WORD.findall(answer)) <= SHORT_WORDS


def breaks_off(endings: Endings, answer: str) -> bool:
    """Ends with an ellipsis, or where no sentence is likely to end."""
    if _ELLIPSIS.search(answer.rstrip()):
        return True
    return not is_closed(answer) and endings.likelihood(answer) < END_LEAST


def defect_of(languages: Languages, endings: Endings, refusals: Refusals, question: str | None, answer: str | None) -> str | None:
    if is_empty(answer):
        return "empty"
    if is_copied(question, answer):
        return "copied_question"
    if refusals.is_refusal(answer):
        return "refusal"
    if is_foreign(languages, question, answer):
        return "other_language"
    if not is_short(answer) and breaks_off(endings, answer):
        return "truncated"
    return None


def defects(
    pairs: DataFrame, labelled: DataFrame, key: str = "qa_id", question: str = "question", answer: str = "answer",
    text: str = "text", label: str = "lang", label_key: str = "doc_id",
) -> DataFrame:
    """``(key, defect)``: the defective pairs with the type of their defect, at most one each.

    Types: ``empty``, ``copied_question``, ``refusal``, ``other_language``,
    ``truncated``, in that order.  A null answer is empty; a null question
    makes no answer foreign or copied.  Repeated rows repeat their result;
    other columns are dropped; an empty table gives an empty result; without
    labelled texts no pair is foreign.
    """
    rows = pairs.select(F.col(key).alias("k"), F.col(question).alias("q"), F.col(answer).alias("a"))
    languages, said = fit_languages(labelled, text, label, label_key)
    endings = fit_endings(rows, "a")
    shared = pairs.sparkSession.sparkContext.broadcast((languages, endings, fit_refusals(said)))  # tables of fixed size
    kind = rows.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            found = [defect_of(*models, q, a) for q, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            defect = pa.array(found, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), defect], names=[key, "defect"]).filter(defect.is_valid())

    return spread(rows, "k").mapInArrow(run, f"`{key}` {kind}, defect string")

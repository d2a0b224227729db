"""Mentions of known terms in texts and their concepts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: An automaton goes to every task, so that the number of terms has a bound; a larger gazetteer is cut into parts.
MOST_TERMS = 500_000


def mentions(texts: DataFrame, terms: list[str], key: str, text: str = "text") -> DataFrame:
    """``(key, pos, mention)``: whole-word mentions of the terms, whatever their case, by place; the longest of those that begin alike.

    Null texts have none.
    """
    if len(terms) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms; call once for each part of them")
    kind = texts.schema[key].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(sorted({t.lower() for t in terms if t}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in shared.value:
            automaton.add_word(term, len(term))
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            owner, places, found = [], [], []
            for row, body in enumerate(batch.column(1).to_pylist() if len(automaton) else []):
                low = (body or "").lower()
                best: dict[int, int] = {}
                for end, length in automaton.iter(low):
                    start = end - length + 1
                    if (start == 0 or not low[start - 1].isalnum()) and (end + 1 == len(low) or not low[end + 1].isalnum()):
                        best[start] = max(length, best.get(start, 0))
                for start in sorted(best):
                    owner.append(row)
                    places.append(start)
                    found.append(low[start : start + best[start]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(places, pa.int32()), pa.array(found, pa.string())],
                names=[key, "pos", "mention"],
            )

    return texts.select(key, text).mapInArrow(run, f"`{key}` {kind}, pos int, mention string")


def link(found: DataFrame, aliases: DataFrame, key: str, least: float = 0.7) -> DataFrame:
    """``(key, pos, mention, concept, score)``: of each mention the concept of the best-scored alias of at least ``least``.

    ``aliases`` is ``(alias, concept, score)``; ties go to the smaller concept.
    """
    good = aliases.filter(F.col("score") >= least).withColumn("alias", F.lower("alias"))
    rank = Window.partitionBy("alias").orderBy(F.desc("score"), "concept")
    best = good.withColumn("n", F.row_number().over(rank)).filter(F.col("n") == 1)
    return found.join(best.select(F.col("alias").alias("mention"), "concept", "score"), "mention").select(key, "pos", "mention", "concept", "score")


def concepts_of(linked: DataFrame, key: str) -> DataFrame:
    """``(key, concepts)``: the concepts of each text in the order of their mentions, repeats kept."""
    some = F.array_sort(F.collect_list(F.struct("pos", "concept")))
    return linked.groupBy(key).agg(F.transform(some, lambda x: x["concept"]).alias("concepts"))

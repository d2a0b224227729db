"""Clusters to question-answer pairs, their splits, and the accuracy of a model on them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import filters as P
from inkwell.operators.cliques import keep_first, similar
from inkwell.operators.relational import accuracy, first_per_value, through_cache
from inkwell.plans.embed import PROBES, embed
from inkwell.providers import Embedder, Model, Pool, with_retries
from inkwell.schemas import EMBED_CACHE, RECORD
from inkwell.sources.jsonl import CacheLog

PROMPTS = "prompts-2"
EMPTY = {"qa": None, "rubric": None, "judge_with_context": None, "judge_without_context": None}


TEXT, FLAG = (lambda x: isinstance(x, str) and bool(x)), (lambda x: x is True)
SCORE = lambda x: isinstance(x, int) and not isinstance(x, bool) and 0 <= x <= 5
YES_NO = lambda x: x in ("yes", "no")
DIFFICULTY = lambda x: isinstance(x, str) and x in ("high school", *P.HARD_DIFFICULTY)

#: The domains of the fields of a reply; one outside them makes the whole reply none.
QA_FORM = {"question": TEXT, "answer": TEXT, "strict": FLAG}
RUBRIC_FORM = {"difficulty": DIFFICULTY, **{score: SCORE for score in P.SCORES}, "strict": FLAG}
JUDGE_FORM = {"extracted_final_answer": TEXT, "reasoning": TEXT, "correct": YES_NO, "strict": FLAG}


def _form(reply: str | None, domains: dict[str, Callable[[object], bool]]) -> dict | None:
    """A JSON reply whose fields are all there and within their domains, without others; else None."""
    try:
        out = json.loads(reply or "")
    except (ValueError, RecursionError):
        return None
    if not isinstance(out, dict) or not all(f in out and fits(out[f]) for f, fits in domains.items()):
        return None
    return {f: out[f] for f in domains}


def judge_prompt(question: str, given: str, expected: str) -> str:
    return f"TASK: judge\nQUESTION: {question}\nRESPONSE: {given}\nEXPECTED: {expected}"


def synthesize(model: Model, context: str, limited: Callable[[], None] | None = None) -> dict:
    """A pair from a context, its rubric, and whether it is answered without and with the context; any missing step gives an empty record."""
    ask = lambda prompt: with_retries(lambda: model.complete(prompt), limited=limited)
    qa = _form(ask(f"TASK: question\n{context}"), QA_FORM)
    if qa is None:
        return EMPTY
    rubric = _form(ask(f"TASK: rubric\n{context}\nANSWER: {qa['answer']}\nQUESTION: {qa['question']}"), RUBRIC_FORM)
    if rubric is None:
        return EMPTY
    judged = []
    # The answer that is judged comes from the question alone, then from context and question; neither prompt holds the expected one.
    for prompt in (f"TASK: answer\n{qa['question']}", f"TASK: answer with context\n{context}\nQUESTION: {qa['question']}"):
        given = ask(prompt)
        verdict = None if given is None else _form(ask(judge_prompt(qa["question"], given, qa["answer"])), JUDGE_FORM)
        if verdict is None:
            return EMPTY
        judged.append(verdict)
    return {"qa": qa, "rubric": rubric, "judge_without_context": judged[0], "judge_with_context": judged[1]}


def build(
    clusters: DataFrame, key: str, texts: str, cache: DataFrame, model: Model, budget: int = 114_688, log: CacheLog | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(key, context, hash, response)`` of clusters within the budget, and the new cache entries; keys hold model and prompt version.

    Each context is sent once, several at a time; with ``log`` every response
    is also appended to the cache as soon as it is there.
    """
    rows = clusters.withColumn("context", T.join_articles(F.col(texts)))
    rows = rows.filter(P.within_budget(F.col("context"), budget, spare=20))
    rows = rows.withColumn("hash", T.cache_key(F.lit(f"{model.name}\n{PROMPTS}\n"), F.col("context"))).select(key, "context", "hash")

    def compute(missing: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pool = Pool()

            def one(item: tuple[str, str]) -> str:
                record = {"sample_id": None, **synthesize(model, item[1], pool.limited)}
                if log:
                    log.write([{"hash": item[0], "response": record}])
                return json.dumps(record)

            for frame in frames:
                yield pd.DataFrame({"hash": frame["hash"], "response": pool.map(one, list(zip(frame["hash"], frame["context"])))})

        return missing.select("hash", "context").mapInPandas(run, "hash string, response string").withColumn("response", F.from_json("response", RECORD))

    return through_cache(rows, "hash", cache, "response", compute)


def split(records: DataFrame, key: str, response: str = "response") -> DataFrame:
    """``(key, question, answer, split)``: accepted records, one of equal question and answer, the hard ones as ``test``."""
    good = records.filter(P.accepted(response)).select(
        key, F.col(f"{response}.qa.question").alias("question"), F.col(f"{response}.qa.answer").alias("answer"),
        F.when(P.is_hard(response), "test").otherwise("train").alias("split"),
    )
    return first_per_value(good, F.concat_ws("\u0001", "question", "answer"), key)


def drop_near(pairs: DataFrame, key: str, embedder: Embedder, least: float = 0.90, probes: int | None = PROBES) -> DataFrame:
    """Pairs without those whose question and answer both come close to an earlier kept pair's, by the embedder's cosine."""
    empty = pairs.sparkSession.createDataFrame([], EMBED_CACHE)
    links = None
    for column in ("question", "answer"):
        rows, _ = embed(pairs.select(key, column), column, empty, embedder)
        found = similar(rows.filter(F.col("embed").isNotNull()), key, "embed", least, probes).select("a", "b")
        links = found if links is None else links.join(found, ["a", "b"], "left_semi")
    return pairs.join(keep_first(pairs, links, key).filter("kept").select(key), key, "left_semi")


def evaluate(
    pairs: DataFrame, key: str, cache: DataFrame, model: Model, judge: Model, log: CacheLog | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs with a model's judged answers, their accuracy, and the new cache entries ``(hash, correct)``.

    Each pair is sent once, several at a time; with ``log`` every verdict is
    also appended to the cache as soon as it is there.
    """
    rows = pairs.withColumn("hash", T.cache_key(F.lit(f"{model.name}\n{judge.name}\n{PROMPTS}\n"), F.col("question"), F.lit("\n"), F.col("answer")))

    def compute(missing: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pool = Pool()

            def one(item: tuple[str, str, str]) -> str | None:
                hash_, question, answer = item
                given = with_retries(lambda: model.complete(f"TASK: answer\n{question}"), limited=pool.limited)
                reply = None if given is None else with_retries(lambda: judge.complete(judge_prompt(question, given, answer)), limited=pool.limited)
                found = _form(reply, JUDGE_FORM)
                correct = None if found is None else found["correct"]
                if log and correct:
                    log.write([{"hash": hash_, "correct": correct}])
                return correct

            for frame in frames:
                yield pd.DataFrame({"hash": frame["hash"], "correct": pool.map(one, list(zip(frame["hash"], frame["question"], frame["answer"])))})

        return missing.select("hash", "question", "answer").mapInPandas(run, "hash string, correct string")

    judged, new = through_cache(rows.select(key, "question", "answer", "hash"), "hash", cache, "correct", compute)
    return judged, accuracy(judged), new

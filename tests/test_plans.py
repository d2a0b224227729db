import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell import queries
from inkwell.plans import embed, qa
from inkwell.providers import HashEmbedder, HttpError, Pool, RateLimited, ScriptedModel, with_retries
from inkwell.sources.jsonl import CacheLog, append_cache, read_cache
from inkwell.schemas import EMBED_CACHE, RECORD


def test_retries():
    waits, left = [], [2]

    def call():
        if left[0]:
            left[0] -= 1
            raise RateLimited
        return "done"

    assert with_retries(call, sleep=waits.append) == "done"
    assert len(waits) == 2 and 8 <= waits[0] <= 12 and 16 <= waits[1] <= 24
    left[0] = 9
    with pytest.raises(RateLimited):
        with_retries(call, tries=2, sleep=waits.append)


def test_embed_once_for_each_text(spark, rows_of):
    docs = spark.createDataFrame([(1, "liver cells"), (2, "liver cells"), (3, None), (4, ""), (5, "w " * 40_000)], "id int, text string")
    cache = spark.createDataFrame([], "hash string, embedding array<float>")
    rows, new = embed.embed(docs, "text", cache, HashEmbedder(8))
    assert rows_of(rows.select("id", F.size("embed"))) == [(1, 8), (2, 8), (4, None)]
    assert new.count() == 2
    _, none = embed.embed(docs, "text", spark.createDataFrame(new.collect(), cache.schema), HashEmbedder(8))
    assert none.count() == 0


def test_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 32))
    x = np.concatenate([c + 0.35 * rng.normal(size=(4, 32)) for c in centres] + [centres[:1] * 2, rng.normal(size=(5, 32))])
    df = spark.createDataFrame([(i, f"t{i}", [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, text string, v array<float>")
    found = embed.cluster(df, "id", "text", "v", k=3, least=0.6, duplicate=0.999).collect()
    assert sorted(sorted(r.texts) for r in found) == [sorted(f"t{4 * c + j}" for j in range(4)) for c in range(4)] or len(found) >= 3
    for r in found:
        m = np.array(r.embeds)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        assert (m @ m.T).min() >= 0.6 - 1e-6


def test_qa(spark, rows_of):
    groups = spark.createDataFrame([(i, [f"text {i}", "other"]) for i in range(30)], "id int, texts array<string>")
    cache = spark.createDataFrame([], "hash string").withColumn("response", F.from_json(F.lit(None).cast("string"), RECORD))
    rows, new = qa.build(groups, "id", "texts", cache, ScriptedModel())
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    assert new.count() == 30
    pairs = qa.split(rows, "id")
    good = [r.response for r in rows.collect()]
    want = sum(r.rubric.difficulty in ("graduate", "phd") and min(r.rubric.askability, r.rubric.synthesizability) >= 4 and r.judge_with_context.correct == "yes" and r.judge_without_context.correct == "no" for r in good)
    assert pairs.count() == want > 0
    empty = spark.createDataFrame([], "hash string, correct string")
    judged, accuracy, entries = qa.evaluate(pairs, "id", empty, ScriptedModel(), ScriptedModel())
    assert rows_of(accuracy.select("incorrect")) == [(want,)]
    assert entries.count() == want


def test_every_sql_has_its_query():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert {"p3_found", "p5_found"} <= set(queries.QUERIES)


def test_rest_stands_without_the_llm_part():
    import ast
    import pathlib

    root = pathlib.Path(queries.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_near_pairs_leave(spark, rows_of):
    rows = [(1, "what is the role of the liver", "it keeps sugar"), (2, "what is the role of the liver", "it keeps sugar"), (3, "what is the role of the liver", "quite another thing"), (4, "else", None)]
    df = spark.createDataFrame(rows, "id bigint, question string, answer string")
    assert rows_of(qa.drop_near(df, "id", HashEmbedder(64)).select("id")) == [(1,), (3,), (4,)]


def counted(inner, path):
    """A provider that writes a line for each text it is asked for; a local class goes to the workers by value."""

    class Counted:
        name = inner.name

        def embed(self, texts):
            with open(path, "a") as out:
                out.write("".join(f"{len(t)}\n" for t in texts))
            return inner.embed(texts)

        def complete(self, prompt):
            with open(path, "a") as out:
                out.write(repr(prompt) + "\n")
            return inner.complete(prompt)

    return Counted()


def test_each_text_is_sent_once(spark, tmp_path):
    """Whatever the number of uses of rows and new entries, a provider is asked once for each text."""
    log = tmp_path / "calls"
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(100)], "id int, text string")
    rows, new = embed.embed(docs, "text", spark.createDataFrame([], EMBED_CACHE), counted(HashEmbedder(8), str(log)), log=CacheLog(str(tmp_path / "cache")))
    rows.write.parquet(str(tmp_path / "rows"))
    new.write.parquet(str(tmp_path / "new"))
    assert rows.count() == new.count() == 100
    assert len(log.read_text().splitlines()) == 100
    assert read_cache(spark, str(tmp_path / "cache"), EMBED_CACHE).count() == 100


def test_evaluation_asks_once(spark, tmp_path, rows_of):
    log = tmp_path / "calls"
    pairs = spark.createDataFrame([(i, f"question {i}", f"answer {i}") for i in range(20)], "id int, question string, answer string")
    model = counted(ScriptedModel(), str(log))
    judged, accuracy, new = qa.evaluate(pairs, "id", spark.createDataFrame([], "hash string, correct string"), model, model)
    assert judged.count() == new.count() == 20 and rows_of(accuracy) == [(0.0, 0, 20)]
    assert len(log.read_text().splitlines()) == 40


def test_prompts(spark, tmp_path):
    """The rubric sees the context, the judge the question, and who answers never the expected answer."""
    log = tmp_path / "calls"
    record = qa.synthesize(counted(ScriptedModel(), str(log)), "# Article 1/1:\n\nsome context")
    assert record["judge_with_context"]["correct"] == "yes" and record["judge_without_context"]["correct"] == "no"
    prompts = {eval(line).partition("\n")[0]: eval(line) for line in log.read_text().splitlines()}
    question, answer = record["qa"]["question"], record["qa"]["answer"]
    assert all(x in prompts["TASK: rubric"] for x in ("some context", question, answer))
    assert question in prompts["TASK: judge"] and answer in prompts["TASK: judge"]
    for kind in ("TASK: answer", "TASK: answer with context"):
        assert answer not in prompts[kind] and question in prompts[kind]


@pytest.mark.parametrize("field, value", [("askability", 9), ("askability", "4"), ("askability", True), ("difficulty", "hard"), ("strict", False), ("difficulty", None)])
def test_replies_outside_their_domains_are_none(field, value):
    import json

    good = {"difficulty": "phd", "askability": 5, "synthesizability": 0, "abstractiveness": 3, "conflict_synthesis": 4, "strict": True}
    assert qa._form(json.dumps({**good, "more": 1}), qa.RUBRIC_FORM) == good
    assert qa._form(json.dumps({**good, field: value}), qa.RUBRIC_FORM) is None
    assert qa._form("[" * 100_000, qa.RUBRIC_FORM) is None


def test_pool_keeps_calls_open():
    import threading
    import time

    pool, lock, state = Pool(least=2, most=6, step=2, streak=10), threading.Lock(), {"now": 0, "top": 0}

    def work(x):
        with lock:
            state["now"] += 1
            state["top"] = max(state["top"], state["now"])
        time.sleep(0.002)
        with lock:
            state["now"] -= 1
        return x * 2

    assert pool.map(work, list(range(80))) == [2 * x for x in range(80)]
    assert 2 < state["top"] <= 6 and pool.open == 6
    pool.limited()
    assert pool.open == 4
    left = [1]

    def failing():
        if left[0]:
            left[0] -= 1
            raise HttpError(503)
        return "ok"

    assert with_retries(failing, sleep=lambda _: None) == "ok"
    with pytest.raises(HttpError):
        with_retries(lambda: (_ for _ in ()).throw(HttpError(404)), sleep=lambda _: None)


def test_last_written_cache_entry_wins(spark, tmp_path):
    import time

    path = str(tmp_path / "cache")
    for i in range(4):
        append_cache(spark.createDataFrame([("h", [float(i)])], EMBED_CACHE).coalesce(1), path)
        time.sleep(1.1)
    assert [r.embedding for r in read_cache(spark, path, EMBED_CACHE).collect()] == [[3.0]]
    CacheLog(path).write([{"hash": "h", "embedding": [9.0]}, {"hash": "g", "embedding": None}])
    assert {r.hash: r.embedding for r in read_cache(spark, path, EMBED_CACHE).collect()} == {"h": [9.0]}

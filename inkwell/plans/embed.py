"""Texts to embeddings through a cache, near-duplicates out, clusters of close texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import cliques
from inkwell.operators.filters import within_budget
from inkwell.operators.relational import through_cache
from inkwell.providers import Embedder, with_retries
from inkwell.sources.jsonl import CacheLog

#: How many cells of vectors are searched for a row's neighbours.
PROBES = 16


def embed(texts: DataFrame, text: str, cache: DataFrame, embedder: Embedder, budget: int = 32_768, log: CacheLog | None = None) -> tuple[DataFrame, DataFrame]:
    """Texts within the budget with ``hash`` and ``embed``, and the new cache entries.

    The key holds the embedder's name; each distinct text is embedded once.
    With ``log`` every batch is also appended to the cache as soon as it is there.
    """
    keyed = texts.filter(F.col(text).isNotNull() & within_budget(F.col(text), budget)).withColumn("hash", T.cache_key(F.lit(embedder.name + "\n"), F.col(text)))

    def compute(missing: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                bodies = frame["body"].tolist()
                made = with_retries(lambda: embedder.embed(bodies))
                if log:
                    log.write([{"hash": h, "embedding": None if v is None else [float(x) for x in v]} for h, v in zip(frame["hash"], made)])
                yield pd.DataFrame({"hash": frame["hash"], "embedding": made})

        return missing.select("hash", F.col(text).alias("body")).mapInPandas(run, "hash string, embedding array<float>")

    known = cache.select("hash", "embedding")
    rows, new = through_cache(keyed, "hash", known, "embedding", compute)
    return rows.withColumnRenamed("embedding", "embed"), new


def cluster(
    rows: DataFrame, key: str, text: str, vector: str, k: int = 5, least: float = 0.75, duplicate: float | None = 0.90, probes: int | None = PROBES
) -> DataFrame:
    """``(seed, texts, embeds, avg_similarity)``: groups of a row and its ``k`` nearest of which every two reach ``least``; no row in two.

    Near-duplicates (a cosine of ``duplicate`` or more to an earlier kept row)
    are left out first.  Neighbours are those of the ``probes`` nearest cells,
    which are all there are while the rows are few; None compares all rows.
    """
    kept = rows
    if duplicate is not None:
        stays = cliques.keep_first(rows, cliques.similar(rows, key, vector, duplicate, probes), key).filter("kept")
        kept = rows.join(stays.select(key), key, "left_semi")
    near = cliques.nearest(kept, key, vector, k, probes)
    taken = cliques.pack(cliques.candidates(kept, key, vector, near, k, least))
    members = taken.select("seed", "mean_sim", F.posexplode("members").alias("pos", "id"))
    whole = members.join(kept.select(F.col(key).alias("id"), F.col(text).alias("t"), F.col(vector).alias("v")), "id")
    some = F.array_sort(F.collect_list(F.struct("pos", "t", "v")))
    return whole.groupBy("seed").agg(
        F.transform(some, lambda x: x["t"]).alias("texts"),
        F.transform(some, lambda x: x["v"]).alias("embeds"),
        F.max("mean_sim").cast("float").alias("avg_similarity"),
    )

"""Nearest neighbours, clique candidates and their greedy packing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.functions import vector as V
from inkwell.operators.cells import fit_cells, unit
from inkwell.session import cut_lineage

BLOCK = 4_096


def similar(vectors: DataFrame, key: str, vector: str, least: float, probes: int | None = None) -> DataFrame:
    """``(a, b, sim)`` with ``a < b``: all pairs of different vectors of a cosine of at least ``least``; copies are linked to the first of them, which is enough for ``keep_first``.

    With ``probes``, those that lie in one of the ``probes`` nearest cells of one another.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    marked = rows.withColumn("mark", F.sha2(F.col("v").cast("string"), 256))
    first = marked.groupBy("mark").agg(F.min("id").alias("first"))
    copies = marked.join(first, "mark").filter(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("sim"))
    once = rows.join(first.select(F.col("first").alias("id")), "id", "left_semi")
    pairs = _multiplied(once, "id", "v", None, least) if probes is None else _in_cells(once, "id", "v", None, least, probes)
    across = pairs.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "sim").groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return across.unionByName(copies)


def nearest(vectors: DataFrame, key: str, vector: str, k: int, probes: int | None = None) -> DataFrame:
    """``(src, dst, rank, sim)``: the ``k`` nearest others of each row by cosine, ties by smaller key.

    Exact, by the product of all pairs of blocks, which grows with the square
    of the rows; with ``probes``, the nearest in the ``probes`` cells that lie
    closest to the row, which grows with the rows.
    """
    rank = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    pairs = _multiplied(vectors, key, vector, k, None) if probes is None else _in_cells(vectors, key, vector, k, None, probes)
    return pairs.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("src", "dst", "rank", "sim")


def _searcher(k: int | None, least: float | None):
    """Of a frame's asking rows, the ``k`` best of the others, or those of at least ``least``."""

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        q, x = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(q) or not len(x):
            return pd.DataFrame({"src": [], "dst": [], "sim": []})
        x = x.sort_values("id")
        unit = lambda col: (lambda m: m / np.linalg.norm(m, axis=1, keepdims=True))(np.stack(col.to_numpy()).astype(np.float64))
        a, b = unit(q["v"]), unit(x["v"])
        ids, found = x["id"].to_numpy(), []
        for start in range(0, len(a), 512):
            asking = q["id"].to_numpy()[start : start + 512]
            sims = a[start : start + 512] @ b.T
            sims[asking[:, None] == ids[None, :]] = -np.inf
            if k is None:
                at, to = np.nonzero(sims >= least)
                found.append(pd.DataFrame({"src": asking[at], "dst": ids[to], "sim": sims[at, to]}))
                continue
            best = np.argsort(-sims, axis=1, kind="stable")[:, :k]
            found.append(pd.DataFrame({"src": np.repeat(asking, best.shape[1]), "dst": ids[best].ravel(), "sim": np.take_along_axis(sims, best, 1).ravel()}))
        out = pd.concat(found)
        return out[np.isfinite(out["sim"])]

    return search


def _vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Null, empty and zero vectors are left out."""
    return vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v")).filter(V.norm(F.col("v")) > 0)


def _multiplied(vectors: DataFrame, key: str, vector: str, k: int | None, least: float | None) -> DataFrame:
    """``(src, dst, sim)``: of each row and block the ``k`` best, or those of at least ``least``.

    Rows are hashed into blocks, and every pair of blocks is one task of two
    blocks; each gives ``k`` rows for a query, which are merged.
    """
    rows = _vectors(vectors, key, vector)
    blocks = max(1, -(-rows.count() // BLOCK))
    spot = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = rows.select(spot.alias("mine"), every.alias("theirs"), "id", "v", F.lit(True).alias("asks"))
    held = rows.select(every.alias("mine"), spot.alias("theirs"), "id", "v", F.lit(False).alias("asks"))
    return asked.unionByName(held).groupBy("mine", "theirs").applyInPandas(_searcher(k, least), "src bigint, dst bigint, sim double")


def _in_cells(vectors: DataFrame, key: str, vector: str, k: int | None, least: float | None, probes: int) -> DataFrame:
    """As ``_multiplied``, each row against the rows of its nearest cells; a cell is cut into blocks on both sides, so that a task holds two."""
    rows = _vectors(vectors, key, vector)
    rows = cut_lineage(rows.mapInArrow(_packer, "id bigint, v array<float>, vec binary"))
    head = rows.select(F.size("v").alias("dims")).head(1)
    fitted = fit_cells(rows, "id", "vec", rows.count(), head[0].dims if head else 1)
    shared = rows.sparkSession.sparkContext.broadcast(fitted)  # at most MOST_CELLS centres

    @F.pandas_udf("array<int>")
    def cells(vec: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.nearest(unit(list(vec)), probes).astype(np.int32)))

    placed = cut_lineage(rows.select("id", "v", F.array_distinct(cells("vec")).alias("cells")))
    probed = placed.select("id", "v", F.posexplode("cells").alias("nth", "cell"))
    sizes = probed.groupBy("cell").agg(
        F.ceil(F.count(F.when(F.col("nth") == 0, 1)) / BLOCK).cast("int").alias("blocks"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")
    ).filter("blocks > 0")
    sizes = cut_lineage(sizes)
    spot = F.xxhash64(F.lit(3), F.col("id"))
    held = placed.select("id", "v", F.col("cells")[0].alias("cell")).join(sizes, "cell").select(
        "cell", F.pmod(spot, F.col("blocks")).cast("int").alias("mine"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("theirs"), "id", "v", F.lit(False).alias("asks")
    )
    asked = probed.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine"), F.pmod(spot, F.col("parts")).cast("int").alias("theirs"), "id", "v", F.lit(True).alias("asks")
    )
    return held.unionByName(asked).groupBy("cell", "mine", "theirs").applyInPandas(_searcher(k, least), "src bigint, dst bigint, sim double")


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.asarray(v, dtype=np.float32).tobytes() for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=["id", "v", "vec"])


def candidates(vectors: DataFrame, key: str, vector: str, near: DataFrame, k: int, least: float) -> DataFrame:
    """``(seed, members, sim1, mean_sim)``: each row with its ``k`` neighbours of which every two reach ``least``."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    full = near.groupBy("src").agg(F.count("*").alias("n"), F.min("sim").alias("lowest"), F.max("sim").alias("sim1"))
    seeds = full.filter((F.col("n") == k) & (F.col("lowest") >= least)).select(F.col("src").alias("seed"), "sim1")
    members = seeds.select("seed", F.col("seed").alias("id"), F.lit(0).alias("rank")).unionByName(
        near.join(seeds, near.src == seeds.seed).select("seed", F.col("dst").alias("id"), "rank")
    ).join(rows, "id")
    group = members.groupBy("seed").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "v"))).alias("m"))

    @F.pandas_udf("struct<lowest double, mean double>")
    def pairwise(m: pd.Series) -> pd.DataFrame:
        out = []
        for rows_ in m:
            x = np.stack([np.asarray(r["v"], dtype=np.float64) for r in rows_])
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sims = (x @ x.T)[np.triu_indices(len(x), 1)]
            out.append((sims.min(), sims.mean()))
        return pd.DataFrame(out, columns=["lowest", "mean"])

    scored = group.select("seed", F.transform("m", lambda x: x["id"]).alias("members"), pairwise("m").alias("p"))
    return scored.filter(F.col("p.lowest") >= least).join(seeds, "seed").select("seed", "members", "sim1", F.col("p.mean").alias("mean_sim"))


def pack(cands: DataFrame) -> DataFrame:
    """The candidates that a greedy choice by falling ``sim1`` (ties by smaller seed) would take, none sharing a member.

    In each round every candidate goes that comes first for all its members;
    those that share a member with it leave.  That is the sequential choice.
    """
    order = F.struct((-F.col("sim1")).alias("s"), F.col("seed").alias("k"))
    left = cut_lineage(cands.select("seed", "members", order.alias("prio")))
    taken = None
    while not left.isEmpty():  # each round settles the first candidate that is left at least
        each = left.select("seed", "prio", F.explode("members").alias("id"))
        first = each.groupBy("id").agg(F.min("prio").alias("first"))
        winners = each.join(first, "id").groupBy("seed").agg(F.min(F.col("prio") == F.col("first")).alias("wins")).filter("wins").select("seed")
        winners = cut_lineage(winners)
        taken = winners if taken is None else taken.unionByName(winners)
        used = left.join(winners, "seed", "left_semi").select(F.explode("members").alias("id"))
        lost = each.join(used, "id", "left_semi").select("seed").distinct()
        left = cut_lineage(left.join(lost, "seed", "left_anti"))
    return cands.limit(0) if taken is None else cands.join(taken, "seed", "left_semi")


def keep_first(rows: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """``(key, kept)``: rows taken by rising key, leaving out those linked to one taken before; ``kept`` tells which stay.

    ``links`` is ``(a, b)`` with ``a < b``.  A row is settled once all smaller
    rows it is linked to are: that is the sequential choice, in as many rounds
    as the longest chain of links by rising key takes.
    """
    links = cut_lineage(links.select("a", "b").distinct())
    dropped = None
    open_ = links
    while not open_.isEmpty():
        # Not the larger end of any open link: kept; what it is linked to is dropped.
        kept = open_.select(F.col("a").alias("id")).join(open_.select(F.col("b").alias("id")), "id", "left_anti").distinct()
        gone = cut_lineage(open_.join(kept.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct())
        dropped = gone if dropped is None else dropped.unionByName(gone)
        open_ = cut_lineage(
            open_.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti")
        )
    ids = rows.select(F.col(key).cast("bigint").alias(key)).distinct()
    if dropped is None:
        return ids.withColumn("kept", F.lit(True))
    return ids.join(dropped.select(F.col("id").alias(key), F.lit(False).alias("gone")), key, "left").select(key, F.coalesce("gone", F.lit(True)).alias("kept"))

"""The most similar rows of every row's vector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import vectors


def nearest_rows(rows: DataFrame, key: str = "row_id", vector: str = "embed", dims: int = 128, k: int = 5, probes: int = 8, rerank: int = 48) -> DataFrame:
    """``(key, rank, neighbour, cosine)``: for every row of a usable vector its ``k`` most similar other rows.

    Usable are ``dims`` finite values, not all zero; other rows (null vectors
    too) are neither queries nor neighbours.  Equal cosines go by the smaller
    key; equal vectors are neighbours of cosine 1.  A repeated key with one
    vector counts once.  Other columns are dropped; an empty table gives an
    empty result.  With fewer than ``k`` other rows there are fewer neighbours.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    classes, members = vectors.vector_classes(rows, key, vector, dims, k + 1)
    near = vectors.nearest(classes, dims, k, probes, max(rerank, 4 * k))
    ids = classes.select(F.col("rep").alias("other"), "ids")
    own = classes.select("rep", F.col("rep").alias("other"), F.lit(1.0).alias("cosine"))
    # At most k + 1 classes of k + 1 rows each.
    listed = (
        near.unionByName(own)
        .join(ids, "other")
        .select("rep", F.transform("ids", lambda i: F.struct((-F.col("cosine")).alias("less"), i.alias("id"))).alias("some"))
        .groupBy("rep")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, k + 1).alias("all"))
    )
    each = members.join(listed, "rep").select(key, F.slice(F.filter("all", lambda x: x["id"] != F.col(key)), 1, k).alias("all"))
    return each.select(key, F.posexplode("all").alias("nth", "x")).select(
        key, (F.col("nth") + 1).alias("rank"), F.col("x.id").alias("neighbour"), (-F.col("x.less")).alias("cosine")
    )


def similar_pairs(near: DataFrame, key: str = "row_id", least: float = 0.75) -> DataFrame:
    """``(key_a, key_b)``: pairs of at least a cosine of which one is among the other's nearest, smaller key first."""
    close = near.filter(F.col("cosine") >= least)
    return close.select(F.least(key, "neighbour").alias(f"{key}_a"), F.greatest(key, "neighbour").alias(f"{key}_b")).distinct()

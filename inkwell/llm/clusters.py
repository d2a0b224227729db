"""Clusters of mutually similar rows by power-iteration spectral clustering.

Affinities are the cosines of each vector's nearest others above a threshold, a
sparse matrix with the diagonal.  Its rows are normalised, and several vectors
with hashed starting values are multiplied by it again and again: a value
becomes the same over all rows that hang together, and another one for other
rows.  The values are the spectral embedding, which k-means clusters: centres
start from the cells of a fine grid, centres closer than the grid are one, and
every row goes to its nearest.  An exact check follows: in a cluster every two
rows must reach the threshold; one that fails is divided at its best-connected
row.

The neighbours are bounded and found by an index, so that up to here a large
cluster may lie in parts.  Parts are joined exactly: one row of each part is
compared with those of all others; what hangs together is one cluster if every
two of its rows reach the threshold, and else its parts are joined, the largest
first, as far as every two rows do.  Members are ranked
by their affinity to the rest of their cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm import vectors
from inkwell.operators.cells import unit
from inkwell.session import cut_lineage

VECTORS = 4
STEPS = 16
STEPS_A_JOB = 8
GRID = 1e-3
SIDE = 8  # cells of the look-up, in grids
BLOCK = 2_048
EXEMPLARS = 8_192
NEAREST = 64


def embed(links: DataFrame, steps: int = STEPS) -> DataFrame:
    """``(rep, v0, v1, ..)``: the spectral embedding of ``(rep, other, weight)``, in which every row has a link to itself."""
    names = [f"v{i}" for i in range(VECTORS)]
    whole = Window.partitionBy("rep")
    walk = cut_lineage(links.select("rep", "other", (F.col("weight") / F.sum("weight").over(whole)).alias("p")))
    start = [((F.xxhash64(F.lit(11 + i), F.col("rep")).bitwiseAND(F.lit((1 << 40) - 1))) / float(1 << 40)).alias(v) for i, v in enumerate(names)]
    values = walk.select("rep").distinct().select("rep", *start)
    for step in range(1, steps + 1):
        values = (
            walk.join(values.withColumnRenamed("rep", "other"), "other")
            .groupBy("rep")
            .agg(*[F.sum(F.col("p") * F.col(v)).alias(v) for v in names])
        )
        if step % STEPS_A_JOB == 0 or step == steps:
            values = cut_lineage(values)
    return values


def k_means(points: DataFrame, grid: float = GRID, rounds: int = 2) -> DataFrame:
    """``(rep, cluster)``: the embedding's points by their nearest centre, where no centre has another one within the grid.

    Centres are looked up by cells of all four values, ``SIDE`` grids wide: a
    centre is in its own cell, and a point looks into those that lie within
    the grid of it, about two and a half on average.
    """
    names = [f"v{i}" for i in range(VECTORS)]
    side = SIDE * grid

    def own(v: str) -> Column:
        return F.floor(F.col(v) / side)

    def key(cells: list[Column]) -> Column:
        return F.xxhash64(*cells)

    def crossed(keys: Column, cells: Column) -> Column:
        return F.flatten(F.transform(keys, lambda k: F.transform(cells, lambda c: F.array_append(k, c))))

    def near(df: DataFrame) -> DataFrame:
        """Every row once for each cell within the grid of it."""
        keys = F.array(F.array().cast("array<bigint>"))
        for v in names:
            inside = F.col(v) - own(v) * side
            cells = F.when(inside < grid, F.array(own(v), own(v) - 1)).when(inside > side - grid, F.array(own(v), own(v) + 1)).otherwise(F.array(own(v)))
            keys = crossed(keys, cells)
        return df.withColumn("at", F.explode(F.transform(keys, lambda k: key([k[i] for i in range(VECTORS)]))))

    apart = reduce(lambda a, b: a + b, [(F.col(f"p.{v}") - F.col(f"q.{v}")) ** 2 for v in names])
    seeded = points.withColumn("seed", F.xxhash64(*[F.floor(F.col(v) / grid) for v in names]))
    centres = seeded.groupBy("seed").agg(F.min("rep").alias("cluster"), *[F.avg(v).alias(v) for v in names]).drop("seed")
    assigned = None
    for _ in range(rounds):
        centres = cut_lineage(centres)
        stored = centres.withColumn("at", key([own(v) for v in names]))
        # Of centres within the grid of one another only the first stays.
        covered = (
            near(centres).alias("p").join(stored.alias("q"), "at")
            .filter((F.col("q.cluster") < F.col("p.cluster")) & (apart <= grid * grid))
            .select(F.col("p.cluster").alias("cluster")).distinct()
        )
        stored = stored.join(covered, "cluster", "left_anti")
        seen = (
            near(points).alias("p").join(stored.alias("q"), "at")
            .select(F.col("p.rep").alias("rep"), *[F.col(f"p.{v}").alias(v) for v in names], apart.alias("apart"), "q.cluster")
        )
        assigned = cut_lineage(seen.groupBy("rep", *names).agg(F.min_by("cluster", F.struct("apart", "cluster")).alias("cluster")))
        centres = assigned.groupBy("cluster").agg(*[F.avg(v).alias(v) for v in names])
    alone = points.select("rep").join(assigned.select("rep"), "rep", "left_anti").select("rep", F.col("rep").alias("cluster"))
    return assigned.select("rep", "cluster").unionByName(alone)


def around_mean(assigned: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(cluster, rep, others, affinity, safe)``: mean cosine to the other members from the sum of the cluster's vectors.

    A cluster is ``safe`` if all its rows lie within half the allowed angle of
    their mean direction: then every two reach ``least``.  Sums are added up in
    each task before the shuffle, so that this is linear in the rows.
    """

    def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sums((b.column(0).to_pylist(), np.ones(b.num_rows), unit(b.column(1).to_pylist())) for b in batches if b.num_rows)

    def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sums((b.column(0).to_pylist(), b.column(1).to_numpy(), np.stack([np.frombuffer(x) for x in b.column(2).to_pylist()])) for b in batches if b.num_rows)

    schema = "cluster bigint, n double, total binary"
    rows = assigned.join(classes.select("rep", "vec"), "rep")
    partial = rows.select("cluster", "vec").mapInArrow(add_rows, schema)
    totals = partial.repartition("cluster").mapInArrow(add_sums, schema)

    @F.pandas_udf("double")
    def along(vec: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("nd,nd->n", unit(list(vec)), np.stack([np.frombuffer(t) for t in total])))

    @F.pandas_udf("double")
    def length(total: pd.Series) -> pd.Series:
        return pd.Series([float(np.linalg.norm(np.frombuffer(t))) for t in total])

    sized = totals.select("cluster", "n", "total", length("total").alias("length"))
    each = cut_lineage(rows.join(sized, "cluster").select("cluster", "rep", "n", "length", along("vec", "total").alias("along")))
    half = ((1 + least) / 2) ** 0.5
    safe = each.groupBy("cluster").agg((F.min(F.col("along") / F.col("length")) >= half).alias("safe"))
    affinity = F.coalesce((F.col("along") - 1) / F.nullif(F.col("n") - 1, F.lit(0.0)), F.lit(1.0))
    return each.join(safe, "cluster").select("cluster", "rep", (F.col("n") - 1).cast("bigint").alias("others"), affinity.alias("affinity"), "safe")


def _sums(parts: Iterable[tuple[list[int], np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cluster, n, total)`` of vectors added up by cluster, handed on when there are many."""
    sums: dict[int, tuple[float, np.ndarray]] = {}

    def hand_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([n for n, _ in sums.values()], pa.float64()), pa.array([t.tobytes() for _, t in sums.values()], pa.binary())],
            names=["cluster", "n", "total"],
        )
        sums.clear()
        return out

    for clusters, counts, totals in parts:
        keys, at = np.unique(np.array(clusters, dtype=np.int64), return_inverse=True)
        added, number = np.zeros((len(keys), totals.shape[1])), np.zeros(len(keys))
        np.add.at(added, at, totals)
        np.add.at(number, at, counts)
        for i, key in enumerate(keys.tolist()):
            n, total = sums.get(key, (0.0, 0.0))
            sums[key] = (n + number[i], total + added[i])
        if len(sums) > 20_000:
            yield hand_on()
    if sums:
        yield hand_on()


def affinities(assigned: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(cluster, rep, partners, affinity)``: with how many others of its cluster a row reaches ``least``, and its mean cosine to them.

    Clusters are cut into blocks, and pairs of blocks multiplied, so that a
    task holds two blocks whatever the cluster's size.
    """
    sizes = assigned.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = assigned.join(sizes, "cluster").join(classes.select("rep", "vec"), "rep")
    rows = rows.withColumn("own", F.pmod(F.xxhash64(F.lit(5), F.col("rep")), F.col("blocks")).cast("int"))
    left = rows.select("cluster", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("their"), "rep", "vec", F.lit(True).alias("asks"))
    right = rows.select("cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), F.col("own").alias("their"), "rep", "vec", F.lit(False).alias("asks"))

    def multiply(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"cluster": [], "rep": [], "partners": [], "total": []})
        cosines = unit(list(a["vec"])) @ unit(list(b["vec"])).T
        other = a["rep"].to_numpy()[:, None] != b["rep"].to_numpy()[None, :]
        return pd.DataFrame(
            {
                "cluster": a["cluster"].to_numpy(),
                "rep": a["rep"].to_numpy(),
                "partners": ((cosines >= least) & other).sum(axis=1),
                "total": (cosines * other).sum(axis=1),
            }
        )

    parts = left.unionByName(right).groupBy("cluster", "own", "their").applyInPandas(multiply, "cluster bigint, rep bigint, partners bigint, total double")
    counts = assigned.groupBy("cluster").agg((F.count("*") - 1).alias("others"))
    return (
        parts.groupBy("cluster", "rep")
        .agg(F.sum("partners").alias("partners"), F.sum("total").alias("total"))
        .join(counts, "cluster")
        .select("cluster", "rep", "partners", "others", F.coalesce(F.col("total") / F.nullif("others", F.lit(0)), F.lit(1.0)).alias("affinity"))
    )


def divide(failing: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(rep, cluster)``: clusters that fail, each divided at its best-connected row into those it reaches and the rest.

    Where it reaches all, the row of least affinity leaves.
    """
    by_cluster = failing.groupBy("cluster").agg(
        F.max_by("rep", F.struct("partners", "affinity", "rep")).alias("seed"),
        F.min_by("rep", F.struct("partners", "affinity", "rep")).alias("weakest"),
        F.max(F.col("partners") >= F.col("others")).alias("all"),
    )
    vec = classes.select("rep", "vec")
    seeds = by_cluster.join(vec.withColumnRenamed("rep", "seed").withColumnRenamed("vec", "seed_vec"), "seed")
    rows = failing.select("cluster", "rep").join(vec, "rep").join(seeds, "cluster")

    @F.pandas_udf("boolean")
    def reaches(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(np.einsum("nd,nd->n", unit(list(a)), unit(list(b))) >= least)

    stays = F.when(F.col("all"), F.col("rep") != F.col("weakest")).otherwise((F.col("rep") == F.col("seed")) | reaches("vec", "seed_vec"))
    sides = cut_lineage(rows.select("cluster", "rep", stays.alias("stays")))
    first = sides.groupBy("cluster", "stays").agg(F.min("rep").alias("first"))
    return sides.join(first, ["cluster", "stays"]).select("rep", F.col("first").alias("cluster"))


def score(assigned: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(cluster, rep, partners, others, affinity)`` of all rows; a cluster holds if every row has all others as partners."""
    mean = cut_lineage(around_mean(assigned, classes, least))
    # Only what its mean does not settle is checked pair by pair.
    open_ = mean.filter(~F.col("safe")).select("rep", "cluster")
    sure = mean.filter("safe").select("cluster", "rep", F.col("others").alias("partners"), "others", "affinity")
    return cut_lineage(sure.unionByName(affinities(open_, classes, least)))


def exemplar_pairs(exemplars: DataFrame, least: float) -> DataFrame:
    """``(a, b)`` with ``a < b``: all pairs of ``(rep, vec)`` whose cosine is at least ``least``; each pair of blocks is multiplied once."""
    blocks = max(1, -(-exemplars.count() // EXEMPLARS))
    rows = exemplars.select("rep", "vec", F.pmod(F.xxhash64(F.lit(9), F.col("rep")), F.lit(blocks)).cast("int").alias("block"))
    left = rows.select(F.col("block").alias("own"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("their"), "rep", "vec", F.lit(True).alias("asks"))
    right = rows.select(F.explode(F.sequence(F.lit(0), F.col("block"))).alias("own"), F.col("block").alias("their"), "rep", "vec", F.lit(False).alias("asks"))

    def multiply(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame[frame["asks"]], frame[~frame["asks"]]
        found = [np.zeros((0, 2), dtype=np.int64)]
        if len(a) and len(b):
            x, y = unit(list(a["vec"])), unit(list(b["vec"]))
            mine, others = a["rep"].to_numpy(), b["rep"].to_numpy()
            inner = frame["own"].iloc[0] == frame["their"].iloc[0]
            for start in range(0, len(x), 512):
                at, to = np.nonzero(x[start : start + 512] @ y.T >= least)
                pairs = np.stack([mine[start + at], others[to]], axis=1)
                found.append(pairs[pairs[:, 0] < pairs[:, 1]] if inner else np.sort(pairs, axis=1))
        out = np.concatenate(found)
        return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})

    return left.unionByName(right).groupBy("own", "their").applyInPandas(multiply, "a bigint, b bigint")


def hanging_together(links: DataFrame) -> DataFrame:
    """``(part, whole)``: the connected component of every end of the links ``(a, b)``, named by its smallest part."""
    both = cut_lineage(links.union(links.select("b", "a")).toDF("part", "other"))
    labels = cut_lineage(both.select("part").distinct().withColumn("whole", F.col("part")))
    while True:
        offered = both.join(labels.toDF("other", "offer"), "other").groupBy("part").agg(F.min("offer").alias("offer"))
        nearer = labels.join(offered, "part").select("part", "whole", F.least("whole", "offer").alias("new"))
        after = cut_lineage(nearer.join(labels.toDF("new", "further"), "new").select("part", "whole", F.least("new", "further").alias("new")))
        if after.filter(F.col("new") < F.col("whole")).isEmpty():
            return labels
        labels = after.select("part", F.col("new").alias("whole"))


def matching_parts(links: DataFrame, parts: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Of the links ``(a, b)`` between parts ``(rep, part)`` those over which every two rows reach ``least``."""
    numbered = cut_lineage(links.withColumn("cluster", F.monotonically_increasing_id()))
    sides = numbered.select("cluster", F.explode(F.array("a", "b")).alias("part"))
    scored = score(sides.join(parts, "part").select("rep", "cluster"), classes, least)
    failed = scored.filter(F.col("partners") < F.col("others")).select("cluster").distinct()
    return numbered.join(failed, "cluster", "left_anti").select("a", "b")


def join_matching(links: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(part, whole)``: parts ``(part, size)`` joined until no two wholes match; two match if all their parts do, as the links ``(a, b)`` say.

    Every whole looks at the largest it matches.  Where one is larger than all
    it matches, those that look at it join it together if they match one
    another too; if not, only the one it looks at itself joins it.
    """
    links = cut_lineage(links.union(links.select("b", "a")).toDF("a", "b"))
    placed = cut_lineage(sizes.select("part", F.col("part").alias("whole"), "size"))
    while not links.isEmpty():
        order = placed.groupBy("whole").agg(F.sum("size").alias("size")).select("whole", F.struct("size", F.xxhash64("whole").alias("mixed"), "whole").alias("rank"))
        looks = links.join(order.toDF("b", "rank"), "b").groupBy("a").agg(F.max("rank").alias("best"))
        looks = looks.join(order.toDF("a", "rank"), "a").select("a", F.col("best.whole").alias("at"), (F.col("rank") > F.col("best")).alias("leads"))
        looks = cut_lineage(looks)
        leaders = looks.filter("leads").select(F.col("a").alias("leader"), F.col("at").alias("chosen"))
        fans = looks.filter(~F.col("leads")).join(leaders, F.col("at") == F.col("leader")).select("a", "leader", "chosen")
        fans = cut_lineage(fans)
        inner = links.join(fans.select("a", "leader"), "a").join(fans.select(F.col("a").alias("b"), F.col("leader").alias("same")), "b").filter(F.col("leader") == F.col("same"))
        full = (
            fans.groupBy("leader").agg(F.count("*").alias("n")).join(inner.groupBy("leader").agg(F.count("*").alias("pairs")), "leader", "left")
            .select("leader", (F.coalesce("pairs", F.lit(0)) == F.col("n") * (F.col("n") - 1)).alias("full"))
        )
        moves = cut_lineage(fans.join(full, "leader").filter(F.col("full") | (F.col("a") == F.col("chosen"))).select("a", "leader"))

        def moved(df: DataFrame, column: str) -> DataFrame:
            rest = [c for c in df.columns if c != column]
            return df.join(moves.withColumnRenamed("a", column), column, "left").select(*rest, F.coalesce("leader", column).alias(column))

        joined = moved(placed.select("whole").distinct().withColumn("to", F.col("whole")), "to").groupBy("to").agg(F.count("*").alias("n"))
        across = moved(moved(links, "a"), "b").filter(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.count("*").alias("pairs"))
        whole = across.join(joined.toDF("a", "n"), "a").join(joined.toDF("b", "m"), "b").filter(F.col("pairs") == F.col("n") * F.col("m"))
        links = cut_lineage(whole.select("a", "b"))
        placed = cut_lineage(moved(placed, "whole"))
    return placed.select("part", "whole")


def join_parts(good: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """``(cluster, rep, affinity)``: clusters of which every two rows reach ``least``, joined where they still do together; every row has one.

    Rows of which every two reach ``least`` do so with the first rows of their
    parts as well: to compare these loses no two parts that belong together.
    A row without any link is in no part and not compared again: it had been
    asked for by each of its partners, and each of them by it.
    """
    first = good.groupBy("cluster").agg(F.min("rep").alias("part"))
    within = good.join(first, "cluster").select("rep", "part", "affinity")
    alone = classes.select("rep").join(within, "rep", "left_anti").select("rep", F.col("rep").alias("part"), F.lit(1.0).alias("affinity"))
    parts = cut_lineage(within.unionByName(alone))
    exemplars = classes.join(first.select(F.col("part").alias("rep")), "rep", "left_semi").select("rep", "vec")
    links = cut_lineage(exemplar_pairs(exemplars, least))
    same = parts.select(F.col("part").alias("cluster"), "rep", "affinity")
    if links.isEmpty():
        return same
    wholes = hanging_together(links)
    scored = score(parts.join(wholes, "part").select("rep", F.col("whole").alias("cluster")), classes, least)
    failed = cut_lineage(scored.filter(F.col("partners") < F.col("others")).select("cluster").distinct())
    out = scored.join(failed, "cluster", "left_anti").select("cluster", "rep", "affinity")
    if not failed.isEmpty():
        torn = parts.join(wholes, "part").join(failed.withColumnRenamed("cluster", "whole"), "whole", "left_semi").select("rep", "part")
        left = links.join(wholes.toDF("a", "cluster"), "a").join(failed, "cluster", "left_semi").select("a", "b")
        matching = matching_parts(left, torn, classes, least)
        joined = join_matching(matching, torn.groupBy("part").agg(F.count("*").alias("size")))
        out = out.unionByName(score(torn.join(joined, "part").select("rep", F.col("whole").alias("cluster")), classes, least).select("cluster", "rep", "affinity"))
    rest = same.join(wholes.select(F.col("part").alias("cluster")), "cluster", "left_anti")
    return cut_lineage(out.unionByName(rest))


def similarity_clusters(
    rows: DataFrame, key: str = "row_id", vector: str = "embed", dims: int = 128, least: float = 0.75, smallest: int = 3
) -> DataFrame:
    """``(cluster_id, key, size, typical, affinity)``: clusters of at least ``smallest`` rows of which every two reach the cosine ``least``.

    ``cluster_id`` is the smallest key of the cluster, ``typical`` a member's
    rank by its mean cosine to the other members (equal ones by key).  Rows of
    no usable vector belong to none; equal vectors belong together, so that
    three copies of a row are a cluster.  Clusters do not overlap.  Other
    columns are dropped; an empty table gives an empty result.
    """
    classes, members = vectors.vector_classes(rows, key, vector, dims)
    near = vectors.nearest(classes, dims, NEAREST, least=least)
    near = cut_lineage(near.select("rep", "other", F.col("cosine").alias("weight")))
    both = near.union(near.select("other", "rep", "weight")).toDF("rep", "other", "weight").distinct()
    linked = both.select("rep").distinct()
    points = embed(both.unionByName(linked.select("rep", F.col("rep").alias("other"), F.lit(1.0).alias("weight"))))
    assigned = cut_lineage(k_means(points))
    good = None
    while True:  # each division makes a failing cluster smaller
        scored = score(assigned, classes, least)
        failed = scored.filter(F.col("partners") < F.col("others")).select("cluster").distinct()
        passed = scored.join(failed, "cluster", "left_anti").select("cluster", "rep", "affinity", "others")
        good = passed if good is None else good.unionByName(passed)
        failing = scored.join(failed, "cluster", "left_semi")
        if failed.isEmpty():
            break
        assigned = divide(failing, classes, least)
    placed = members.join(join_parts(good, classes, least), "rep").select("rep", key, "cluster", "affinity")
    sizes = placed.groupBy("cluster").agg(F.count("*").alias("size"), F.min(key).alias("cluster_id")).filter(F.col("size") >= smallest)
    ranked = placed.join(sizes, "cluster")
    # Sums in another order differ in their last digits.
    rank = Window.partitionBy("cluster_id").orderBy(F.desc(F.round("affinity", 9)), key)
    return ranked.select("cluster_id", key, "size", F.row_number().over(rank).alias("typical"), "affinity")

"""Vector tables and their nearest rows: cells, anisotropic four-bit codes, table scans, exact reranking.

The quantiser's loss weighs the part of the residual that is parallel to the
vector more than the rest, since that part is what changes large inner
products.  Codes are four bits for each ``SUB`` dimensions.  A scan adds up
look-up tables over the codes of a cell; the best of a scan are scored exactly.

Cells (``operators.cells``: two levels, so that their number grows with the
table up to 65,536) and code books are fitted on bounded samples; every row is
indexed and every row is a query.  Cells of any size are cut into blocks
on both sides, so that no task holds more than ``BLOCK`` rows and ``QUERIES``
queries.  Equal vectors are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.cells import SAMPLE, Cells, fit_cells, sample, unit
from inkwell.session import cut_lineage, spread

CODE_SAMPLE = 4_096
SUB = 2
BLOCK = 4_096
QUERIES = 4_096
SCANNED = 256
PARALLEL_WEIGHT = 5.3  # (d - 1) t^2 / (1 - t^2) for d = 128 and a threshold t of 0.2
KEPT_COPIES = 6  # keys of equal vectors that a class names, one more than the neighbours asked for


def usable(vector: str, dims: int):
    """Whether a vector has ``dims`` finite values, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) == dims) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def vector_classes(rows: DataFrame, key: str, vector: str, dims: int, kept: int = KEPT_COPIES) -> tuple[DataFrame, DataFrame]:
    """Usable vectors, equal ones as one: ``(rep, ids, vec binary)`` and the membership ``(rep, key)``.

    ``ids`` are the smallest ``kept`` keys of a class, ``rep`` the first
    of them.  A class is cut to those before it is shuffled.
    """
    picked = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v")).filter(usable("v", dims))
    # Adding zero makes a negative zero a zero.
    picked = picked.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast("float")))
    marked = picked.select("id", "v", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), F.col("v")).alias("g"))
    first = Window.partitionBy("h", "g").orderBy("id")
    some = marked.dropDuplicates(["h", "g", "id"]).withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= kept)
    classes = some.groupBy("h", "g").agg(
        F.min("id").alias("rep"), F.array_sort(F.collect_list("id")).alias("ids"), F.max(F.when(F.col("nth") == 1, F.col("v"))).alias("v")
    )
    packed = classes.mapInArrow(_packer(), "h bigint, g bigint, rep bigint, ids array<bigint>, vec binary")
    packed = cut_lineage(packed)
    members = marked.select("h", "g", "id").join(packed.select("h", "g", "rep"), ["h", "g"]).select("rep", F.col("id").alias(key)).distinct()
    return packed.select("rep", "ids", "vec"), members


def _packer():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(4)
            flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float32)
            width = len(flat) // max(batch.num_rows, 1)
            raw = [row.tobytes() for row in flat.reshape(batch.num_rows, width)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(raw, pa.binary())], names=["h", "g", "rep", "ids", "vec"]
            )

    return run


@dataclass
class Index:
    """Cells, the size of each cell's residuals, and the code books of residuals of size one (16 words for each ``SUB`` dimensions)."""

    cells: Cells
    scales: np.ndarray
    books: np.ndarray

    @property
    def centres(self) -> np.ndarray:
        return self.cells.centres

    def encode(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return assign_codes((x - self.centres[cell]) / self.scales[cell][:, None], x, self.books)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each pair of code words in a byte, the inner product of each query with them: ``(bytes, 256, queries)``."""
        subs = len(self.books)
        parts = np.ascontiguousarray(q.reshape(len(q), subs, -1).transpose(1, 2, 0), dtype=np.float32)
        single = np.matmul(self.books.astype(np.float32), parts)
        return (single[0::2][:, :, None, :] + single[1::2][:, None, :, :]).reshape(subs // 2, 256, len(q))


def assign_codes(residual: np.ndarray, direction: np.ndarray, books: np.ndarray, rounds: int = 2) -> np.ndarray:
    """The code words of least anisotropic loss, by descent over the sub-spaces."""
    n, subs = len(residual), len(books)
    r = residual.reshape(n, subs, -1)
    u = direction.reshape(n, subs, -1)
    square = np.einsum("nsd,nsd->ns", r, r)[:, :, None] - 2 * np.einsum("nsd,swd->nsw", r, books) + np.einsum("swd,swd->sw", books, books)[None]
    along = np.einsum("nsd,nsd->ns", r, u)[:, :, None] - np.einsum("nsd,swd->nsw", u, books)
    codes = square.argmin(axis=2)
    rows = np.arange(n)
    parallel = np.take_along_axis(along, codes[:, :, None], 2)[:, :, 0].sum(axis=1)
    for _ in range(rounds):
        for s in range(subs):
            rest = parallel - along[rows, s, codes[:, s]]
            loss = square[:, s, :] + (PARALLEL_WEIGHT - 1) * (rest[:, None] + along[:, s, :]) ** 2
            codes[:, s] = loss.argmin(axis=1)
            parallel = rest + along[rows, s, codes[:, s]]
    return codes.astype(np.uint8)


def fit_books(residual: np.ndarray, direction: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Code books of least anisotropic loss over a sample."""
    n, dims = residual.shape
    subs = dims // SUB
    r, u = residual.reshape(n, subs, SUB), direction.reshape(n, subs, SUB)
    start = np.linspace(0, n - 1, 16).astype(int)
    books = np.ascontiguousarray(r[start].transpose(1, 0, 2)).copy()
    weight = PARALLEL_WEIGHT - 1
    for _ in range(rounds):
        codes = assign_codes(residual, direction, books, rounds=1)
        chosen = books[np.arange(subs)[None, :], codes]
        left = np.einsum("nsd,nsd->ns", r - chosen, u)
        total = left.sum(axis=1)
        for s in range(subs):
            rest = total - left[:, s]
            outer = np.einsum("nd,ne->nde", u[:, s], u[:, s])
            target = r[:, s] + weight * u[:, s] * (rest + np.einsum("nd,nd->n", r[:, s], u[:, s]))[:, None]
            for w in range(16):
                mine = codes[:, s] == w
                if mine.any():
                    a = mine.sum() * np.eye(SUB) + weight * outer[mine].sum(axis=0)
                    books[s, w] = np.linalg.solve(a, target[mine].sum(axis=0))
    return books


def fit_index(classes: DataFrame, count: int, dims: int) -> Index:
    """Cells and code books from bounded samples, the rows of the smallest hashes."""
    x = sample(classes, "rep", "vec", count, SAMPLE)
    if not len(x):
        return Index(Cells(np.eye(1, dims)), np.ones(1), np.zeros((dims // SUB, 16, SUB)))
    cells = fit_cells(classes, "rep", "vec", count, dims, x)
    cell = cells.nearest(x, 1)[:, 0]
    residual = x - cells.centres[cell]
    lengths = np.linalg.norm(residual, axis=1)
    # A dense cell gets code words as fine as its rows lie close; a cell of few rows leans on the others.
    total = np.bincount(cell, weights=lengths, minlength=len(cells.centres)) + lengths.mean()
    scales = np.maximum(total / (np.bincount(cell, minlength=len(cells.centres)) + 1), 1e-6)
    part = slice(0, CODE_SAMPLE)
    return Index(cells, scales, fit_books(residual[part] / scales[cell[part]][:, None], x[part]))


def scan(index: Index, cell: int, q: np.ndarray, x: np.ndarray, codes: np.ndarray, best: int, least: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(query, row, exact cosine)`` of one cell's block: of each query the ``best`` by table scan, exactly scored.

    With ``least``, only those whose scanned score comes within 0.2 of it.
    """
    pair = ((codes[:, 0::2].astype(np.int64) << 4) | codes[:, 1::2]).T.copy()
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(q), SCANNED):
        part = q[start : start + SCANNED]
        if len(x) <= best and least is None:
            out.append((np.repeat(np.arange(start, start + len(part)), len(x)), np.tile(np.arange(len(x)), len(part))))
            continue
        tables = index.tables(part)
        # Rows by queries: a look-up copies a whole line of the table.
        scores = np.zeros((len(x), len(part)), dtype=np.float32)
        for table, byte in zip(tables, pair):
            scores += table.take(byte, axis=0)
        scores *= np.float32(index.scales[cell])
        scores += (part @ index.centres[cell]).astype(np.float32)
        count = min(best, len(x))
        top = np.argpartition(-scores.T, count - 1, axis=1)[:, :count]
        rows, columns = np.repeat(np.arange(start, start + len(part)), count), top.ravel()
        if least is not None:
            near = np.take_along_axis(scores.T, top, 1).ravel() >= least - 0.2
            rows, columns = rows[near], columns[near]
        out.append((rows, columns))
    a = np.concatenate([o[0] for o in out]) if out else np.zeros(0, int)
    b = np.concatenate([o[1] for o in out]) if out else np.zeros(0, int)
    exact = np.empty(len(a))
    for start in range(0, len(a), 100_000):
        s = slice(start, start + 100_000)
        exact[s] = np.einsum("nd,nd->n", q[a[s]], x[b[s]])
    return a, b, exact


def nearest(classes: DataFrame, dims: int, k: int, probes: int = 8, rerank: int = 48, least: float | None = None) -> DataFrame:
    """``(rep, other, cosine)``: the ``k`` nearest other classes of each class, ties by smaller ``other``.

    ``classes`` is ``(rep bigint, ids, vec binary)`` with unique ``rep``.  With
    ``least``, only those of at least that cosine.
    """
    spark = classes.sparkSession
    count = classes.count()
    index = fit_index(classes, count, dims)
    shared = spark.sparkContext.broadcast(index)  # at most 65,536 centres and one book

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                x = unit(part.column(1).to_pylist())
                cells = shared.value.cells.nearest(x, probes)
                codes = shared.value.encode(x, cells[:, 0])
                width = cells.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([row.tobytes() for row in codes], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, cells.size + 1, width, dtype=np.int32)), pa.array(cells.ravel().astype(np.int32))
                        ),
                    ],
                    names=["rep", "vec", "codes", "cells"],
                )

    placed = cut_lineage(
        spread(classes.select("rep", "vec"), "rep").mapInArrow(place, "rep bigint, vec binary, codes binary, cells array<int>")
    )
    # Of each cell, how many rows it holds and how many queries probe it: at most as many rows as there are cells.
    placed = placed.withColumn("cells", F.array_distinct("cells"))
    probed = placed.select(F.posexplode("cells").alias("nth", "cell"))
    sizes = probed.groupBy("cell").agg(
        F.ceil(F.count(F.when(F.col("nth") == 0, 1)) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"),
    ).filter(F.col("blocks") > 0)
    sizes = F.broadcast(cut_lineage(sizes))  # two numbers for each of at most 65,536 cells
    spot = F.xxhash64(F.lit(3), F.col("rep"))
    stored = (
        placed.withColumn("cell", F.col("cells")[0])
        .join(sizes, "cell")
        .select("cell", F.pmod(spot, F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rep", "vec", "codes")
    )
    asked = (
        placed.select("rep", "vec", F.posexplode("cells").alias("nth", "cell"))
        .join(sizes, "cell")
        .select("cell", "nth", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(spot, F.col("parts")).cast("int").alias("part"), "rep", "vec")
        .select(*[F.col(c).alias(f"q_{c}") for c in ("cell", "block", "part", "rep", "vec", "nth")])
    )

    def search(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"rep": [], "other": [], "cosine": []})
        x, q = unit(list(rows["vec"])), unit(list(queries["q_vec"]))
        codes = np.frombuffer(b"".join(rows["codes"]), dtype=np.uint8).reshape(len(rows), -1)
        # Most neighbours lie in a query's own cell: there more rows are scored exactly.
        own = queries["q_nth"].to_numpy() == 0
        parts = []
        for mine, best in ((np.flatnonzero(own), rerank), (np.flatnonzero(~own), max(k, rerank // 3))):
            a, b, exact = scan(shared.value, int(key[0]), q[mine], x, codes, best, least)
            parts.append((mine[a], b, exact))
        a, b, exact = (np.concatenate(c) for c in zip(*parts))
        found = pd.DataFrame({"rep": queries["q_rep"].to_numpy()[a], "other": rows["rep"].to_numpy()[b], "cosine": exact})
        found = found[found["rep"] != found["other"]]
        if least is not None:
            found = found[found["cosine"] >= least]
        found = found.sort_values(["rep", "cosine", "other"], ascending=[True, False, True], kind="stable")
        return found[found.groupby("rep").cumcount() < k]

    group = ["cell", "block", "part"]
    found = stored.groupBy(*group).cogroup(asked.groupBy(*[f"q_{g}" for g in group])).applyInPandas(search, "rep bigint, other bigint, cosine double")
    rank = Window.partitionBy("rep").orderBy(F.desc("cosine"), "other")
    return found.withColumn("nth", F.row_number().over(rank)).filter(F.col("nth") <= k).drop("nth")

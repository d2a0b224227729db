"""Cells of a vector table: two levels of spherical k-means over bounded samples.

A small table has one level of centres.  Beyond ``COARSE`` cells every coarse
centre is divided by a fit over its own rows of a second sample, one task for
each, so that the driver holds only the centres, at most ``MOST_CELLS``.  Rows
find their cells through the coarse centres.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 16_384
COARSE = 2_048
FINE_SAMPLE = 1_024
MOST_CELLS = 65_536
ROWS_A_CELL = 4_096


def unit(raw) -> np.ndarray:
    """Packed vectors as rows of unit length."""
    x = np.frombuffer(b"".join(raw), dtype=np.float32).reshape(len(raw), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cell_count(rows: int) -> int:
    """How many cells for so many rows: by the root of their number, and enough that a cell holds ``ROWS_A_CELL`` at most while there may be more cells."""
    return int(np.clip(max(round(0.6 * rows**0.5), -(-rows // ROWS_A_CELL)), 8, MOST_CELLS))


def fit_centres(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from evenly spread rows."""
    count = min(count, len(x))
    centres = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-9), centres)
    return centres


@dataclass
class Cells:
    """Centres of all cells, and of each coarse centre where its own begin; one level if ``coarse`` is None."""

    centres: np.ndarray
    coarse: np.ndarray | None = None
    begins: np.ndarray | None = None

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """The nearest cells of each row, best first; with two levels, those under the nearest coarse centres."""
        if self.coarse is None:
            return _best(x @ self.centres.T, probes)
        near = _best(x @ self.coarse.T, max(4, probes // 2))
        out = np.empty((len(x), min(probes, len(self.centres))), dtype=np.int64)
        sizes = np.diff(self.begins)
        for row, some in enumerate(near):
            cells = np.concatenate([np.arange(self.begins[c], self.begins[c] + sizes[c]) for c in some])
            scores = self.centres[cells] @ x[row]
            order = np.argsort(-scores, kind="stable")[: out.shape[1]]
            out[row, : len(order)] = cells[order]
            out[row, len(order) :] = cells[order[-1]]
        return out


def _best(scores: np.ndarray, probes: int) -> np.ndarray:
    probes = min(probes, scores.shape[1])
    best = np.argpartition(-scores, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(scores, best, 1), axis=1, kind="stable")
    return np.take_along_axis(best, order, 1)


def sample(rows: DataFrame, key: str, vector: str, count: int, most: int) -> np.ndarray:
    """At most ``most`` packed vectors, those of the smallest key hashes, as rows of unit length."""
    share = min(1.0, 1.5 * most / max(count, 1))
    order = F.xxhash64(F.lit(7), F.col(key))
    low = -(2**63) + int(share * (2**64 - 1))
    picked = rows.filter(order <= min(low, 2**63 - 1)).orderBy(order).limit(most).select(vector).collect()
    return unit([bytes(r[0]) for r in picked]) if picked else np.zeros((0, 0))


def fit_cells(rows: DataFrame, key: str, vector: str, count: int, dims: int, x: np.ndarray | None = None) -> Cells:
    """Cells for ``count`` rows of packed vectors, fitted on samples of ``SAMPLE`` rows and, in the second level, ``FINE_SAMPLE`` for each coarse centre."""
    x = sample(rows, key, vector, count, SAMPLE) if x is None else x
    if not len(x):
        return Cells(np.eye(1, dims))
    wanted = cell_count(count)
    if wanted <= COARSE:
        return Cells(fit_centres(x, wanted))
    coarse = fit_centres(x, min(COARSE, int(wanted**0.5)))
    each = -(-wanted // len(coarse))
    shared = rows.sparkSession.sparkContext.broadcast(coarse)
    share = min(1.0, 1.5 * FINE_SAMPLE * len(coarse) / count)
    second = rows.filter(F.xxhash64(F.lit(8), F.col(key)) <= min(-(2**63) + int(share * (2**64 - 1)), 2**63 - 1)).select(F.col(vector).alias("vec"))

    @F.pandas_udf("int")
    def place(vec: pd.Series) -> pd.Series:
        return pd.Series((unit(list(vec)) @ shared.value.T).argmax(axis=1).astype(np.int32))

    def divide(frame: pd.DataFrame) -> pd.DataFrame:
        # A coarse cell may hold far more of the sample than its share; evenly spread rows of it are enough.
        own = frame.iloc[np.linspace(0, len(frame) - 1, min(len(frame), 4 * FINE_SAMPLE)).astype(int)]
        fine = fit_centres(unit(list(own["vec"])), each)
        return pd.DataFrame({"coarse": own["coarse"].iloc[0], "centre": [c.astype(np.float32).tobytes() for c in fine]})

    placed = second.withColumn("coarse", place("vec"))
    found = placed.groupBy("coarse").applyInPandas(divide, "coarse int, centre binary").orderBy("coarse").collect()
    by_coarse: dict[int, list[bytes]] = {}
    for r in found:
        by_coarse.setdefault(r.coarse, []).append(bytes(r.centre))
    kept = sorted(by_coarse)
    return Cells(
        unit([c for k in kept for c in by_coarse[k]]), coarse[kept], np.cumsum([0, *(len(by_coarse[k]) for k in kept)])
    )

"""Cutting oversized texts at natural boundaries, by pointer doubling.

For every boundary of a text - headings, paragraphs, sentences, words, and the
places a stride apart inside unbroken stretches - the farthest legal next cut
is computed at once (the overlap included); that is a successor table.  Squaring the table doubles
the number of cuts that one look-up spans, so that all greedy cuts of a text
are marked in a logarithmic number of rounds, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 6_000
OVERLAP = 300

# White space, and marks that end a sentence.
_SPACES = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
_ENDS = np.array([ord(c) for c in ".!?…"])
_WIDE_ENDS = np.array([ord(c) for c in "。！？"])
_CLOSING = np.array([ord(c) for c in "\"')]”’»*"])


def boundaries(text: str) -> list[np.ndarray]:
    """The places where a piece may begin, strongest kind first: headings, paragraphs, sentences, words (each holds the kinds before)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(codes)
    space = np.isin(codes, _SPACES)
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    place = np.where(space, -1, np.arange(n))
    last = np.maximum.accumulate(place)[starts - 1]  # the character before the blanks before each start
    breaks = (codes == 10) | ((codes == 13) & (np.append(codes[1:], 0) != 10)) | (codes == 0x2029)
    seen = np.concatenate([[0], np.cumsum(breaks)])
    lines = seen[starts] - seen[last + 1]
    # A closing quote or bracket may stand between the mark and the blanks.
    mark = codes[np.maximum(last, 0)]
    inner = codes[np.maximum(last - 1, 0)]
    ended = np.isin(mark, _ENDS) | (np.isin(mark, _CLOSING) & np.isin(inner, _ENDS))
    paragraph = lines >= 2
    heading = (lines >= 1) & (codes[starts] == ord("#"))
    wide = np.flatnonzero(np.isin(codes[:-1], _WIDE_ENDS) & ~np.isin(codes[1:], _WIDE_ENDS) & ~space[1:]) + 1
    sentences = np.union1d(starts[ended | paragraph | heading], wide)
    return [starts[heading], starts[paragraph | heading], sentences, np.union1d(starts, wide)]


def _farthest(marks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The last mark in each ``[low, high]``, or -1."""
    if not len(marks):
        return np.full(len(low), -1, dtype=np.int64)
    found = marks[np.maximum(np.searchsorted(marks, high, side="right") - 1, 0)]
    return np.where((found >= low) & (found <= high), found, -1)


def overlap_starts(ends: np.ndarray, kinds: list[np.ndarray], overlap: int) -> np.ndarray:
    """Where the piece after each cut begins: at the first sentence, else word, of the overlap, else with all of it."""
    full = np.maximum(ends - overlap, 0)
    begin = full.copy()
    open_ = np.ones(len(ends), dtype=bool)
    for marks in (kinds[2], kinds[3]):
        if len(marks):
            found = marks[np.minimum(np.searchsorted(marks, full), len(marks) - 1)]
            use = open_ & (found >= full) & (found < ends)
            begin = np.where(use, found, begin)
            open_ &= ~use
    return np.where(ends == 0, 0, begin)


def successors(ends: np.ndarray, kinds: list[np.ndarray], n: int, limit: int, overlap: int) -> np.ndarray:
    """The farthest legal cut after each cut; of the strongest kind found in the second half of the piece, words anywhere."""
    begin = overlap_starts(ends, kinds, overlap)
    high = begin + limit
    after = np.full(len(ends), -1, dtype=np.int64)
    for strength, marks in enumerate(kinds):
        low = np.maximum(ends + 1, begin + limit // 2) if strength < 3 else ends + 1
        found = _farthest(marks, low, high)
        after = np.where(after < 0, found, after)
    after = np.where(after < 0, high, after)
    return np.where(high >= n, n, after)


def _strides(places: np.ndarray, marks: np.ndarray, step: int) -> np.ndarray:
    """The places, and all a step apart after each up to the next mark."""
    counts = (marks[np.searchsorted(marks, places)] - places) // step + 1
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.unique(np.repeat(places, counts) + nth * step)


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """``(start, end)`` of every piece of a text."""
    n = len(text)
    if n <= limit:
        return [(0, n)]
    kinds = boundaries(text)
    # Every place where a piece may begin is a node.
    nodes = np.union1d(np.array([0, n], dtype=np.int64), kinds[3])
    table = successors(nodes, kinds, n, limit, overlap)
    while True:
        new = np.setdiff1d(table, nodes)
        if not len(new):
            break
        # Cuts inside an unbroken stretch: from each there, all further ones up to the stretch's end are known.
        new = np.setdiff1d(_strides(new, np.append(kinds[3], n), limit - overlap), nodes)
        both = np.concatenate([nodes, new])
        order = np.argsort(both)
        table = np.concatenate([table, successors(new, kinds, n, limit, overlap)])[order]
        nodes = both[order]
    jump = np.searchsorted(nodes, table)
    jump[-1] = len(nodes) - 1
    marked = np.array([0])
    while True:
        reached = np.union1d(marked, jump[marked])
        if len(reached) == len(marked):
            break
        marked, jump = reached, jump[jump]
    ends = nodes[marked]
    return list(zip(overlap_starts(ends[:-1], kinds, overlap).tolist(), ends[1:].tolist()))


def split_texts(
    rows: DataFrame, key: str = "row_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True
) -> DataFrame:
    """``(key, piece, start, end, pieces, text)``: the pieces of every text in order, ``piece`` from 1.

    A piece has at most ``limit`` code points; each later one begins with up to
    ``overlap`` of the last of the one before, so that nothing is lost.  A text
    within the limit (an empty one too) is one piece, a null text none.  An
    unbroken stretch is cut at the limit.  Repeated rows repeat their pieces;
    other columns are dropped; an empty table gives an empty result.  No
    shuffle; only texts over the limit leave the JVM.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be shorter than half a piece")
    kind = rows.schema[key].dataType.simpleString()
    texts = rows.select(F.col(key).alias(key), F.col(text).alias("__text")).filter(F.col("__text").isNotNull())
    long = F.length("__text") > limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                owner, piece, begins, ends, pieces, bodies = [], [], [], [], [], []
                for row, body in enumerate(part.column(1).to_pylist()):
                    found = cuts(body, limit, overlap)
                    owner += [row] * len(found)
                    piece += range(1, len(found) + 1)
                    pieces += [len(found)] * len(found)
                    begins += [b for b, _ in found]
                    ends += [e for _, e in found]
                    bodies += [body[b:e] if with_text else None for b, e in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner, pa.int32())),
                        *(pa.array(x, pa.int32()) for x in (piece, begins, ends, pieces)),
                        pa.array(bodies, pa.string()),
                    ],
                    names=[key, "piece", "start", "end", "pieces", "text"],
                )

    schema = f"`{key}` {kind}, piece int, start int, end int, pieces int, text string"
    whole = texts.filter(~long).select(
        key,
        F.lit(1).alias("piece"),
        F.lit(0).alias("start"),
        F.length("__text").alias("end"),
        F.lit(1).alias("pieces"),
        (F.col("__text") if with_text else F.lit(None).cast("string")).alias("text"),
    )
    return texts.filter(long).mapInArrow(run, schema).unionByName(whole)

"""Passages of held-out items inside a corpus, by spaced-seed hashing.

A seed is a window of ``SPAN`` words of which a fixed mask ignores some.  The
masks' ignored positions together cover the whole window, so a passage with a
substituted word still agrees with the held-out text under some mask; one mask
is enough where no word may differ.  Seeds of both sides meet in an equi-join
on their hash; every hit is verified word by word, and hits along one alignment
are put together to the stretch that leaked (``stretches``).

Corpus seeds first pass a bitmap of the held-out seeds, of 32 bits or more for
each of them up to 32 MB in all; it only keeps rows from the shuffle that have
no partner, and never loses one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import cut_lineage, spread

SPAN = 12
MASKS = tuple(tuple(p for p in range(SPAN) if p % 3 != ignored) for ignored in range(3))
FEWEST_BITS, MOST_BITS = 20, 28  # of the bitmap: powers of two

_WORD = re.compile(r"[^\W_]+")
_MIX = (np.arange(1, SPAN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class _Hashes(dict):
    """Memo of words' 64-bit hashes."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(texts: list[str | None], memo: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words behind one another, and where each text's words begin and end."""
    lists = [_WORD.findall(t.lower()) if t else [] for t in texts]
    bounds = np.zeros(len(lists) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in lists], out=bounds[1:])
    flat = np.fromiter((memo[w] for words in lists for w in words), dtype=np.uint64, count=int(bounds[-1]))
    return flat, bounds


def seed_hashes(flat: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The seed of every window of the flat words, text ends not heeded."""
    windows = len(flat) - SPAN + 1
    if windows <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(windows, number * 0x2545F491 + 1, dtype=np.uint64)
    for p in mask:
        total += flat[p : p + windows] * _MIX[p]
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


def _inside(bounds: np.ndarray, windows: int) -> np.ndarray:
    """Which windows lie within one text."""
    ok = np.zeros(windows + 1, dtype=np.int32)
    first, last = bounds[:-1], bounds[1:] - SPAN + 1
    long = last > first
    np.add.at(ok, first[long], 1)
    np.add.at(ok, last[long], -1)
    return np.cumsum(ok[:-1]) > 0


def _seed_batches(
    batches: Iterator[pa.RecordBatch], n_keys: int, masks: tuple[tuple[int, ...], ...], bitmap: np.ndarray | None
) -> Iterator[pa.RecordBatch]:
    """Seeds of batches of key columns and a text; with a bitmap, only those it holds."""
    memo = _Hashes()
    shift = np.uint64(0 if bitmap is None else 64 - (len(bitmap) * 8).bit_length() + 1)
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            flat, bounds = word_hashes(part.column(n_keys).to_pylist(), memo)
            windows = len(flat) - SPAN + 1
            if windows <= 0:
                continue
            inside = _inside(bounds, windows)
            at, numbers, seeds = [], [], []
            for number, mask in enumerate(masks):
                hashes = seed_hashes(flat, mask, number)
                keep = inside
                if bitmap is not None:
                    bit = hashes >> shift
                    keep = inside & ((bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                where = np.flatnonzero(keep)
                at.append(where)
                numbers.append(np.full(len(where), number, dtype=np.int32))
                seeds.append(hashes[where])
            where, mask, seed = np.concatenate(at), np.concatenate(numbers), np.concatenate(seeds)
            owner = np.searchsorted(bounds, where, side="right") - 1
            words = flat[where[:, None] + np.arange(SPAN)[None, :]].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(where) * SPAN + 1, SPAN, dtype=np.int32)), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(k).take(pa.array(owner)) for k in range(n_keys)),
                    pa.array((where - bounds[owner]).astype(np.int32)),
                    pa.array(mask),
                    pa.array(seed.view(np.int64)),
                    lists,
                ],
                names=[*part.schema.names[:n_keys], "at", "mask", "seed", "words"],
            )


def seeds_of(df: DataFrame, keys: list[str], text: str, masks: tuple[tuple[int, ...], ...] = MASKS, bitmap: np.ndarray | None = None) -> DataFrame:
    """``(keys, at, mask, seed, words)``: one row for each window and mask."""
    n_keys = len(keys)
    typed = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    shared = None if bitmap is None else df.sparkSession.sparkContext.broadcast(bitmap)  # 32 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _seed_batches(batches, n_keys, masks, None if shared is None else shared.value)

    return df.select(*keys, text).mapInArrow(run, f"{typed}, at int, mask int, seed bigint, words array<bigint>")


def seed_bitmap(seeds: DataFrame) -> np.ndarray:
    """The bitmap of all seeds, by their number; each task hands the driver one, and there are at most 8."""
    count = seeds.count()
    power = int(np.clip((32 * max(count, 1) - 1).bit_length(), FEWEST_BITS, MOST_BITS))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (power - 3), dtype=np.uint8)
        for batch in batches:
            bit = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - power)
            np.bitwise_or.at(bits, (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    rows = seeds.select("seed").coalesce(8).mapInArrow(fold, "bits binary").collect()
    empty = np.zeros(1 << (power - 3), dtype=np.uint8)
    return reduce(np.bitwise_or, (np.frombuffer(bytes(r.bits), dtype=np.uint8) for r in rows), empty)


def find_leaks(
    corpus: DataFrame,
    held_out: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    fields: tuple[str, ...] = ("question", "answer"),
    substitutions: int = 0,
) -> DataFrame:
    """``(key, item, field, at, item_at, substituted)``: every window of a document that stands in an item's field.

    A window is ``SPAN`` words; at most ``substitutions`` of them may differ
    (any one word, or several that one mask ignores).  Words are longest runs
    of letters and digits in lower case; all else between them is ignored.
    Null, empty and shorter texts have no window; repeated rows repeat theirs;
    other columns are dropped; an empty table on either side gives no row.
    """
    if not 0 <= substitutions <= SPAN // 3:
        raise ValueError("a mask ignores a third of the window")
    items = held_out.select(
        F.col(item).alias("__item"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("body")) for f in fields])).alias("f"),
    ).select("__item", F.col("f.name").alias("__field"), F.col("f.body").alias("__body"))
    masks = MASKS if substitutions else MASKS[:1]
    item_seeds = cut_lineage(seeds_of(items, ["__item", "__field"], "__body", masks))
    bitmap = seed_bitmap(item_seeds)
    found = seeds_of(spread(corpus.select(key, text), key), [key], text, masks, bitmap)
    hits = found.alias("c").join(item_seeds.alias("h"), ["seed", "mask"])
    differing = F.size(F.filter(F.zip_with("c.words", "h.words", lambda a, b: a != b), lambda x: x))
    return (
        hits.select(
            F.col(f"c.{key}").alias(key),
            F.col("h.__item").alias(item),
            F.col("h.__field").alias("field"),
            F.col("c.at").alias("at"),
            F.col("h.at").alias("item_at"),
            (F.lit(0) if substitutions == 0 else differing).alias("substituted"),
            (F.col("c.words") == F.col("h.words") if substitutions == 0 else differing <= substitutions).alias("ok"),
        )
        .filter("ok")
        .drop("ok")
        .distinct()
    )


def stretches(windows: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """``(key, item, field, at, item_at, words)``: windows of one alignment that touch or overlap, put together, with their length in words.

    A window function's group is one alignment of a document with an item.
    """
    aligned = Window.partitionBy(key, item, "field", "shift").orderBy("at")
    rows = windows.select(key, item, "field", "at", "item_at").distinct().withColumn("shift", F.col("at") - F.col("item_at"))
    begins = F.coalesce(F.col("at") - F.lag("at").over(aligned) > SPAN, F.lit(True))
    rows = rows.withColumn("stretch", F.sum(begins.cast("int")).over(aligned.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, item, "field", "shift", "stretch").agg(
        F.min("at").alias("at"), F.min("item_at").alias("item_at"), (F.max("at") - F.min("at") + SPAN).alias("words")
    ).drop("shift", "stretch")


def leaked_items(windows: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """``(key, item, words)``: one row for each document and item, with the words of the longest stretch that leaked."""
    return stretches(windows, key, item).groupBy(key, item).agg(F.max("words").alias("words"))

"""Relational shapes the pipelines are made of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import cut_lineage


def last_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Of rows with one key the last by ``order``; a plain aggregation, so that a hot key is reduced before the shuffle."""
    others = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__row"))
    return picked.select(*[key if c == key else F.col(f"__row.{c}").alias(c) for c in rows.columns])


def first_per_value(rows: DataFrame, value: Column, order: str) -> DataFrame:
    """Exact duplicates removed: of rows of equal value the first; nulls stay.  The value is grouped by its hash."""
    marked = rows.withColumn("__mark", F.sha2(value.cast("string"), 256))
    first = marked.filter(F.col("__mark").isNotNull()).groupBy("__mark").agg(F.min(order).alias("__first"))
    kept = rows.join(first.select(F.col("__first").alias(order)), order, "left_semi")
    return kept.unionByName(rows.filter(value.isNull()))


def through_cache(rows: DataFrame, key: str, cache: DataFrame, value: str, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Rows with their cached value, computed once for each key that the cache lacks; and those new entries.

    ``cache`` is ``(key, value)`` with unique keys; ``compute`` turns distinct
    missing rows into ``(key, value)``.  It runs here and once: both results
    read what it gave from a checkpoint, however often they are used.
    """
    missing = rows.dropDuplicates([key]).join(cache.select(key), key, "left_anti")
    new = cut_lineage(compute(missing).select(key, value))
    known = cache.select(key, value).unionByName(new)
    return rows.join(known, key, "left"), new


def islands(rows: DataFrame, group: str, order: str, *same: str) -> DataFrame:
    """Add ``island``: the number of the run of consecutive rows that are alike in ``same``."""
    ordered = Window.partitionBy(group).orderBy(order)
    changed = ~F.struct(*same).eqNullSafe(F.lag(F.struct(*same)).over(ordered))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__new", (changed | (F.row_number().over(ordered) == 1)).cast("int")).withColumn("island", F.sum("__new").over(so_far).cast("int")).drop("__new")


def joined_text(rows: DataFrame, keys: list[str], order: str, text: str, separator: str) -> DataFrame:
    """``(keys, text)``: texts of a group put together in order."""
    some = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(some, lambda x: x[text]), separator).alias(text))


def top_k(rows: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``; cut before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("rank") <= k)


def status_counts(rows: DataFrame, archive: str = "archive", status: str = "status") -> DataFrame:
    """``(archive, status, n)`` of each archive, and overall where ``archive`` is null."""
    counted = rows.groupBy(archive, status).agg(F.count("*").alias("n"))
    overall = counted.groupBy(status).agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias(archive), status, "n")
    return counted.unionByName(overall)


def accuracy(judged: DataFrame, correct: str = "correct") -> DataFrame:
    """``(accuracy, correct, incorrect)``: no verdict is incorrect; of no rows all are 0."""
    right = F.count_if(F.coalesce(F.col(correct) == "yes", F.lit(False)))
    out = judged.agg(right.alias("correct"), (F.count("*") - right).alias("incorrect"))
    total = F.col("correct") + F.col("incorrect")
    return out.select(F.when(total > 0, F.col("correct") / total).otherwise(0.0).alias("accuracy"), "correct", "incorrect")


def budgeted_search(texts: DataFrame, text: str, all_of: list[str], n: int, order: str) -> DataFrame:
    """Keyword search: the first ``n`` rows that hold every word, whatever its case; none for no words."""
    if not all_of:
        return texts.limit(0)
    found = texts
    for word in all_of:
        found = found.filter(F.lower(text).contains(word.lower()))
    return found.orderBy(order).limit(n)

"""Where results go."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_markdown(documents: DataFrame, path: str) -> None:
    """``(archive, member, markdown)`` as Parquet, the main form."""
    documents.write.mode("overwrite").parquet(path)


def write_markdown_files(documents: DataFrame, folder: str) -> None:
    """One ``.md`` file for each article in a folder all executors share; names hold archive and member, so that equal stems don't meet.

    A file is written beside its place and moved there, so that a repeated task
    leaves whole files.
    """

    def write(rows: Iterator[Row]) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            name = "".join(c if c.isalnum() or c in "-_." else "_" for c in f"{row.archive}__{os.path.splitext(row.member)[0]}")
            target = os.path.join(folder, f"{name}.md")
            with open(f"{target}.{os.getpid()}", "w", encoding="utf-8") as out:
                out.write(row.markdown)
            os.replace(f"{target}.{os.getpid()}", target)

    documents.select("archive", "member", "markdown").foreachPartition(write)


def write_single(documents: DataFrame, path: str, column: str = "markdown") -> None:
    """The text of the only row as one file."""
    rows = documents.select(column).take(2)
    if len(rows) != 1:
        raise ValueError("a single file takes a single row")
    with open(path, "w", encoding="utf-8") as out:
        out.write(rows[0][0] or "")


def write_splits(rows: DataFrame, path: str, split: str = "split") -> None:
    """A dataset of several splits, one folder each."""
    rows.withColumn(split, F.coalesce(split, F.lit("train"))).write.mode("overwrite").partitionBy(split).parquet(path)

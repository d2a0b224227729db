"""Append-only JSON-lines caches."""

from __future__ import annotations

import json
import os
import time
import uuid

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.operators.relational import last_per_key


def parse_cache(lines: DataFrame, schema: StructType, line: str = "value", key: str = "hash", order: str = "pos") -> DataFrame:
    """Cache entries of JSON lines: malformed ones and those without key or value are skipped, of one key the last in ``order`` counts."""
    # A field of its own tells a malformed line from one that lacks a field.
    wide = StructType([*schema.fields]).add("__bad", "string")
    parsed = lines.select(order, F.from_json(line, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}).alias("r"))
    whole = F.col("r").isNotNull() & F.col("r.__bad").isNull()
    for name in schema.fieldNames():
        whole = whole & F.col(f"r.{name}").isNotNull()
    rows = parsed.filter(whole).select(order, *[F.col(f"r.{n}").alias(n) for n in schema.fieldNames()])
    return last_per_key(rows, key, order).drop(order)


def read_cache(spark: SparkSession, path: str, schema: StructType, key: str = "hash") -> DataFrame:
    """The cache in a folder of JSON-lines files; of one key the entry of the file written last, and in it the last line, wins."""
    file = F.col("_metadata")
    place = F.struct(file["file_modification_time"].alias("time"), file["file_name"].alias("file"), file["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).withColumn("pos", place)
    return parse_cache(lines, schema, key=key)


def append_cache(new: DataFrame, path: str) -> None:
    """Append new entries; a failed attempt leaves none behind."""
    new.write.mode("append").json(path)


class CacheLog:
    """Appends entries to a cache folder from within a task, as soon as they are there.

    Each call writes one file under a hidden name and then renames it, so that
    a reader sees whole entries only, and what was answered before a crash is
    not asked again.  A repeated task repeats entries, of which the last counts.
    ``uri`` is a path or URI that all executors reach.
    """

    def __init__(self, uri: str):
        self.uri = uri

    def write(self, entries: list[dict]) -> None:
        if not entries:
            return
        system, folder = FileSystem.from_uri(self.uri if "://" in self.uri else f"file://{os.path.abspath(self.uri)}")
        system.create_dir(folder, recursive=True)
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        with system.open_output_stream(f"{folder}/.{name}") as out:
            out.write("".join(json.dumps(e, ensure_ascii=False) + "\n" for e in entries).encode("utf-8", "replace"))
        system.move(f"{folder}/.{name}", f"{folder}/{name}")

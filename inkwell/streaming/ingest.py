"""Incremental ingest of files, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkwell.plans.ingest import with_status
from inkwell.plans.render import to_markdown


def ingest_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, topic: str | None = None, suffix: str = "*.xml") -> StreamingQuery:
    """Parse, filter and render the files that came since the last run, and append them to ``target``; done files are in the checkpoint."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", suffix).load(source)
    rows = raw.select(F.lit("files").alias("archive"), F.regexp_extract("path", r"([^/]+)$", 1).alias("member"), "content")
    marked = with_status(rows, topic)
    done = to_markdown(marked).select("archive", "member", "status", F.col("doc.error").alias("error"), F.when(F.col("status") == "saved", F.col("markdown")).alias("markdown"))
    return done.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, group: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``(start, group, n)`` of tumbling windows; on a stream, windows close ``late`` after their end."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), group).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), group, "n")

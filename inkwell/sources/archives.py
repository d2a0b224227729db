"""Articles in tar archives as a Python data source, and single files."""

from __future__ import annotations

import glob
import importlib
import os
import tarfile
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkwell.providers import with_retries

SUFFIXES = (".tar.gz", ".tgz")


class _Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


def open_local(name: str) -> BinaryIO:
    """The default way to an archive."""
    return open(name, "rb")


class _ArchiveReader(DataSourceReader):
    def __init__(self, path: str, member_suffix: str, names: list[str], fetch: str):
        self.path, self.member_suffix, self.names, self.fetch = path, member_suffix, names, fetch

    def partitions(self) -> list[InputPartition]:
        if self.names:
            return [_Archive(name) for name in self.names]
        found = [self.path] if os.path.isfile(self.path) else glob.glob(os.path.join(self.path, "*"))
        return [_Archive(p) for p in sorted(found) if p.endswith(SUFFIXES)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """The members in the order they stand, one in memory at a time; a cut-off archive gives those before the cut."""
        name = os.path.basename(partition.path)
        module, _, function = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), function)
        try:
            with with_retries(lambda: fetch(partition.path)) as stream, tarfile.open(fileobj=stream, mode="r|gz") as archive:
                for member in archive:
                    if member.isfile() and member.name.endswith(self.member_suffix):
                        handle = archive.extractfile(member)
                        yield name, member.name, handle.read() if handle else None
        except (tarfile.ReadError, EOFError, OSError) as e:
            yield name, f"<{type(e).__name__}>", None


class XmlTarSource(DataSource):
    """``spark.read.format("xmltar").load(folder or archive)``: ``(archive, member, content)``, one partition for each archive.

    Option ``suffix`` names the members' ending (``.xml``).  Options ``names``
    (one a line) and ``fetch`` (``module:function`` that opens a name as a
    binary stream, on the executor, retried while it raises ``RateLimited``)
    take archives from elsewhere, streamed and never held as a whole.  An
    archive that cannot be read gives a row without content, which the parse
    turns into an error; it does not end the job.
    """

    @classmethod
    def name(cls) -> str:
        return "xmltar"

    def schema(self) -> str:
        return "archive string, member string, content binary"

    def reader(self, schema) -> DataSourceReader:
        path, names = self.options.get("path"), self.options.get("names", "").split("\n")
        names = [n for n in names if n]
        if not path and not names:
            raise ValueError("xmltar needs a path or names")
        return _ArchiveReader(path or "", self.options.get("suffix", ".xml"), names, self.options.get("fetch", f"{__name__}:open_local"))


def read_archives(spark: SparkSession, path: str, suffix: str = ".xml") -> DataFrame:
    """The members of all archives of a folder."""
    spark.dataSource.register(XmlTarSource)
    return spark.read.format("xmltar").option("suffix", suffix).load(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Single files as ``(archive, member, content)``; the archive is their folder."""
    from pyspark.sql import functions as F

    raw = spark.read.format("binaryFile").load(path)
    return raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("archive"), F.regexp_extract("path", r"([^/]+)$", 1).alias("member"), "content")


def fetch_archives(spark: SparkSession, names: list[str], fetch: str, suffix: str = ".xml") -> DataFrame:
    """The members of named archives that ``fetch`` (``module:function``) opens."""
    spark.dataSource.register(XmlTarSource)
    return spark.read.format("xmltar").option("suffix", suffix).option("names", "\n".join(names)).option("fetch", fetch).load()

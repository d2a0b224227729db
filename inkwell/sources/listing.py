"""Names of archives in an index page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE = r'(?i)href="([^"]+?\.tar\.gz)"'


def list_archives(pages: DataFrame, html: str, skip: int = 0, pattern: str = ARCHIVE) -> DataFrame:
    """``(name)``: the distinct linked archives in order, without the first ``skip``."""
    names = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("name"))
    return names.distinct().orderBy("name").offset(skip)

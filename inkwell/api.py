"""The public operators under one roof.

Each takes a DataFrame; where articles are read, ``content`` names the column
that holds their XML and ``keys`` the columns that tell them apart.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType

from inkwell.functions.markup import front_matter
from inkwell.operators.expand import separate_genes, separate_refs, separate_tags, separate_text
from inkwell.operators.reshape import collapse_grid, collapse_rows, repeat_sub
from inkwell.plans import render
from inkwell.schemas import ARTICLE
from inkwell.sources import jats
from inkwell.sources.archives import XmlTarSource

__all__ = [
    "collapse_grid", "collapse_rows", "register", "repeat_sub", "separate_genes", "separate_refs", "separate_tags", "separate_text",
    "to_markdown", "to_metadata", "to_reference", "to_table", "to_text",
]


def to_metadata(articles: DataFrame, *keys: str, content: str = "content") -> DataFrame:
    return jats.metadata(jats.parse_articles(articles.select(*keys, content), content), *keys)


def to_text(articles: DataFrame, *keys: str, content: str = "content", full_path: bool = False) -> DataFrame:
    return jats.text_rows(jats.parse_articles(articles.select(*keys, content), content, full_path), *keys)


def to_table(articles: DataFrame, *keys: str, content: str = "content") -> DataFrame:
    return jats.table_rows(jats.parse_articles(articles.select(*keys, content), content), *keys)


def to_reference(articles: DataFrame, *keys: str, content: str = "content") -> DataFrame:
    return jats.reference_rows(jats.parse_articles(articles.select(*keys, content), content), *keys)


def to_markdown(articles: DataFrame, *keys: str, content: str = "content", include_metadata: bool = True, include_references: bool = True) -> DataFrame:
    parsed = jats.parse_articles(articles.select(*keys, content), content)
    return render.to_markdown(parsed, include_metadata, include_references).select(*keys, "markdown")


class _ParseArticle:
    def eval(self, content: str):
        record = jats.parse(content)
        yield tuple(record[name] for name in ARTICLE.fieldNames())


def register(spark: SparkSession) -> None:
    """Make the engine's functions known to SQL: ``parse_article`` (a table function), ``front_matter``, ``count_words``, and the ``xmltar`` source."""
    spark.udtf.register("parse_article", udtf(_ParseArticle, returnType=ARTICLE))
    spark.udf.register("front_matter", front_matter)

    @F.pandas_udf(IntegerType())
    def count_words(text: pd.Series) -> pd.Series:
        return text.fillna("").str.split().str.len()

    spark.udf.register("count_words", count_words)
    spark.dataSource.register(XmlTarSource)

"""Archives to Markdown: scan, parse once, filter, render, count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import filters as P
from inkwell.operators.relational import status_counts
from inkwell.plans.render import to_markdown
from inkwell.sources.jats import parse_articles


def with_status(articles: DataFrame, topic: str | None = P.TOPIC, refused: tuple[str, ...] = P.REFUSED_LICENSES) -> DataFrame:
    """Articles ``(archive, member, content)`` with ``doc`` and ``status``; ``topic`` None lets any topic pass."""
    parsed = parse_articles(articles)
    code = F.when(F.col("doc.meta.license_url").isNotNull(), T.license_code(F.col("doc.meta.license_url")))
    on_topic = F.lit(True) if topic is None else P.on_topic(F.col("doc.topic_text"), pattern=topic)
    allowed = P.license_allowed(code, refused)
    status = F.when(F.col("doc.error").isNotNull(), "error").when(allowed & P.is_type(F.col("doc.article_type")) & on_topic, "saved").otherwise("filtered")
    return parsed.withColumn("status", status)


def ingest(articles: DataFrame, topic: str | None = P.TOPIC) -> tuple[DataFrame, DataFrame]:
    """The saved articles with their Markdown, and the counts by archive and status.

    Filters run before anything is rendered; nothing but the counts is shuffled.
    """
    marked = with_status(articles, topic)
    saved = to_markdown(marked.filter(F.col("status") == "saved")).select("archive", "member", "markdown")
    return saved, status_counts(marked)

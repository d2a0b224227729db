"""Parsed articles as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import markup as M
from inkwell.functions import text as T


def _fragments(sections: Column, tables: Column) -> Column:
    """``(section, text)`` of each paragraph, figure and table of an article; marks of tables that are not there vanish."""

    def text(s: Column) -> Column:
        table = F.get(F.filter(tables, lambda t: t["label"] == s["text"]), F.lit(0))
        return (
            F.when(s["kind"] == "text", F.array_join(T.sentences(T.normalize_paragraph(s["text"])), " "))
            .when(s["kind"] == "table", M.table_markdown(table["label"], table["header"], table["rows"]))
            .otherwise(s["text"])
        )

    return F.transform(sections, lambda s: F.struct(s["section"].alias("section"), text(s).alias("text")))


def content(sections: Column, tables: Column) -> Column:
    """The sections in order of their first mention; those of one name are one."""
    fragments = _fragments(sections, tables)
    names = F.array_distinct(F.transform(fragments, lambda f: f["section"]))

    def one(name: Column) -> Column:
        own = F.filter(fragments, lambda f: (f["section"] == name) & (F.coalesce(f["text"], F.lit("")) != ""))
        return M.section(name, F.transform(own, lambda f: f["text"]))

    return F.array_join(F.transform(names, one), "\n\n")


def references(refs: Column) -> Column:
    """The list of references under its heading; null if there are none."""
    lines = F.transform(refs, lambda r: M.reference_line(r["id"], r["authors"], r["title"], r["journal"], r["year"], r["volume"], r["pages"], r["doi"], r["pmid"]))
    return F.when(F.size(refs) > 0, F.concat(F.lit("## References\n\n"), F.array_join(lines, "\n\n")))


def to_markdown(parsed: DataFrame, include_metadata: bool = True, include_references: bool = True) -> DataFrame:
    """Add ``markdown``: front matter with title, sections, references, joined by blank lines; a record in error gets null."""
    m = lambda n: F.col(f"doc.meta.{n}")
    code = F.when(m("license_url").isNotNull(), T.license_code(m("license_url")))
    parts = []
    if include_metadata:
        head = M.front_matter(m("title"), m("authors"), m("journal"), m("year"), m("pmc_id"), m("doi"), code)
        parts.append(F.nullif(head, F.lit("")))
    parts.append(F.nullif(content(F.col("doc.sections"), F.col("doc.tables")), F.lit("")))
    if include_references:
        parts.append(references(F.col("doc.refs")))
    return parsed.withColumn("markdown", F.when(F.col("doc.error").isNull(), F.concat_ws("\n\n", *parts)))

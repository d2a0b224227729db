"""Articles in JATS XML, parsed once into one nested struct.

Everything after the parse is Column expressions over its fields.  Element
names are compared without namespace.  A payload that cannot be parsed gives
``error`` and null parts, never a failed job.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from inkwell.functions import text as T
from inkwell.schemas import ARTICLE
from inkwell.session import spread

_LINK = "{http://www.w3.org/1999/xlink}href"
_ENTITY = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)(\w+);")

# Cells that stand for no value.
ABSENT_CELLS = ("", "#N/A", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _name(el: ET.Element) -> str:
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def _all(el: ET.Element, name: str) -> Iterator[ET.Element]:
    return (x for x in el.iter() if x is not el and _name(x) == name)


def _first(el: ET.Element | None, name: str) -> ET.Element | None:
    return None if el is None else next(_all(el, name), None)


def _inner(el: ET.Element | None) -> str | None:
    """All text of an element, as it stands."""
    return None if el is None else "".join(el.itertext())


def _stripped(value: str | None) -> str | None:
    value = (value or "").strip()
    return value or None


def _own(el: ET.Element | None) -> str | None:
    """The text of an element before its first child."""
    return None if el is None else _stripped(el.text)


def _number(value: str | None) -> int | None:
    value = (value or "").strip()
    return int(value) if value.isdigit() and len(value) < 10 else None


def _license_url(front: ET.Element) -> str | None:
    """The first licence address: on a licence element, by its reference, in a link; then any reference; then any free link of the permissions."""
    for licence in _all(front, "license"):
        tried = [licence.get(_LINK), licence.get("href"), _inner(_first(licence, "license_ref"))]
        for link in _all(licence, "ext-link"):
            tried += [link.get(_LINK), _inner(link)]
        for value in tried:
            if _stripped(value):
                return value.strip()
    for ref in _all(front, "license_ref"):
        if _stripped(_inner(ref)):
            return _inner(ref).strip()
    permissions = _first(front, "permissions")
    for el in permissions.iter() if permissions is not None else ():
        link = el.get(_LINK) or ""
        if "creativecommons" in link or "publicdomain" in link:
            return link.strip()
    return None


def _metadata(root: ET.Element) -> dict | None:
    front = _first(root, "front")
    if front is None:
        return None
    ids: dict[str, str | None] = {}
    for el in _all(front, "article-id"):
        ids.setdefault(el.get("pub-id-type", ""), _stripped(el.text))
    authors = []
    group = _first(front, "contrib-group")
    for person in _all(group, "contrib") if group is not None else ():
        surname, given = _own(_first(person, "surname")), _own(_first(person, "given-names"))
        if person.get("contrib-type") == "author" and surname and given:
            authors.append(f"{given} {surname}")
    dates = list(_all(front, "pub-date"))
    date = next((d for d in dates if d.get("pub-type") == "epub"), dates[0] if dates else None)
    issns = list(_all(front, "issn"))
    issn = next((i for i in issns if i.get("pub-type") == "epub"), issns[0] if issns else None)
    abbrev = next((j for j in _all(front, "journal-id") if j.get("journal-id-type") == "nlm-ta"), None)
    url = _license_url(front)
    meta_title = _first(_first(front, "title-group"), "article-title")
    return {
        "pmc_id": ids.get("pmc"), "pmid": ids.get("pmid"), "doi": ids.get("doi"),
        "title": _stripped(_inner(meta_title if meta_title is not None else _first(front, "article-title"))),
        "authors": authors or None,
        "year": _number(_own(_first(date, "year"))), "month": _number(_own(_first(date, "month"))), "day": _number(_own(_first(date, "day"))),
        "license_url": url,
        "journal": _stripped(_inner(_first(front, "journal-title"))), "journal_abbrev": _own(abbrev), "issn": _own(issn),
    }


def _sections(root: ET.Element, full_path: bool) -> list[dict]:
    """The paragraphs, figures and table marks of all sections: the body first, then sections and abstracts in order."""
    out: list[dict] = []
    chain: list[tuple[ET.Element, list[ET.Element]]] = []

    def collect(el: ET.Element, above: list[ET.Element]) -> None:
        name = _name(el)
        inside = [*above, el] if name in ("sec", "abstract") else []
        if name in ("sec", "abstract"):
            chain.append((el, inside))
        for child in el:
            collect(child, inside)

    collect(root, [])
    body = _first(root, "body")
    for el, line in ([(body, [body])] if body is not None else []) + chain:
        titles = [t for t in (_stripped(_inner(next((c for c in x if _name(c) == "title"), None))) for x in reversed(line)) if t]
        in_abstract = any(_name(x) == "abstract" for x in line)
        if not titles:
            path = "Abstract" if _name(el) == "abstract" else "Body" if _name(el) == "body" else "Unknown"
        else:
            path = "; ".join(reversed(titles)) if full_path else titles[0]
            if in_abstract:
                path = f"Abstract; {path}"
        if in_abstract and not titles and _name(el) != "abstract":
            path = "Unknown"
        if _name(el) == "abstract":
            out.append({"section": path, "kind": "heading", "paragraph": 0, "text": ""})
        number = 0
        for child in el:
            kind = _name(child)
            if kind == "p":
                number += 1
                if (_inner(child) or "").strip():
                    out.append({"section": path, "kind": "text", "paragraph": number, "text": _inner(child)})
            elif kind == "fig":
                label, caption = _stripped(_inner(_first(child, "label"))), _stripped(_inner(_first(child, "caption")))
                if label and caption:
                    out.append({"section": path, "kind": "figure", "paragraph": 0, "text": f"**{label}:** *{' '.join(caption.split())}*"})
            elif kind == "table-wrap":
                label = _stripped(_inner(_first(child, "label")))
                if label:
                    out.append({"section": path, "kind": "table", "paragraph": 0, "text": label})
    for pos, row in enumerate(out, 1):
        row["pos"] = pos
    return out


def grid(cells: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Rows of ``(text, columns, rows)`` cells with every span spelled out, all of one width."""
    out: list[list[str]] = []
    open_: dict[int, tuple[str, int]] = {}
    for row in cells:
        line: list[str] = []

        def pull() -> None:
            while len(line) in open_:
                text, left = open_.pop(len(line))
                if left > 1:
                    later[len(line)] = (text, left - 1)
                line.append(text)

        later: dict[int, tuple[str, int]] = {}
        for text, columns, rows in row:
            pull()
            for _ in range(max(1, min(columns, 1_000))):
                if rows > 1:
                    later[len(line)] = (text, rows - 1)
                line.append(text)
        pull()
        for at in sorted(open_):
            while len(line) < at:
                line.append("")
            pull()
        open_ = later
        out.append(line)
    width = max((len(line) for line in out), default=0)
    return [line + [""] * (width - len(line)) for line in out]


def _span(value: str | None) -> int:
    return int(value) if value and value.isdigit() and int(value) > 0 else 1


def _shaped(cells: list[list[tuple[str, int, int]]]) -> tuple[list[str], list[list[str | None]]] | None:
    """Header and rows: the first row names the columns, empty rows and columns go, absent cells are null."""
    lines = grid([row for row in cells if row])
    if not lines:
        return None
    rows = [[None if c in ABSENT_CELLS else c for c in line] for line in lines[1:]]
    rows = [r for r in rows if any(c is not None for c in r)]
    keep = [i for i in range(len(lines[0])) if any(r[i] is not None for r in rows)]
    seen: dict[str, int] = {}
    header = []
    for i, label in enumerate(lines[0]):
        label = label or f"Unnamed: {i}"
        seen[label] = seen.get(label, -1) + 1
        header.append(f"{label}.{seen[label]}" if seen[label] else label)
    return [header[i] for i in keep], [[r[i] for i in keep] for r in rows]


def _tables(root: ET.Element) -> list[dict]:
    by_label: dict[str, dict] = {}
    for number, wrap in enumerate(_all(root, "table-wrap"), 1):
        label = _stripped(_inner(_first(wrap, "label"))) or f"Table {number}"
        table = _first(wrap, "table")
        if table is None:
            continue
        cells = [
            [(" ".join((_inner(c) or "").split()), _span(c.get("colspan")), _span(c.get("rowspan"))) for c in row if _name(c) in ("td", "th")]
            for row in _all(table, "tr")
        ]
        shaped = _shaped(cells)
        if shaped:
            # A repeated label keeps the place of the first and the content of the last.
            place = by_label[label]["pos"] if label in by_label else len(by_label) + 1
            caption = _stripped(_inner(_first(wrap, "caption")))
            by_label[label] = {"pos": place, "label": label, "caption": caption, "header": shaped[0], "rows": shaped[1]}
    return list(by_label.values())


def _references(root: ET.Element) -> list[dict]:
    out = []
    for number, ref in enumerate(_all(root, "ref"), 1):
        ids: dict[str, str | None] = {}
        for el in _all(ref, "pub-id"):
            ids.setdefault(el.get("pub-id-type", ""), _stripped(el.text))
        surnames = [s for s in (_own(x) for x in _all(ref, "surname")) if s]
        given = [g for g in (_own(x) for x in _all(ref, "given-names")) if g]
        authors = ", ".join(f"{s} {g}" for s, g in zip(surnames, given)) if given and surnames else ", ".join(surnames) or None
        title = _own(_first(ref, "article-title"))
        first, last = _own(_first(ref, "fpage")), _own(_first(ref, "lpage"))
        if authors is None and title is None:
            authors = _stripped(" ".join((_inner(ref) or "").split()))
        out.append(
            {
                "id": number, "pmid": ids.get("pmid"), "authors": authors, "year": _own(_first(ref, "year")),
                "title": re.sub(r"\n\s*", " ", title) if title else None, "journal": _own(_first(ref, "source")),
                "volume": _own(_first(ref, "volume")), "pages": f"{first}-{last}" if first and last else first, "doi": ids.get("doi"),
            }
        )
    return out


def _topic(root: ET.Element) -> str:
    parts = [_inner(x) for name in ("article-title", "abstract", "kwd") for x in _all(root, name)]
    return " ".join(" ".join(p.split()) for p in parts if p).lower()


def parse(content: str | bytes | None, full_path: bool = False) -> dict:
    """One article as a record of ``schemas.ARTICLE``."""
    empty = {"error": None, "article_type": None, "meta": None, "sections": [], "tables": [], "refs": [], "topic_text": ""}
    if content is None:
        return {**empty, "error": "no content"}
    try:
        text = content.decode("utf-8-sig") if isinstance(content, (bytes, bytearray)) else content
        # Names of HTML characters are no XML; each stands for a blank.
        root = ET.fromstring(_ENTITY.sub(" ", text).encode())
        article = root if _name(root) == "article" else _first(root, "article")
        article = root if article is None else article
        return {
            "error": None, "article_type": article.get("article-type"), "meta": _metadata(article), "sections": _sections(article, full_path),
            "tables": _tables(article), "refs": _references(article), "topic_text": _topic(article),
        }
    except Exception as e:  # noqa: BLE001 - whatever a record holds must not end the job
        return {**empty, "error": f"{type(e).__name__}: {e}"[:200]}


def parse_articles(df: DataFrame, content: str = "content", full_path: bool = False) -> DataFrame:
    """Add ``doc``: each row's article as a struct of ``schemas.ARTICLE``; the parse runs once in Arrow batches."""
    names = df.columns
    schema = StructType([*df.schema.fields, StructField("doc", ARTICLE)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[names].copy()
            out["doc"] = [parse(c, full_path) for c in frame[content]]
            yield out

    return spread(df).mapInPandas(run, schema)


def split_articles(payload: Column) -> Column:
    """All ``<article>`` elements of a payload."""
    return F.regexp_extract_all(payload, F.lit(r"(?is)<article\b[^>]*?>.*?</article>"), F.lit(0))


def metadata(parsed: DataFrame, *keys: str) -> DataFrame:
    """``(keys, METADATA fields)`` of parsed articles that have a front; the licence's code is parsed from its address."""
    m = lambda n: F.col(f"doc.meta.{n}").alias(n)
    code = F.when(F.col("doc.meta.license_url").isNotNull(), T.license_code(F.col("doc.meta.license_url"))).alias("license")
    names = ["pmc_id", "pmid", "doi", "title", "authors", "year", "month", "day", "license_url"]
    return parsed.filter(F.col("doc.meta").isNotNull()).select(*keys, *map(m, names), code, m("journal"), m("journal_abbrev"), m("issn"))


def text_rows(parsed: DataFrame, *keys: str) -> DataFrame:
    """``(keys, pos, section, paragraph, sentence, text)``: sentences, figures and table marks in order, ``pos`` from 1."""
    each = parsed.select(*keys, F.explode("doc.sections").alias("s"))
    said = F.when(F.col("s.kind") == "text", T.sentences(T.normalize_paragraph(F.col("s.text")))).when(
        F.col("s.kind") == "table", F.array(F.concat(F.lit("TABLE_PLACEHOLDER:"), F.col("s.text")))
    ).otherwise(F.array(F.col("s.text")))
    rows = each.select(*keys, F.col("s.pos").alias("pos"), F.col("s.section").alias("section"), F.col("s.kind").alias("kind"), F.col("s.paragraph").alias("paragraph"), F.posexplode(said).alias("n", "text"))
    return rows.select(*keys, "pos", "section", "paragraph", F.when(F.col("kind") == "text", F.col("n") + 1).otherwise(0).alias("sentence"), "text")


def table_rows(parsed: DataFrame, *keys: str) -> DataFrame:
    """``(keys, pos, label, caption, header, rows)``: tables in long form, all cells text."""
    return parsed.select(*keys, F.explode("doc.tables").alias("t")).select(*keys, "t.*")


def reference_rows(parsed: DataFrame, *keys: str) -> DataFrame:
    """``(keys, REFERENCE fields)``: the list of references."""
    return parsed.select(*keys, F.explode("doc.refs").alias("r")).select(*keys, "r.*")


def tag_counts(payload: DataFrame, text: str, left_out: tuple[str, ...] = ("label", "note")) -> DataFrame:
    """``(tag, n)``: how often each element name opens."""
    names = F.regexp_extract_all(F.col(text), F.lit(r"<([A-Za-z][A-Za-z0-9_-]*)\b"), F.lit(1))
    return payload.select(F.explode(names).alias("tag")).filter(~F.col("tag").isin(*left_out)).groupBy("tag").agg(F.count("*").alias("n"))

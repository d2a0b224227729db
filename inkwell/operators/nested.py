"""Nested JSON records to flat related tables by columnar shredding.

A record is dissected into one column per declared leaf path.  Every entry of a
column carries a repetition level (which repeated ancestor begins anew) and a
definition level (how many of its repeated ancestors exist); a missing leaf is
an entry without value, so that the columns of one record stay aligned.  The
flat tables come back from the level sequences alone: a repeated ancestor's
number is a running count of the entries whose repetition level reaches it.

Records are walked with stacks, so that their depth has no limit.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import spread


@dataclass(frozen=True)
class Node:
    """A repeated part of a record: how its instances are found in its parent, its leaves and its repeated children."""

    name: str
    find: Callable[[object], list]
    leaves: dict[str, Callable[[object], str | None]] = field(default_factory=dict)
    children: tuple["Node", ...] = ()

    def columns(self) -> Iterator[str]:
        """The names of all leaf columns under this node."""
        yield from (f"{self.name}.{leaf}" for leaf in self.leaves)
        for child in self.children:
            yield from (f"{self.name}.{column}" for column in child.columns())


def dissect(record: object, root: Node) -> list[tuple[str, int, int, str | None]]:
    """The entries ``(column, rep, def, value)`` of one record, each column's in order."""
    out: list[tuple[str, int, int, str | None]] = []

    def missing(node: Node, prefix: str, rep: int, depth: int) -> None:
        for column in node.columns():
            out.append((prefix + column, rep, depth, None))

    def walk(node: Node, parent: object, prefix: str, rep: int, depth: int) -> None:
        found = node.find(parent)
        if not found:
            missing(node, prefix, rep, depth)
            return
        here = f"{prefix}{node.name}."
        for number, item in enumerate(found):
            level = rep if number == 0 else depth + 1
            for leaf, read in node.leaves.items():
                out.append((here + leaf, level, depth + 1, read(item)))
            for child in node.children:
                walk(child, item, here, level, depth + 1)

    walk(root, record, "", 0, 0)
    return out


_JSON_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|(")|(true|false|null)|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?))')
_JSON_WORDS = {"true": True, "false": False, "null": None}


def _integer(digits: str) -> int | str:
    """A whole number; one too long for the conversion stays as it is written."""
    return int(digits) if len(digits) < 4_000 else digits


def loads_deep(text: str) -> object:
    """A JSON text of any depth, read with a stack; ``ValueError`` if it is none."""
    root: list = []
    stack: list[tuple[object, str | None]] = [(root, None)]  # containers, and of an object the key that waits for its value
    expect, at = "value", 0
    while len(stack) > 1 or not root:
        found = _JSON_TOKEN.match(text, at)
        if not found:
            raise ValueError("no JSON")
        at = found.end()
        mark, quote, word, number = found.groups()
        holder, key = stack[-1]
        if mark in ("]", "}") and mark:
            fits = isinstance(holder, list if mark == "]" else dict) and len(stack) > 1
            if not fits or expect not in ("end", "first", "first-key"):
                raise ValueError("no JSON")
            stack.pop()
            expect = "end"
            continue
        if mark in (",", ":") and mark:
            if mark == "," and expect == "end" and len(stack) > 1:
                expect = "key" if isinstance(holder, dict) else "value"
            elif mark == ":" and expect == "colon":
                expect = "value"
            else:
                raise ValueError("no JSON")
            continue
        if expect in ("key", "first-key"):
            if not quote:
                raise ValueError("no JSON")
            name, at = json.decoder.scanstring(text, at, True)
            stack[-1] = (holder, name)
            expect = "colon"
            continue
        if expect not in ("value", "first"):
            raise ValueError("no JSON")
        if quote:
            value, at = json.decoder.scanstring(text, at, True)
        elif mark:
            value = [] if mark == "[" else {}
        elif word:
            value = _JSON_WORDS[word]
        else:
            value = float(number) if any(c in number for c in ".eE") else _integer(number)
        if isinstance(holder, list):
            holder.append(value)
        else:
            holder[key] = value
        expect = "end"
        if mark:
            stack.append((value, None))
            expect = "first" if mark == "[" else "first-key"
    if text[at:].strip(" \t\n\r"):
        raise ValueError("no JSON")
    return root[0]


def _valid(payload: str | None) -> tuple[bool, object]:
    """Whether a payload is valid JSON, and what it holds, however deep."""

    def refuse(name: str) -> None:
        raise ValueError(f"{name} is no JSON")

    if payload is None:
        return False, None
    try:
        return True, json.loads(payload, parse_constant=refuse, parse_int=_integer)
    except RecursionError:
        pass
    except ValueError:
        return False, None
    try:
        return True, loads_deep(payload)
    except ValueError:
        return False, None


def shred(records: DataFrame, key: str, payload: str, root: Node) -> DataFrame:
    """``(key, column, ord, rep, def, val)`` of every record whose payload is valid JSON.

    Null, cut-off and otherwise invalid payloads give no row; ``invalid_records``
    names them.  Valid ones are read whatever their depth.  Keys are unique
    but for repeated rows, which give repeated entries (``numbered`` drops
    them).  Other columns are dropped.  An empty table gives an empty result.
    """
    kind = records.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, entries, order = [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ok, record = _valid(text)
                if ok:
                    found = dissect(record, root)
                    keys += [row] * len(found)
                    order += range(len(found))
                    entries += found
            clean = [None if v is None else v.encode("utf-8", "replace").decode() for *_, v in entries]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keys, pa.int32())),
                    pa.array([e[0] for e in entries], pa.string()),
                    pa.array(order, pa.int32()),
                    pa.array([e[1] for e in entries], pa.int32()),
                    pa.array([e[2] for e in entries], pa.int32()),
                    pa.array(clean, pa.string()),
                ],
                names=[key, "column", "ord", "rep", "def", "val"],
            )

    rows = spread(records.select(key, payload), key)
    return rows.mapInArrow(run, f"`{key}` {kind}, column string, ord int, rep int, def int, val string")


def numbered(levels: DataFrame, key: str, depth: int) -> DataFrame:
    """Add ``n1 .. n<depth>``: the number of each repeated ancestor within the one above it, from the level sequences.

    A group of the window is one column of one record.
    """
    column = Window.partitionBy(key, "column").orderBy("ord")
    # One shuffle serves both: repeated records leave, and the windows find their rows together.
    out = levels.repartition(F.col(key), F.col("column")).dropDuplicates([key, "column", "ord"])
    above: list[str] = []
    for level in range(1, depth + 1):
        running = F.sum(F.when((F.col("rep") <= level) & (F.col("def") >= level), 1).otherwise(0))
        out = out.withColumn(f"__t{level}", running.over(column))
        first = F.min(f"__t{level}").over(Window.partitionBy(key, "column", *above)) if above else F.lit(1)
        out = out.withColumn(f"n{level}", (F.col(f"__t{level}") - first + 1).cast("int"))
        above = [*above, f"n{level}"]
    return out.drop(*[f"__t{level}" for level in range(1, depth + 1)])


# -- The schema of an article's citations -------------------------------------------------------

_BLANKS = re.compile(r"\s+")


def _many(value: object) -> list:
    """The instances of a value that may be missing, single or a list; lists within lists are spread."""
    out: list = []
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack += reversed(x)
        elif x is not None:
            out.append(x)
    return out


def _text(value: object) -> str | None:
    """All text of a value in order, without attributes; blanks collapsed and trimmed; None if there is none."""
    parts: list[str] = []
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        elif isinstance(x, (int, float)) and not isinstance(x, bool):
            parts.append(str(x))
        elif isinstance(x, list):
            stack += reversed(x)
        elif isinstance(x, dict):
            stack += [y for k, y in reversed(x.items()) if not k.startswith("@")]
    return _BLANKS.sub(" ", "".join(parts)).strip() or None


def _get(value: object, *names: str) -> object:
    """The member of an object under the first of the names it has."""
    if isinstance(value, dict):
        return next((value[n] for n in names if n in value), None)
    return None


def _references(record: object) -> list:
    """The references of all lists in the order they stand, lists within lists included."""
    out: list = []
    stack: list[tuple[object, bool]] = [(record, False)]
    while stack:
        value, listed = stack.pop()
        if isinstance(value, list):
            stack += [(x, listed) for x in reversed(value)]
        elif isinstance(value, dict):
            for k, x in reversed(value.items()):
                if k == "ref" and listed:
                    stack.append((("ref", _many(x)), listed))
                elif isinstance(x, (dict, list)):
                    stack.append((x, k == "ref-list"))
        elif isinstance(value, tuple):
            out += value[1]
    return out


def _citations(reference: object) -> list:
    """A reference's citations; of alternative forms only the structured one."""
    out: list = []
    if isinstance(reference, dict):
        for k, value in reference.items():
            if k in ("element-citation", "mixed-citation"):
                out += _many(value)
            elif k == "citation-alternatives":
                for either in _many(value):
                    forms = _many(_get(either, "element-citation")) or _many(_get(either, "mixed-citation"))
                    out += forms[:1]
    return out


def _persons(citation: object) -> list[tuple[str, object]]:
    """Persons and groups named as authors, in order."""
    out: list[tuple[str, object]] = []

    def named(group: object) -> None:
        stack: list[tuple[str, object]] = [("group", group)]
        while stack:
            kind, value = stack.pop()
            if kind != "group":
                out.append((kind, value))
            elif isinstance(value, dict):
                inner: list[tuple[str, object]] = []
                for k, x in value.items():
                    if k in ("name", "string-name", "collab"):
                        inner += [("collab" if k == "collab" else "name", y) for y in _many(x)]
                    elif k == "member":
                        inner += [("group", y) for y in _many(x)]
                stack += reversed(inner)

    if isinstance(citation, dict):
        for k, value in citation.items():
            if k == "person-group":
                for group in _many(value):
                    if (_text(_get(group, "@person-group-type")) or "author") == "author":
                        named(group)
            elif k in ("name", "string-name", "collab"):
                named({k: value})
    return out


def _author(person: tuple[str, object]) -> str | None:
    kind, value = person
    if kind == "collab" or isinstance(value, str):
        return _text(value)
    parts = [_text(_get(value, "surname")), _text(_get(value, "given-names"))]
    return " ".join(p for p in parts if p) or None


def _doi(citation: object) -> str | None:
    """The first DOI, from ``10.`` on."""
    if not isinstance(citation, dict):
        return None
    for k, value in citation.items():
        kind, where = {"pub-id": ("@pub-id-type", "#text"), "ext-link": ("@ext-link-type", "@xlink:href")}.get(k, ("", ""))
        for link in _many(value) if kind else []:
            if str(_get(link, kind) or "").lower() == "doi":
                text = _text(_get(link, where)) or _text(link)
                if text and "10." in text:
                    return text[text.index("10.") :]
    return None


def _attribute(name: str) -> Callable[[object], str | None]:
    return lambda value: _text(_get(value, name))


CITATIONS = Node(
    "reference",
    _references,
    {"id": _attribute("@id"), "label": _attribute("label")},
    (
        Node(
            "citation",
            _citations,
            {
                "title": lambda c: _text(_get(c, "article-title")),
                "doi": _doi,
                "source": lambda c: _text(_get(c, "source")),
                "year": lambda c: _text(_get(c, "year")),
            },
            (Node("author", _persons, {"name": _author}),),
        ),
    ),
)


def invalid_records(records: DataFrame, key: str, payload: str) -> DataFrame:
    """``(key, error)``: the records that ``shred`` gives no row for, with the reason: ``null`` or ``invalid``."""
    kind = records.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = pa.array([None if _valid(t)[0] else "null" if t is None else "invalid" for t in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), errors], names=[key, "error"]).filter(errors.is_valid())

    return spread(records.select(key, payload), key).mapInArrow(run, f"`{key}` {kind}, error string")


def citation_values(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """``(key, ref_pos, cite_pos, field, item_pos, val)``: each author, title and DOI of each citation.

    Empty values give no row and authors without a name take no number.
    """
    fields = {"reference.citation.title": "title", "reference.citation.doi": "doi", "reference.citation.author.name": "author"}
    levels = shred(records, key, payload, CITATIONS).filter(F.col("column").isin(*fields))
    rows = numbered(levels, key, 2).filter(F.col("val").isNotNull())
    within = Window.partitionBy(key, "column", "n1", "n2").orderBy("ord")
    named = F.element_at(F.create_map(*[F.lit(x) for pair in fields.items() for x in pair]), F.col("column"))
    return rows.select(
        key,
        F.col("n1").alias("ref_pos"),
        F.col("n2").alias("cite_pos"),
        named.alias("field"),
        F.row_number().over(within).alias("item_pos"),
        "val",
    ).distinct()


def _cells(rows: DataFrame, keys: list[Column], columns: list[str]) -> DataFrame:
    """One row of single leaves for each group of level numbers; a leaf that is missing is null."""
    cells = [F.max(F.when(F.col("column") == c, F.col("val"))).alias(c.rpartition(".")[2]) for c in columns]
    return rows.groupBy(*keys).agg(*cells)


def citation_table(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """One row for each citation, linked to its record and reference: ``(key, ref_pos, cite_pos, title, doi, source, year)``."""
    wanted = [f"reference.citation.{c}" for c in ("title", "doi", "source", "year")]
    levels = shred(records, key, payload, CITATIONS).filter(F.col("column").isin(*wanted))
    rows = numbered(levels, key, 2).filter(F.col("def") >= 2)
    return _cells(rows, [F.col(key), F.col("n1").alias("ref_pos"), F.col("n2").alias("cite_pos")], wanted)


def author_table(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """One row for each author of a citation, linked to its record, reference and citation: ``(key, ref_pos, cite_pos, author_pos, name)``.

    ``author_pos`` counts the persons and groups as they stand in the record, a nameless one too, so that it agrees with the levels.
    """
    levels = shred(records, key, payload, CITATIONS).filter(F.col("column") == "reference.citation.author.name")
    rows = numbered(levels, key, 3).filter(F.col("def") >= 3)
    return rows.select(key, F.col("n1").alias("ref_pos"), F.col("n2").alias("cite_pos"), F.col("n3").alias("author_pos"), F.col("val").alias("name"))


# -- The schema of an article's own fields ------------------------------------------------------


def _found(record: object, name: str) -> list:
    """The values of all members of a name, in the order they stand, those in references left out."""
    out: list = []
    stack = [record]
    while stack:
        value = stack.pop()
        if isinstance(value, tuple):
            out += _many(value[0])
        elif isinstance(value, list):
            stack += reversed(value)
        elif isinstance(value, dict):
            stack += [(x,) if k == name else x for k, x in reversed(value.items()) if k != "ref-list"]
    return out


def _article_id(kind: str) -> Callable[[object], str | None]:
    def read(record: object) -> str | None:
        for part in _found(record, "article-id"):
            if str(_get(part, "@pub-id-type") or "").lower() in (kind, f"{kind}id"):
                return _text(part)
        return None

    return read


def _first(name: str) -> Callable[[object], str | None]:
    return lambda record: next((t for t in map(_text, _found(record, name)) if t), None)


ARTICLES = Node(
    "article",
    lambda record: [record],
    {"pmc": _article_id("pmc"), "doi": _article_id("doi"), "title": _first("article-title"), "journal": _first("journal-title")},
)


def article_table(records: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """One row for each record that is valid JSON: ``(key, pmc, doi, title, journal, references)``; the last counts its references."""
    own = shred(records, key, payload, Node("record", lambda r: [r], {}, (ARTICLES, Node("reference", _references, {"id": _attribute("@id")}))))
    columns = [f"record.article.{c}" for c in ("pmc", "doi", "title", "journal")]
    rows = own.dropDuplicates([key, "column", "ord"])
    counted = F.count_if((F.col("column") == "record.reference.id") & (F.col("def") >= 2)).alias("references")
    cells = [F.max(F.when(F.col("column") == c, F.col("val"))).alias(c.rpartition(".")[2]) for c in columns]
    return rows.groupBy(key).agg(*cells, counted)

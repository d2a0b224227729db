"""Reshaping tables: subheadings to a column, rows to texts, names and levels to paths."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inkwell.functions.text import is_blank


def repeat_sub(df: DataFrame, table: str, row: str, columns: list[str], name: str = "subheading", first: bool = True) -> DataFrame:
    """Rows that hold only a subheading become a column of the rows below them.

    ``columns`` are the table's columns in order, ``row`` numbers its rows and
    ``table`` tells tables apart.  A subheading row is blank (null, empty or a
    no-break space) in all columns but the first.  A table of one column,
    without subheading, not beginning with one, or with more than one pair of
    adjacent subheadings stays as it is, with a null in the new column.
    """
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already")
    if len(columns) < 2:
        out = df.withColumn(name, F.lit(None).cast("string"))
    else:
        is_sub = reduce(lambda a, b: a & b, [is_blank(F.col(c).cast("string")) for c in columns[1:]]) & ~is_blank(F.col(columns[0]).cast("string"))
        ordered = Window.partitionBy(table).orderBy(row)
        whole = Window.partitionBy(table)
        marked = (
            df.withColumn("__sub", is_sub)
            .withColumn("__pair", F.col("__sub") & F.coalesce(F.lag("__sub").over(ordered), F.lit(False)))
            .withColumn("__first", F.row_number().over(ordered) == 1)
        )
        applies = (
            F.max(F.col("__first") & F.col("__sub")).over(whole) & (F.sum(F.col("__pair").cast("int")).over(whole) <= 1)
        )
        latest = F.last(F.when(F.col("__sub"), F.col(columns[0]).cast("string")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
        out = (
            marked.withColumn("__applies", applies)
            .withColumn(name, F.when(F.col("__applies"), latest))
            .filter(~(F.col("__applies") & F.col("__sub")))
            .drop("__sub", "__pair", "__first", "__applies")
        )
    if not first:
        return out
    return out.select(name, *[c for c in out.columns if c != name])


def _cell(label: Column, value: Column, na_string: str | None) -> Column:
    absent = is_blank(value) if na_string is None else is_blank(value) | (value == na_string)
    # A single blank that is no no-break space is a value.
    absent = absent & (value.isNull() | (value != " "))
    return F.when(~absent, F.concat(label, F.lit("="), value))


def collapse_rows(df: DataFrame, table: str | Column, row: str | Column, columns: list[str], na_string: str | None = None) -> DataFrame:
    """``(table, row, text)``: each row as ``name=value`` parts, absent values left out; rows of none vanish, ``row`` keeps its number."""
    table = F.col(table) if isinstance(table, str) else table
    row = F.col(row) if isinstance(row, str) else row
    parts = [_cell(F.lit(c), F.col(c).cast("string"), na_string) for c in columns]
    out = df.select(table.alias("table"), row.cast("int").alias("row"), F.concat_ws("; ", *parts).alias("text"))
    return out.filter(F.col("text") != "")


def collapse_grid(df: DataFrame, table: str, header: str, rows: str, na_string: str | None = None) -> DataFrame:
    """As ``collapse_rows`` for tables in long form: a header array and an array of rows."""
    each = df.select(F.col(table).alias("table"), F.col(header).alias("__header"), F.posexplode(rows).alias("__row", "__cells"))
    parts = F.zip_with("__header", "__cells", lambda label, value: _cell(label, value, na_string))
    text = F.array_join(F.filter(parts, lambda p: p.isNotNull()), "; ")
    out = each.select("table", (F.col("__row") + 1).alias("row"), text.alias("text"))
    return out.filter(F.col("text") != "")


def path_rows(df: DataFrame, group: str, order: str, name: str, level: str) -> DataFrame:
    """Add ``path``: the names of the enclosing levels, each reset by a higher one, at any depth.

    A name ``NA`` takes its level but no place in the path.  One fold over the
    ordered rows of a partition, which holds the open levels only, whatever a
    group's size.
    """
    sorted_ = df.repartition(F.col(group)).sortWithinPartitions(group, order)
    schema = StructType([*df.schema.fields, StructField("path", StringType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stack = object(), []
        for batch in batches:
            names, levels, groups = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (name, level, group))
            paths = []
            for g, n, depth in zip(groups, names, levels):
                if g != current:
                    current, stack = g, []
                if depth is not None:  # a row of no level stands under the one before
                    while stack and stack[-1][0] >= depth:
                        stack.pop()
                    stack.append((depth, n))
                paths.append("; ".join(str(x) for _, x in stack if x is not None and x != "NA"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.string())], names=[*batch.schema.names, "path"])

    return sorted_.mapInArrow(fold, schema)


def path_string(df: DataFrame, group: str, order: str, name: str, level: str) -> DataFrame:
    """``(group, path)``: the path of each group's last row."""
    rows = path_rows(df.select(*dict.fromkeys((group, order, name, level))), group, order, name, level)
    return rows.groupBy(group).agg(F.max_by("path", order).alias("path"))

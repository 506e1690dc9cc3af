"""Rows as numbered lines of text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conversions import format_timestamp


def cell(column: Column, field: T.StructField) -> Column:
    """A cell as text: NULL, strings and binaries in quotes, timestamps by declared precision, nested ones by kind."""
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        text = F.concat(F.lit('"'), column.cast("string"), F.lit('"'))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        declared = re.search(r"TIMESTAMP\((\d)\)", field.metadata.get("declared_type", ""))
        text = format_timestamp(column, int(declared[1]) if declared else 6)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        name = {T.ArrayType: "<array>", T.MapType: "<map>", T.StructType: "<row>"}[type(kind)]
        text = F.when(column.isNotNull(), name)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def chosen(df: DataFrame, names: Iterable[str] = ()) -> list[str]:
    """The named columns in the table's order, all if none is named; unknown names are ignored."""
    names = list(names)
    return [c for c in df.columns if not names or c in names]


def rendered(df: DataFrame, names: Iterable[str] = ()) -> DataFrame:
    """(line): each row's cells, joined by a comma and a blank."""
    cells = [cell(F.col(f"`{c}`"), df.schema[c]) for c in chosen(df, names)]
    return df.select(F.concat_ws(", ", *cells).alias("line"))


def lines(df: DataFrame, names: Iterable[str] = (), page: int = 0) -> Iterator[str]:
    """A line of the columns' names, then the rows, numbered from 1; they come to the driver one partition at a time.

    With page the line of names comes again after every so many rows, before the next.
    """
    names = list(names)
    header = ", ".join(chosen(df, names))
    yield header
    for i, row in enumerate(rendered(df, names).toLocalIterator(), 1):
        if page and i > 1 and i % page == 1 % page:
            yield header
        yield f"{i}: {row['line']}"

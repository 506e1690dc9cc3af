"""Delimited text files, typed as a table's columns declare."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conversions import parse_date, parse_timestamp


def _checked(text: Column, value: Column, kind: str) -> Column:
    """The value, or an error if the text has one that can't be read."""
    message = F.concat(F.lit(f"not a {kind}: "), text)
    return F.when(value.isNull() & text.isNotNull(), F.raise_error(message).cast(kind)).otherwise(value)


def typed(text: Column, field: T.StructField) -> Column:
    """The value of a field's text. Blank text, and that of blanks only, is null for every type.

    Booleans are true for 'true' in any case, else false. Numbers, dates and timestamps that can't be read raise an error
    and so stop the load; timestamps must have as many fractional digits as declared, dates may be yyyy-MM-dd or yyyyMMdd.
    """
    kind = field.dataType
    text = F.when(F.length(F.regexp_replace(text, r"\s", "")) > 0, text)
    if isinstance(kind, T.BooleanType):
        return F.lower(text) == "true"
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BinaryType):
        return text.cast("binary")
    if isinstance(kind, T.DateType):
        return _checked(text, parse_date(text), "date")
    if isinstance(kind, T.TimestampNTZType):
        declared = re.search(r"TIMESTAMP\((\d)\)", field.metadata.get("declared_type", ""))
        return _checked(text, parse_timestamp(text, int(declared[1]) if declared else 6), "timestamp_ntz")
    if isinstance(kind, T.NumericType):
        return _checked(text, F.trim(text).try_cast(kind), kind.simpleString())
    raise ValueError(f"{field.name}: {kind.simpleString()} can't be loaded from text")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """The rows of files without header, bound to the schema's fields by place; surplus values are ignored."""
    values = [typed(F.col(f"_{i}"), f).alias(f.name, metadata=f.metadata) for i, f in enumerate(schema)]
    texts = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(schema))])
    raw = spark.read.schema(texts).option("enforceSchema", True).csv(path, sep=delimiter, quote=quote, escape=quote, header=False)
    return raw.select(*values)

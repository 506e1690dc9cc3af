"""Generated rows of any schema, and a small synthetic source."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEMS = 4  # at most so many elements of an array or map


def _random(kind: T.DataType, nullable: bool, share: float, seed: str, declared: str = "") -> Column:
    """A seeded random value; each path of a type has a seed of its own."""
    number = zlib.crc32(seed.encode())
    whole = lambda bits: F.floor(F.rand(number) * 2**bits).cast("long") - 2 ** (bits - 1)
    if isinstance(kind, T.BooleanType):
        value = F.rand(number) < 0.5
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 52}[type(kind)]
        value = whole(bits).cast(kind)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.randn(number).cast(kind)
    elif isinstance(kind, T.DecimalType):
        digits = min(kind.precision, 15)
        value = (F.floor(F.rand(number) * 10**digits).cast("decimal(38,0)") / F.lit(10**kind.scale).cast("decimal(38,0)")).cast(kind) if kind.scale <= digits else F.lit(0).cast(kind)
    elif isinstance(kind, T.DateType):
        value = F.date_from_unix_date(F.floor(F.rand(number) * 20_000).cast("int"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.timestamp_micros(F.floor(F.rand(number) * 1.7e15).cast("long")).cast(kind)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        digits = "".join(c for c in declared.partition("(")[2] if c.isdigit())
        value = F.substring(F.sha2(F.rand(number).cast("string").cast("binary"), 256), 1, min(int(digits or 16), 64)).cast(kind)
    elif isinstance(kind, T.ArrayType):
        items = [_random(kind.elementType, kind.containsNull, share, f"{seed}.{i}") for i in range(ITEMS)]
        value = F.slice(F.array(*items), F.lit(1), F.floor(F.rand(number) * (ITEMS + 1)).cast("int"))
    elif isinstance(kind, T.MapType):
        keys = F.array_distinct(F.array(*(_random(kind.keyType, False, share, f"{seed}.k{i}") for i in range(ITEMS))))
        values = F.array(*(_random(kind.valueType, kind.valueContainsNull, share, f"{seed}.v{i}") for i in range(ITEMS)))
        value = F.map_from_arrays(keys, F.slice(values, F.lit(1), F.size(keys)))
    else:
        value = F.struct(*(_random(f.dataType, f.nullable, share, f"{seed}.{f.name}").alias(f.name) for f in kind))
    return F.when(F.rand(zlib.crc32(f"{seed}?".encode())) >= share, value) if nullable and share > 0 else value


def populate(spark: SparkSession, schema: T.StructType, rows: int = 16, nullable_rate: float = 0.1, seed: int = 0) -> DataFrame:
    """Random rows of the schema; nulls at the given rate, in nullable places only. The same seed gives the same rows."""
    columns = [
        _random(f.dataType, f.nullable, nullable_rate, f"{seed}/{f.name}", f.metadata.get("declared_type", "")).alias(f.name, metadata=f.metadata)
        for f in schema
    ]
    return spark.range(rows).select(*columns)


def synthetic(spark: SparkSession, batches: int, rows: int) -> DataFrame:
    """(batch, ints, strs): `batches` batches of `rows` rows, numbered through."""
    return spark.range(batches * rows).select(
        F.floor(F.col("id") / rows).alias("batch"), F.col("id").cast("int").alias("ints"), F.concat(F.lit("row-"), F.col("id")).alias("strs")
    )

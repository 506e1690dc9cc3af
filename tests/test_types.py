import datetime as dt
from decimal import Decimal

import pytest
from lakeread.functions import conversions as conv
from lakeread.functions.types import parse_ddl, parse_physical, physical_of
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.mark.parametrize(
    "text, shown",
    [
        ("BOOLEAN", "BOOLEAN NOT NULL"), ("NULLABLE (\n TinyInt )", "TINYINT"), (" DECIMAL(10, 2) ", "DECIMAL(10, 2) NOT NULL"), ("TIMESTAMP", "TIMESTAMP(6) NOT NULL"),
        ("timestamp(3)", "TIMESTAMP(3) NOT NULL"), ("time", "TIME(0) NOT NULL"), ("localZonedTimestamp(3)", "TIMESTAMP(3) WITH LOCAL TIME ZONE NOT NULL"),
        ("nullable(CHAR( 10))", "CHAR(10)"), ("VARBINARY(256)", "VARBINARY(256) NOT NULL"),
        ("nullable(array<nullable(decimal(32,8))>)", "ARRAY<DECIMAL(32, 8)>"), ("map<varchar(50), int>", "MAP<VARCHAR(50) NOT NULL, INT NOT NULL> NOT NULL"),
        ("Row<Field_A | nullable(Int), b|array<row<c|date>>>", "ROW<`field_a` INT, `b` ARRAY<ROW<`c` DATE NOT NULL> NOT NULL> NOT NULL> NOT NULL"),
        ("map<int, array<map<varchar(100), row<a|boolean, t|timestamp>>>>", "MAP<INT NOT NULL, ARRAY<MAP<VARCHAR(100) NOT NULL, ROW<`a` BOOLEAN NOT NULL, `t` TIMESTAMP(6) NOT NULL> NOT NULL> NOT NULL> NOT NULL> NOT NULL"),
    ],
)
def test_declared_types_are_shown(text, shown):
    assert str(parse_ddl(text)) == shown


@pytest.mark.parametrize("text", ["", "decimal", "decimal(10)", "decimal(39,2)", "decimal(3,5)", "char", "varchar(0)", "timestamp(9)", "array<int,int>", "map<int>", "row<a>", "multiset<int>", "array<int", "string"])
def test_other_types_are_refused(text):
    with pytest.raises(ValueError):
        parse_ddl(text)


def test_spark_types_keep_nullability_and_what_was_declared():
    field = parse_ddl("nullable(array<nullable(varchar(5))>)").field("x")
    assert field == T.StructField("x", T.ArrayType(T.StringType(), True), True, {"declared_type": "ARRAY<VARCHAR(5)>"})
    assert parse_ddl("map<int,row<a|nullable(bigint)>>").spark() == T.MapType(T.IntegerType(), T.StructType([T.StructField("a", T.LongType(), True)]), False)
    assert parse_ddl("timestamp").spark() == T.TimestampNTZType() and parse_ddl("localzonedtimestamp").spark() == T.TimestampType()


@pytest.mark.parametrize("text", ["boolean", "tinyint", "short", "int", "bigint", "float", "double", "string", "binary", "date", "decimal(9,3)", "array<map<string,struct<a:int,b:array<short>>>>"])
def test_physical_strings_round_trip(text):
    assert physical_of(parse_physical(text)) == text


def test_physical_strings():
    assert parse_physical("varchar(9)") == parse_physical("char(1)") == T.StringType()
    assert parse_physical("byte") == T.ByteType() and parse_physical("timestamp-millis") == T.TimestampType()
    for text in ("decimal", "varchar", "array<>", "map<int>", "struct<a>", "unknown"):
        with pytest.raises(ValueError):
            parse_physical(text)


def test_conversions(spark):
    at = dt.datetime(1969, 12, 31, 23, 59, 59, 999_999)
    df = spark.createDataFrame([(at, dt.date(1969, 12, 31), Decimal("1.50")), (None, None, None)], "t timestamp_ntz, d date, x decimal(5,2)")
    row, null = df.select(
        *(conv.to_epoch(F.col("t"), u).alias(u) for u in conv.UNITS), *(conv.from_epoch(conv.to_epoch(F.col("t"), u), u).alias(f"from_{u}") for u in conv.UNITS),
        conv.to_epoch_day(F.col("d")).alias("day"), conv.from_epoch_day(conv.to_epoch_day(F.col("d"))).alias("date"), conv.rescale(F.col("x"), 4, 1).alias("x"),
    ).collect()
    assert (row["s"], row["ms"], row["us"], row["ns"], row["day"]) == (-1, -1, -1, -1000, -1)
    assert row["from_us"] == row["from_ns"] == at and row["from_s"] == dt.datetime(1969, 12, 31, 23, 59, 59)
    assert row["date"] == dt.date(1969, 12, 31) and row["x"] == Decimal("1.5")
    assert all(v is None for v in null)


@pytest.mark.parametrize("value, precision, scale", [("1.55", 4, 1), ("999.00", 3, 1)])
def test_a_decimal_that_would_be_rounded_is_an_error(spark, value, precision, scale):
    df = spark.createDataFrame([(Decimal(value),)], "x decimal(5,2)")
    with pytest.raises(Exception, match="rounding needed"):
        df.select(conv.rescale(F.col("x"), precision, scale)).collect()


def test_texts_of_dates_and_timestamps(spark):
    texts = ["2024-02-29", "20240229", "2024-2-9", "2024-02-30", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert [r[0] for r in df.select(conv.parse_date(F.col("x"))).collect()] == [dt.date(2024, 2, 29)] * 2 + [None] * 3
    texts = ["2024-02-29 01:02:03.123", "2024-02-29 01:02:03", "2024-02-29 01:02:03.1234", "2024-02-29T01:02:03.123"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert [r[0] for r in df.select(conv.parse_timestamp(F.col("x"), 3)).collect()] == [dt.datetime(2024, 2, 29, 1, 2, 3, 123_000), None, None, None]
    assert df.select(conv.format_timestamp(F.lit(dt.datetime(2024, 2, 29, 1, 2, 3, 4000)), 2)).first()[0] == "2024-02-29 01:02:03.00"

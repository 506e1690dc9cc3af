"""The prefix-notation filters: each held against a SQL condition over the same rows."""

import datetime as dt
from decimal import Decimal
from fractions import Fraction

import pytest
from lakeread.functions.types import parse_ddl
from lakeread.operators.predicate import Untranslatable, parse
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        parse_ddl(f"nullable({t})").field(n)
        for n, t in {
            "col_boolean": "boolean", "col_tinyint": "tinyint", "col_int": "int", "col_bigint": "bigint", "col_float": "float", "col_double": "double",
            "col_decimal": "decimal(10,2)", "col_date": "date", "col_timestamp": "timestamp(6)", "col_seconds": "timestamp(0)", "col_varchar": "varchar(50)",
            "col_binary": "varbinary(9)",
        }.items()
    ]
)
INF = float("inf")
ROWS = [
    (True, 1, 1, 100, 1.5, 10.2, Decimal("10.00"), dt.date(2024, 1, 1), dt.datetime(2024, 10, 12, 17, 22, 27, 255000), dt.datetime(2024, 1, 1), "hello world", b"x"),
    (False, 2, 10, 8, INF, -INF, Decimal("100.51"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 3), "value1", b"y"),
    (None, None, None, None, None, None, None, None, None, None, None, None),
    (True, 3, -2118616973, 9, 0.0, 1e300, Decimal("300.00"), dt.date(2023, 1, 1), dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1), "a,b)(c'd", b"z"),
    (False, -5, 3, 0, -1.0, 0.0, Decimal("-0.01"), dt.date(1969, 12, 31), dt.datetime(1960, 1, 1), dt.datetime(1960, 1, 1), "1_U%x", b""),
]


def call(name, *args):
    return f"@function({name},{len(args)})" + "".join(args)


def col(name):
    return f"@identifier({name})"


def lit(text):
    return f"@literal({text})"


CASES = [
    (call("equals", col("col_int"), lit("Int64_-2118616973")), "col_int = -2118616973"),
    (call("notEquals", col("col_varchar"), lit("'value1'")), "col_varchar <> 'value1'"),
    (call("less", col("col_decimal"), lit("Decimal32_'10.00'")), "col_decimal < 10"),
    (call("lessOrEquals", col("col_decimal"), lit("Float64_10.2")), "col_decimal <= 10.2"),
    (call("greater", col("col_int"), lit("UInt64_3")), "col_int > 3"),
    (call("greaterOrEquals", col("col_int"), lit("UInt64_3")), "col_int >= 3"),
    (call("equals", col("col_boolean"), lit("UInt64_1")), "col_boolean"),
    (call("equals", col("col_tinyint"), lit("Int64_-5")), "col_tinyint = -5"),
    (call("equals", col("col_float"), lit("+Inf")), "col_float = float('inf')"),
    (call("equals", col("col_double"), lit("-Inf")), "col_double = double('-inf')"),
    (call("equals", col("col_int"), lit("NULL")), "false"),
    (call("equals", col("col_binary"), lit("'y'")), "col_binary = X'79'"),
    (call("in", col("col_int"), call("tuple", lit("Int64_1"), lit("Int64_3"))), "col_int in (1, 3)"),
    (call("notIn", col("col_int"), call("tuple", lit("Int64_1"), lit("Int64_3"))), "col_int not in (1, 3)"),
    (call("in", col("col_date"), call("tuple", call("cast", lit("Int64_19723"), lit("'Date'")), lit("'20230101'"))), "col_date in (date'2024-01-01', date'2023-01-01')"),
    (call("isNull", col("col_int")), "col_int is null"),
    (call("isNotNull", col("col_int")), "col_int is not null"),
    (call("and", call("greater", col("col_int"), lit("UInt64_1")), call("less", col("col_int"), lit("UInt64_100"))), "col_int > 1 and col_int < 100"),
    (
        call("or", call("and", call("greaterOrEquals", col("col_int"), lit("Int64_-15")), call("less", col("col_bigint"), lit("Int64_9"))), call("equals", col("col_int"), lit("Int64_1"))),
        "(col_int >= -15 and col_bigint < 9) or col_int = 1",
    ),
    (call("or", *(call("equals", col("col_int"), lit(f"UInt64_{i}")) for i in (1, 3, 10))), "col_int in (1, 3, 10)"),
    (call("greater", col("col_date"), call("cast", lit("Int64_19357"), lit("'Date32'"))), "col_date > date'2022-12-31'"),
    (call("less", col("col_timestamp"), call("cast", lit("Decimal64_'1728753747.255000'"), lit("'DateTime64(6)'"))), "col_timestamp < timestamp_ntz'2024-10-12 17:22:27.255'"),
    (call("lessOrEquals", col("col_timestamp"), call("cast", lit("UInt64_1728753747255"), lit("'DateTime64'"))), "col_timestamp <= timestamp_ntz'2024-10-12 17:22:27.255'"),
    (call("equals", col("col_seconds"), call("cast", lit("UInt64_1704164400"), lit("'DateTime'"))), "col_seconds = timestamp_ntz'2024-01-02 03:00:00'"),
    (call("greaterOrEquals", col("col_timestamp"), lit("'2024-01-02 00:00:00.000000'")), "col_timestamp >= timestamp_ntz'2024-01-02'"),
    (call("equals", col("col_seconds"), lit("'2024-01-01 00:00:00'")), "col_seconds = timestamp_ntz'2024-01-01'"),
    (call("like", col("col_varchar"), lit("'hello%'")), "col_varchar like 'hello%'"),
    (call("equals", col("col_varchar"), lit(r"'a,b)(c\'d'")), "col_varchar = \"a,b)(c'd\""),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def kept(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("text, sql", CASES)
def test_filters_keep_what_sql_keeps(rows, text, sql):
    found = parse(text, SCHEMA, strict=True)
    assert kept(rows.where(found.condition)) == kept(rows.where(sql)) and not found.dropped


OPS = {"equals": "__eq__", "notEquals": "__ne__", "less": "__lt__", "lessOrEquals": "__le__", "greater": "__gt__", "greaterOrEquals": "__ge__"}
EXACT = {
    "tinyint": [None, -128, -1, 0, 1, 2, 3, 127], "smallint": [None, -32768, 2, 3, 32767], "int": [None, -(2**31), 0, 2, 3, 2**31 - 1],
    "bigint": [None, -(2**63), 2, 3, 2**53 + 1, 2**63 - 1], "decimal(5,2)": [None, Decimal("-999.99"), Decimal("1.25"), Decimal("2.50"), Decimal("999.99")],
    "decimal(38,10)": [None, Decimal("2.5"), Decimal("9" * 28 + ".9999999999")],
}
LITERALS = {
    "Float64_2.5": 2.5, "Float64_2": 2, "Float64_-0.5": -0.5, "Float64_1e300": 1e300, "Int64_9999999999": 9999999999, "UInt64_127": 127, "Int64_-128": -128,
    "UInt256_" + "9" * 60: int("9" * 60), "+Inf": INF, "-Inf": -INF, "Decimal64_'2.5'": Decimal("2.5"), "Decimal64_'1.254'": Decimal("1.254"), "Decimal32_'-999.991'": Decimal("-999.991"),
    "UInt64_9007199254740993": 2**53 + 1, "Decimal128_'1000'": 1000,
}


@pytest.mark.parametrize("declared", EXACT)
def test_numbers_are_compared_by_value(spark, declared):
    """Every comparison of every literal, over each exact type, against Python's exact numbers."""
    values = EXACT[declared]
    schema = T.StructType([parse_ddl(f"nullable({declared})").field("x")])
    rows = spark.createDataFrame([(v,) for v in values], schema)
    names, conditions, want = [], [], []
    for text, number in LITERALS.items():
        for op, method in OPS.items():
            names.append((op, text))
            conditions.append(parse(call(op, col("x"), lit(text)), schema, strict=True).condition)
            want.append([v for v in values if v is not None and getattr(Fraction(v), method)(number if isinstance(number, float) else Fraction(number))])
        for op, keep in (("in", True), ("notIn", False)):
            names.append((op, text))
            conditions.append(parse(call(op, col("x"), call("tuple", lit(text), lit("Int64_3"))), schema, strict=True).condition)
            want.append([v for v in values if v is not None and (v in (number, 3)) == keep])
    got = rows.select("x", *(F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(conditions))).collect()
    for i, name in enumerate(names):
        assert [r["x"] for r in got if r[f"c{i}"]] == want[i], name


def test_numbers_out_of_range_still_reach_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    for op, text, pushed in (("less", "Float64_2.5", "LessThanOrEqual(p_size,2)"), ("greater", "Decimal64_'49.5'", "GreaterThanOrEqual(p_size,50)"), ("notEquals", "Int64_9999999999", "IsNotNull(p_size)")):
        found = parse(call(op, col("p_size"), lit(text)), table.schema, strict=True)
        assert pushed in table.where(found.condition)._jdf.queryExecution().executedPlan().toString()


LIKE = call("like", col("col_varchar"), lit("'%he%'"))
TEN, WORLD = call("equals", col("col_int"), lit("Int64_10")), call("notEquals", col("col_varchar"), lit("'world'"))


@pytest.mark.parametrize(
    "text, sql, dropped",
    [
        (call("and", WORLD, LIKE), "col_varchar <> 'world'", 1),
        (call("and", TEN, WORLD, LIKE), "col_int = 10 and col_varchar <> 'world'", 1),
        (call("and", LIKE, TEN, WORLD), "col_int = 10 and col_varchar <> 'world'", 1),
        (call("and", TEN, call("and", LIKE, TEN, WORLD)), "col_int = 10", 1),
        (call("and", call("and", LIKE, TEN, WORLD), TEN), "col_int = 10", 1),
        (call("and", LIKE, LIKE), None, 2),
        (call("or", TEN, LIKE), None, 1),
        (LIKE, None, 1),
    ],
)
def test_only_the_outermost_and_is_lenient(rows, text, sql, dropped):
    found = parse(text, SCHEMA)
    assert len(found.dropped) == dropped
    assert found.condition is None if sql is None else kept(rows.where(found.condition)) == kept(rows.where(sql))
    with pytest.raises(Untranslatable):
        parse(text, SCHEMA, strict=True)


@pytest.mark.parametrize(
    "text",
    [
        call("equals", col("col_int"), col("col_bigint")), call("in", col("col_int"), lit("Int64_1")), call("equals", lit("Int64_1"), col("col_int")),
        call("equals", col("nowhere"), lit("Int64_1")), call("not", TEN), call("like", col("col_varchar"), lit("'a_c%'")),
        call("like", col("col_varchar"), lit("'a%b%'")), call("like", col("col_varchar"), lit("'%hello'")), call("like", col("col_int"), lit("'1%'")),
        call("equals", col("col_date"), lit("'01.02.2024'")), call("equals", col("col_timestamp"), lit("'2024-01-01 00:00:00'")),
        call("equals", col("col_int"), lit("'1'")), call("equals", col("col_int"), lit("Int64_x")), call("cast", lit("1"), lit("'Date'")),
        call("equals", col("col_int"), lit("Float64_abc")), call("equals", col("col_int"), lit("Decimal64_'1.2.3'")), call("equals", col("col_date"), lit("Int64_5")),
        call("equals", col("col_date"), lit("'2024-02-31'")), call("equals", col("col_seconds"), lit("'2024-01-01 25:00:00'")),
        call("equals", col("col_date"), call("cast", lit("Decimal64_'1.5'"), lit("'Date'"))), call("equals", col("col_date"), call("cast", lit("Int64_99999999999"), lit("'Date32'"))),
        call("less", col("col_timestamp"), call("cast", lit("UInt64_999999999999999999"), lit("'DateTime'"))), call("equals", col("col_boolean"), lit("Float64_1")),
        call("equals", col("col_date"), call("cast", lit("Int64_1"), lit("'Decimal'"))), "@function(and,2)" + TEN, TEN + TEN, "", "col_int = 1", "@function(equals)",
    ],
)
def test_what_has_no_meaning_gives_no_filter(text):
    assert parse(text, SCHEMA).condition is None
    with pytest.raises(Untranslatable):
        parse(text, SCHEMA, strict=True)


def test_filters_are_pushed_to_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    table = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    found = parse(call("and", call("greater", col("l_orderkey"), lit("Int64_5")), call("like", col("l_returnflag"), lit("'R%'"))), table.schema)
    plan = table.where(found.condition).select("l_tax")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_orderkey,5)" in plan and "StringStartsWith(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double,l_returnflag:string>" in plan

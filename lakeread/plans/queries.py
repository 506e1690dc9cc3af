"""One query for each operator, over the test tables, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import conversions as conv
from ..functions.types import parse_ddl, parse_physical, physical_of
from ..operators import batches, merge, show
from ..operators.predicate import parse
from ..operators.select import select
from ..sources import populate as generators
from ..sources import scan, slices
from ..sources.catalog import Catalog, TableSchema, schema_rows
from ..sources.load import read_csv
from ..workspace import new_path
from . import workload

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return scan.read(spark, f"{sf}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query by its function's name."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# Filters: name -> (table, columns, filter in prefix notation, WHERE in SQL).


def _cmp(name: str, column: str, literal: str) -> str:
    return f"@function({name},2)@identifier({column})@literal({literal})"


_AND_OR = (
    "@function({op},3)" + _cmp("equals", "l_returnflag", "'R'") + _cmp("less", "l_quantity", "Float64_10") + _cmp("greaterOrEquals", "l_discount", "Float64_0.05")
)
_LINE = ("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
_ORDER = ("o_orderkey", "o_totalprice", "o_orderpriority")
PREDICATES: dict[str, tuple[str, tuple[str, ...], str, str]] = {
    "pred_equals": ("lineitem", _LINE, _cmp("equals", "l_linenumber", "UInt64_3"), "l_linenumber = 3"),
    "pred_not_equals": ("orders", _ORDER, _cmp("notEquals", "o_orderpriority", "'1-URGENT'"), "o_orderpriority <> '1-URGENT'"),
    "pred_less": ("lineitem", _LINE, _cmp("less", "l_shipdate", "'1996-06-01 00:00:00.000000'"), "l_shipdate < TIMESTAMP '1996-06-01'"),
    "pred_less_or_equals": ("lineitem", _LINE, _cmp("lessOrEquals", "l_quantity", "Float64_12"), "l_quantity <= 12"),
    "pred_greater": ("orders", _ORDER, _cmp("greater", "o_totalprice", "Decimal64_'250000.50'"), "o_totalprice > 250000.50"),
    "pred_greater_or_equals": ("lineitem", _LINE, _cmp("greaterOrEquals", "l_quantity", "Int64_49"), "l_quantity >= 49"),
    "pred_in": (
        "part", ("p_partkey", "p_size", "p_brand"),
        "@function(in,2)@identifier(p_size)@function(tuple,3)@literal(Int64_1)@literal(Int64_7)@literal(Int64_49)", "p_size IN (1, 7, 49)",
    ),
    "pred_not_in": (
        "events", ("event_id", "event_type", "value"),
        "@function(notIn,2)@identifier(event_type)@function(tuple,2)@literal('click')@literal('error')", "event_type NOT IN ('click', 'error')",
    ),
    "pred_like_prefix": ("part", ("p_partkey", "p_name", "p_type"), _cmp("like", "p_brand", "'Brand#1%'"), "starts_with(p_brand, 'Brand#1')"),
    "pred_and": ("lineitem", _LINE, _AND_OR.format(op="and"), "l_returnflag = 'R' AND l_quantity < 10 AND l_discount >= 0.05"),
    "pred_or": ("lineitem", _LINE, _AND_OR.format(op="or"), "l_returnflag = 'R' OR l_quantity < 10 OR l_discount >= 0.05"),
    "pred_and_failover": (
        "part", ("p_partkey", "p_name"),
        "@function(and,3)" + _cmp("like", "p_name", "'%a%'") + _cmp("greater", "p_size", "Int64_25") + _cmp("notEquals", "p_brand", "'Brand#11'"),
        "p_size > 25 AND p_brand <> 'Brand#11'",
    ),
    "pred_parse_failure_fallback": ("part", ("p_partkey",), "@function(or,2)" + _cmp("like", "p_name", "'%a%'") + _cmp("equals", "p_size", "Int64_1"), "true"),
    "pred_complex": (
        "lineitem", _LINE,
        "@function(and,3)@function(or,2)" + _cmp("equals", "l_linestatus", "'F'") + _cmp("greaterOrEquals", "l_shipdate", "'1997-01-01 00:00:00.000000'")
        + "@function(in,2)@identifier(l_returnflag)@function(tuple,2)@literal('A')@literal('N')" + _cmp("lessOrEquals", "l_tax", "Decimal32_'0.03'"),
        "(l_linestatus = 'F' OR l_shipdate >= TIMESTAMP '1997-01-01') AND l_returnflag IN ('A', 'N') AND l_tax <= 0.03",
    ),
    "pred_cast_datetime64": (
        "events", ("event_id", "ts"),
        "@function(and,2)@function(greaterOrEquals,2)@identifier(ts)@function(cast,2)@literal(Decimal64_'1704412800.000000')@literal('DateTime64(6)')"
        "@function(less,2)@identifier(ts)@function(cast,2)@literal(UInt64_1705276800000)@literal('DateTime64(3)')",
        "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-15'",
    ),
    "pred_fractional_on_int": (
        "part", ("p_partkey", "p_size"),
        "@function(or,4)@function(and,2)" + _cmp("greater", "p_size", "Float64_2.5") + _cmp("less", "p_size", "Decimal64_'4.5'")
        + "@function(and,2)" + _cmp("greaterOrEquals", "p_size", "Float64_9.5") + _cmp("lessOrEquals", "p_size", "Float64_12.5")
        + _cmp("equals", "p_size", "Float64_2.5")
        + "@function(and,2)@function(in,2)@identifier(p_size)@function(tuple,3)@literal(Float64_20.5)@literal(Float64_21)@literal(Int64_22)" + _cmp("notEquals", "p_size", "Float64_0.5"),
        "(p_size > 2.5 AND p_size < 4.5) OR (p_size >= 9.5 AND p_size <= 12.5) OR p_size = 2.5 OR (p_size IN (20.5, 21, 22) AND p_size <> 0.5)",
    ),
    "pred_out_of_range": (
        "part", ("p_partkey", "p_size"),
        "@function(and,4)" + _cmp("less", "p_size", "Int64_9999999999") + _cmp("greater", "p_size", "-Inf") + _cmp("notEquals", "p_size", "UInt128_99999999999999999999")
        + "@function(or,3)" + _cmp("equals", "p_size", "Int64_-3000000000") + _cmp("greaterOrEquals", "p_size", "+Inf")
        + "@function(notIn,2)@identifier(p_size)@function(tuple,2)@literal(Int64_9999999999)@literal(Int64_7)",
        "p_size < 9999999999 AND p_size <> 99999999999999999999 AND (p_size = -3000000000 OR p_size NOT IN (9999999999, 7))",
    ),
    "pred_literal_types": (
        "orders", _ORDER,
        "@function(or,4)" + _cmp("equals", "o_orderkey", "UInt128_77") + _cmp("less", "o_totalprice", "-Inf")
        + _cmp("equals", "o_orderpriority", "UUID_00000000-0000-0000-0000-000000000000") + _cmp("greater", "o_totalprice", "Decimal128_'300000'"),
        "o_orderkey = 77 OR o_totalprice > 300000",
    ),
}


def _filtered(table: str, columns: tuple[str, ...], text: str) -> Query:
    return lambda spark, sf: scan.Scan(_t(spark, sf, table), list(columns), filter=text).df()


for _name, (_table, _columns, _text, _where) in PREDICATES.items():
    QUERIES[_name] = _filtered(_table, _columns, _text)
    ORACLE_SQL[_name] = f"SELECT {', '.join(_columns)} FROM {_table} WHERE {_where}"


@query("SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL")
def pred_is_null(spark: SparkSession, sf: str) -> DataFrame:
    joined = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id", "left")
    return scan.Scan(joined, ["doc_id", "lang"], filter="@function(isNull,1)@identifier(quality)").df()


@query("SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def pred_is_not_null(spark: SparkSession, sf: str) -> DataFrame:
    joined = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id", "left")
    return scan.Scan(joined, ["doc_id", "lang", "quality"], filter="@function(isNotNull,1)@identifier(quality)").df()


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE > DATE '1995-03-15'")
def pred_cast_date(spark: SparkSession, sf: str) -> DataFrame:
    return scan.Scan(_dated(spark, sf), filter="@function(greater,2)@identifier(day)@function(cast,2)@literal(Int64_9204)@literal('Date32')").df()


@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def pred_string_to_date(spark: SparkSession, sf: str) -> DataFrame:
    return scan.Scan(_dated(spark, sf), filter="@function(and,2)" + _cmp("greaterOrEquals", "day", "'1996-01-01'") + _cmp("lessOrEquals", "day", "'19961231'")).df()


@query("""
    SELECT l_orderkey, l_linenumber, l_tax::DECIMAL(5, 2)::VARCHAR AS tax FROM lineitem WHERE l_tax::DECIMAL(5, 2) > 0.0254
      AND l_tax::DECIMAL(5, 2) <= 0.0699 AND l_tax::DECIMAL(5, 2) <> 0.041 OR l_tax::DECIMAL(5, 2) IN (0.01, 0.001) OR l_tax::DECIMAL(5, 2) > 1000.5""")
def pred_decimal_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Literals with more decimal places, and of greater numbers, than the column's type holds."""
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").cast("decimal(5,2)").alias("tax"))
    text = (
        "@function(or,3)@function(and,3)" + _cmp("greater", "tax", "Decimal64_'0.0254'") + _cmp("lessOrEquals", "tax", "Decimal64_'0.0699'") + _cmp("notEquals", "tax", "Float64_0.041")
        + "@function(in,2)@identifier(tax)@function(tuple,2)@literal(Decimal32_'0.01')@literal(Decimal32_'0.001')" + _cmp("greater", "tax", "Decimal128_'1000.5'")
    )
    return scan.Scan(rows, filter=text, complete=True).df().withColumn("tax", F.col("tax").cast("string"))


# Scans and projections.

FLAGSHIP = (
    "@function(and,2)" + _cmp("less", "l_shipdate", "'1998-01-01 00:00:00.000000'") + _cmp("greaterOrEquals", "l_quantity", "Float64_5")
)


@query("SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_quantity >= 5")
def scan_project_filter(spark: SparkSession, sf: str) -> DataFrame:
    return scan.Scan(_t(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"], filter=FLAGSHIP, complete=True).df()


@query("SELECT * FROM orders")
def scan_full(spark: SparkSession, sf: str) -> DataFrame:
    return scan.Scan(_t(spark, sf, "orders")).df()


@query("SELECT count(*) AS rows FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_quantity >= 5")
def scan_plan_files(spark: SparkSession, sf: str) -> DataFrame:
    return scan.Scan(_t(spark, sf, "lineitem"), filter=FLAGSHIP).files(matching=True).agg(F.sum("rows").alias("rows"))


@query("SELECT 'parquet' AS format, count(*) AS rows, true AS whole FROM lineitem")
def scan_raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """What the descriptors of all file parts say together: their rows, and that the parts of each file are all of it."""
    told = F.from_json("descriptor", "path string, size long, offset long, length long, format string, rows long")
    parts = scan.Scan(_t(spark, sf, "lineitem")).raw_files().select(told.alias("d")).select("d.*")
    files = parts.groupBy("path", "size", "format").agg(F.sum("rows").alias("rows"), (F.sum("length") <= F.col("size")).alias("whole"))
    return files.groupBy("format").agg(F.sum("rows").alias("rows"), F.bool_and("whole").alias("whole"))


_SPLITS = [
    (1, True, True, 0, [("s3://b/a.parquet", "parquet"), ("HDFS://n/b.orc", "orc")]),
    (2, True, True, 1, [("s3://b/a.parquet", "parquet")]),
    (3, True, False, 0, [("s3://b/a.parquet", "parquet")]),
    (4, False, True, 0, [("s3://b/a.parquet", "parquet")]),
    (5, True, True, None, [("/local/a.parquet", "parquet")]),
    (6, True, True, None, [("oss://b/a.avro", "avro")]),
    (7, True, True, 0, []),
    (8, True, True, None, [("tos://b/a.orc", "orc")]),
]


@query("SELECT * FROM (VALUES (1, true), (2, false), (3, false), (4, false), (5, false), (6, false), (7, true), (8, true)) AS t(split, native)")
def split_classify(spark: SparkSession, sf: str) -> DataFrame:
    kind = "split int, is_data boolean, raw_convertible boolean, deletion_files int, files array<struct<path:string,format:string>>"
    splits = spark.createDataFrame(_SPLITS, kind)
    return splits.select("split", scan.native(splits).alias("native"))


@query("SELECT l_shipdate, l_orderkey, l_returnflag FROM lineitem")
def proj_columns(spark: SparkSession, sf: str) -> DataFrame:
    return select(_t(spark, sf, "lineitem"), ["l_shipdate", "l_orderkey", "l_returnflag"])


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a struct, and a map of the properties and the type."""
    events = _t(spark, sf, "events")
    k = F.from_json("props", "k int")["k"]
    return events.select(
        "event_id", F.struct("user_id", F.struct("event_type", "value", k.alias("k")).alias("what"), "ts").alias("e"),
        F.create_map(F.lit("k"), k, F.concat(F.lit("u"), F.col("user_id")), (F.col("user_id") % 7).cast("int")).alias("m"),
    )


@query("""SELECT event_id, value, (props::JSON->>'k')::INT AS k, ts FROM events""")
def proj_nested_struct(spark: SparkSession, sf: str) -> DataFrame:
    """A subset of nested fields that does not begin with the first."""
    found = select(_nested(spark, sf), ["event_id", "e"], "e.what.value,e.what.k,e.ts")
    return found.select("event_id", "e.what.value", "e.what.k", "e.ts")


@query("SELECT event_id, unnest(['k', 'u' || user_id]) AS key FROM events")
def proj_map_keys(spark: SparkSession, sf: str) -> DataFrame:
    return select(_nested(spark, sf), ["event_id", "m"], "m.$0").select("event_id", F.explode("m").alias("key"))


@query("SELECT event_id, unnest([(props::JSON->>'k')::INT, (user_id % 7)::INT]) AS value FROM events")
def proj_map_values(spark: SparkSession, sf: str) -> DataFrame:
    return select(_nested(spark, sf), ["event_id", "m"], "m.$1").select("event_id", F.explode("m").alias("value"))


@query("""
    SELECT vec_id, len(embedding)::BIGINT AS size, round(embedding[1]::DOUBLE, 5) AS first, round(list_max(embedding)::DOUBLE, 5) AS most FROM embeddings""")
def unpack_nested(spark: SparkSession, sf: str) -> DataFrame:
    values = _t(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "x"))
    return values.groupBy("vec_id").agg(
        F.count("*").alias("size"), F.round(F.max(F.when(F.col("at") == 0, F.col("x").cast("double"))), 5).alias("first"),
        F.round(F.max(F.col("x").cast("double")), 5).alias("most"),
    )


# Merge on read: the table is the users' latest event; earlier ones are base rows, later ones changes, errors delete.

_CUT = "TIMESTAMP '2024-01-15'"


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    early = F.col("ts") < F.expr("timestamp_ntz'2024-01-15'")
    return events.where(early), events.where(~early)


_LATEST = """
    SELECT user_id, event_id, ts, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE {where})
    WHERE n = 1 AND {alive}"""


@query(_LATEST.format(where="true", alive="event_type <> 'error'"))
def mor_read_merged(spark: SparkSession, sf: str) -> DataFrame:
    base, changes = _versions(spark, sf)
    first = merge.latest_by_key(base, ["user_id"], ["ts", "event_id"])
    return merge.merge_on_read(first, changes, ["user_id"], "ts", ["event_id"], F.col("event_type") == "error")


@query(_LATEST.format(where=f"ts >= {_CUT}", alive="event_type <> 'error'"))
def mor_log_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_on_read(None, _versions(spark, sf)[1], ["user_id"], "ts", ["event_id"], F.col("event_type") == "error")


@query(_LATEST.format(where=f"ts < {_CUT}", alive="true"))
def mor_read_optimized(spark: SparkSession, sf: str) -> DataFrame:
    return merge.latest_by_key(_versions(spark, sf)[0], ["user_id"], ["ts", "event_id"])


_COMMITS = [("003", "completed"), ("001", "completed"), ("004", "inflight"), ("002", "completed")]


@query("SELECT '003' AS instant")
def mor_snapshot_instant(spark: SparkSession, sf: str) -> DataFrame:
    return merge.snapshot_instant(spark.createDataFrame(_COMMITS, "instant string, state string"))


@query("""
    WITH f AS (
      SELECT (user_id % 8) AS p, user_id AS g, lpad(((epoch_us(ts) // 86400000000) % 30)::VARCHAR, 3, '0') AS instant,
        CASE WHEN event_type IN ('view', 'purchase') THEN 'base' ELSE 'log' END AS kind, event_id AS sequence, 'f' || event_id AS path FROM events
    ), s AS (SELECT * FROM f WHERE instant <= '020'),
    b AS (SELECT p, g, path AS base_file, instant AS base_instant FROM s WHERE kind = 'base' QUALIFY row_number() OVER (PARTITION BY p, g ORDER BY instant DESC, sequence DESC) = 1)
    SELECT s.p AS "partition", s.g AS file_group, base_file, base_instant,
      coalesce(string_agg(path, ',' ORDER BY instant, sequence) FILTER (kind = 'log' AND (base_instant IS NULL OR instant >= base_instant)), '') AS logs
    FROM s LEFT JOIN b USING (p, g) GROUP BY ALL""")
def mor_file_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Events as files: a user is a file group, a day an instant."""
    files = _t(spark, sf, "events").select(
        (F.col("user_id") % 8).alias("partition"), F.col("user_id").alias("file_group"),
        F.lpad((F.floor(conv.to_epoch(F.col("ts"), "s") / 86_400) % 30).cast("string"), 3, "0").alias("instant"),
        F.when(F.col("event_type").isin("view", "purchase"), "base").otherwise("log").alias("kind"),
        F.col("event_id").alias("sequence"), F.concat(F.lit("f"), "event_id").alias("path"),
    )
    return merge.file_slices(files, "020").withColumn("logs", F.array_join("logs", ","))


@query(_LATEST.format(where="ts < TIMESTAMP '2024-01-25'", alive="event_type <> 'error'"))
def mor_snapshot_read(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as base files and logs of file slices in two partitions, listed, sliced and merged.

    The second base file of a slice holds what the first and its log gave; a log of an instant that is not completed, and
    a base file that no completed instant wrote, are not seen.
    """
    table = new_path(spark, "slices")
    events = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    until = lambda day, rows: rows.where(F.col("ts") < F.expr(f"timestamp_ntz'2024-01-{day}'"))
    since = lambda day, rows: rows.where(F.col("ts") >= F.expr(f"timestamp_ntz'2024-01-{day}'"))
    marked = lambda rows, instant: rows.withColumn(slices.COMMIT_TIME, F.lit(instant))
    for part in (0, 1):
        own = events.where(F.col("user_id") % 2 == part)
        merged = lambda day, rows=own: merge.latest_by_key(until(day, rows), ["user_id"], ["ts", "event_id"])
        slices.write_file(marked(merged("08"), "001"), f"{table}/p={part}/g{part}_0_001.parquet")
        slices.write_file(marked(since("08", until("15", own)), "002"), f"{table}/p={part}/g{part}_001.log.1_0")
        slices.write_file(marked(merged("15"), "003"), f"{table}/p={part}/g{part}_0_003.parquet")
        slices.write_file(marked(since("15", until("20", own)), "004"), f"{table}/p={part}/g{part}_003.log.1_0")
        slices.write_file(marked(since("20", until("25", own)), "005"), f"{table}/p={part}/g{part}_003.log.2_0")
        slices.write_file(marked(since("25", own), "006"), f"{table}/p={part}/g{part}_003.log.3_0")
        slices.write_file(marked(own.limit(1), "007"), f"{table}/p={part}/g{part}_0_007.parquet")
    for instant, action in (("001", "commit"), ("002", "deltacommit"), ("003", "commit"), ("004", "deltacommit"), ("005", "deltacommit")):
        slices.write_instant(spark, table, instant, action, "requested")
        slices.write_instant(spark, table, instant, action)
    slices.write_instant(spark, table, "006", "deltacommit", "inflight")
    found = slices.read_snapshot(spark, table, ["user_id"], "ts", F.col("event_type") == "error")
    return found.select("user_id", "event_id", "ts", "event_type", "value")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""")
def pk_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of a table keyed by order alone: the last write of each order."""
    rows = _t(spark, sf, "lineitem")
    last = merge.latest_by_key(rows, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


# Catalog.


def _database(spark: SparkSession, sf: str) -> Catalog:
    """A database over four of the tables as they are."""
    catalog = Catalog(spark)
    catalog.drop_database("lakeread_meta")
    catalog.create_database("lakeread_meta")
    for name in ("customer", "nation", "orders", "region"):
        spark.sql(f"CREATE TABLE lakeread_meta.{name} USING parquet LOCATION '{sf}/{name}.parquet'")
    return catalog


@query("SELECT 'lakeread_meta' AS name")
def meta_list_databases(spark: SparkSession, sf: str) -> DataFrame:
    names = [(n,) for n in _database(spark, sf).list_databases()]
    return spark.createDataFrame(names, "name string").where(F.col("name") == "lakeread_meta")


@query("SELECT unnest(['customer', 'nation', 'orders', 'region']) AS name")
def meta_list_tables(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in _database(spark, sf).list_tables("lakeread_meta")], "name string")


@query("SELECT * FROM (VALUES ('nation', true), ('nowhere', false)) AS t(name, found)")
def meta_table_exists(spark: SparkSession, sf: str) -> DataFrame:
    catalog = _database(spark, sf)
    return spark.createDataFrame([(n, catalog.table_exists("lakeread_meta", n)) for n in ("nation", "nowhere")], "name string, found boolean")


@query("""
    SELECT (ordinal_position - 1)::INT AS position, column_name AS name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
      WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp-micros' WHEN 'FLOAT[]' THEN 'array<float>' END AS type
    FROM (SELECT row_number() OVER () AS ordinal_position, column_name, column_type AS data_type FROM (DESCRIBE lineitem))""")
def meta_table_schema(spark: SparkSession, sf: str) -> DataFrame:
    return schema_rows(_t(spark, sf, "lineitem")).select("position", "name", "type")


_DESCRIBED = TableSchema(
    [("id", "BigInt"), ("name", "nullable( VARCHAR(16) )"), ("at", "nullable(TIMESTAMP(3))"), ("tags", "Array<nullable(INT)>"), ("day", "date")],
    ["id", "day"], ["day"], {"file.format": "parquet"},
)
_DESCRIPTION = [
    "\tFields:", "\t\t`id` BIGINT NOT NULL", "\t\t`name` VARCHAR(16)", "\t\t`at` TIMESTAMP(3)", "\t\t`tags` ARRAY<INT> NOT NULL", "\t\t`day` DATE NOT NULL",
    "\tPrimaryKeys:", "\t\tid", "\t\tday", "\tPartitionKeys:", "\t\tday", "\tSchemaOptions:", "\t\tfile.format:parquet",
]


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{line}')" for i, line in enumerate(_DESCRIPTION)) + ") AS t(place, line)")
def meta_describe(spark: SparkSession, sf: str) -> DataFrame:
    catalog = _database(spark, sf)
    catalog.create_table("lakeread_meta", "described", _DESCRIBED)
    lines = catalog.schema("lakeread_meta", "described").lines()
    return spark.createDataFrame(list(enumerate(lines)), "place int, line string")


_PARTITIONED = TableSchema(
    [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderstatus", "varchar(1)"), ("o_orderpriority", "varchar(15)")],
    [], ["o_orderstatus", "o_orderpriority"],
)


def _partitioned(spark: SparkSession, sf: str) -> Catalog:
    catalog = _database(spark, sf)
    catalog.create_table("lakeread_meta", "by_status", _PARTITIONED)
    orders = _t(spark, sf, "orders").select(*(n for n, _ in _PARTITIONED.fields))
    catalog.write("lakeread_meta", "by_status", orders.repartition("o_orderstatus", "o_orderpriority"))
    return catalog


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def meta_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return _partitioned(spark, sf).partitions("lakeread_meta", "by_status")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' ORDER BY ALL LIMIT 3")
def meta_partitions_filtered(spark: SparkSession, sf: str) -> DataFrame:
    text = "@function(and,2)" + _cmp("equals", "o_orderstatus", "'F'") + _cmp("notEquals", "o_orderpriority", "'5-LOW'")
    return _partitioned(spark, sf).partitions_by_filter("lakeread_meta", "by_status", text, 3)


@query("""
    SELECT *, (row_number() OVER (ORDER BY o_orderstatus, o_orderpriority) - 1)::INT AS partition_index
    FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL)""")
def split_files_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The file parts of a table's partitions, summed up: each partition's rows by what its parts say."""
    parts = _partitioned(spark, sf).splits("lakeread_meta", "by_status", _cmp("notEquals", "o_orderpriority", "'5-LOW'"))
    return parts.groupBy("partition_index", "o_orderstatus", "o_orderpriority").agg(F.sum("rows").alias("rows"))


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, (o_orderkey % 3 = 0)::INT DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def keyed_table_two_commits(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's last order, from a table keyed by customer: by date, then by write, then by place in the write."""
    catalog = _database(spark, sf)
    fields = [("o_custkey", "bigint"), ("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_orderdate", "timestamp(6)")]
    catalog.create_table("lakeread_meta", "last_orders", TableSchema(fields, ["o_custkey"], [], {"sequence.field": "o_orderdate"}))
    rows = _t(spark, sf, "orders").select(*(n for n, _ in fields)).orderBy("o_orderkey")
    late = F.col("o_orderkey") % 3 == 0
    for some in (rows.where(~late), rows.where(late)):
        catalog.write("lakeread_meta", "last_orders", some)
    return catalog.read("lakeread_meta", "last_orders").select("o_custkey", "o_orderkey", "o_totalprice")


# Types, loading, display, sinks.

_TYPES = {
    "nullable(BOOLEAN)": "boolean", "TinyInt": "tinyint", "smallint": "short", "INT": "int", "bigint": "bigint", "float": "float", "double": "double",
    "decimal( 10, 2 )": "decimal(10,2)", "date": "date", "timestamp": "timestamp-millis", "timestamp(3)": "timestamp-millis", "char(10)": "string",
    "VARCHAR(50)": "string", "binary(5)": "binary", "varbinary(9)": "binary", "array<nullable(int)>": "array<int>",
    "map<varchar(5), array<row<a|bigint,b|decimal(5,1)>>>": "map<string,array<struct<a:bigint,b:decimal(5,1)>>>",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}', {str('nullable' in k.split('<')[0]).lower()})" for k, v in _TYPES.items()) + ") AS t(declared, physical, nullable)")
def ddl_type_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Declared types to physical strings, read back as Spark types and written again."""
    rows = []
    for declared in _TYPES:
        kind = parse_ddl(declared)
        text = kind.physical()
        again = physical_of(parse_physical(text))
        rows.append((declared, text if again in (text, "timestamp") else again, kind.nullable))
    return spark.createDataFrame(rows, "declared string, physical string, nullable boolean")


_ORDERS = T.StructType([
    parse_ddl(t).field(n)
    for n, t in (("o_orderkey", "bigint"), ("o_custkey", "nullable(bigint)"), ("o_totalprice", "nullable(decimal(12,2))"), ("o_orderdate", "nullable(timestamp(6))"), ("o_orderpriority", "nullable(varchar(15))"))
])


@query("""
    SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey, o_totalprice::DECIMAL(12, 2)::VARCHAR AS o_totalprice,
      o_orderdate, o_orderpriority FROM orders""")
def load_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as text and loaded again by their declared types; every tenth customer is blank."""
    path = new_path(spark, "orders-csv")
    customer = F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).otherwise("  ")
    texts = _t(spark, sf, "orders").select(
        "o_orderkey", customer, F.col("o_totalprice").cast("decimal(12,2)").cast("string"), conv.format_timestamp(F.col("o_orderdate"), 6), "o_orderpriority", F.lit("surplus")
    )
    texts.write.csv(path, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_csv(spark, path, _ORDERS).withColumn("o_totalprice", F.col("o_totalprice").cast("string"))


@query("""
    SELECT o_orderkey::VARCHAR || ', ' || coalesce((CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END)::VARCHAR, 'NULL') || ', "' || o_orderpriority || '", '
      || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') || ', <array>' AS line FROM orders""")
def show_data_render(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderpriority", "o_orderdate", F.array("o_orderkey").alias("keys"),
        F.lit(1).alias("hidden"),
    )
    return show.rendered(rows, ["keys", "o_orderdate", "o_orderpriority", "o_custkey", "o_orderkey", "unknown"])


@query("SELECT count(*) AS rows, count(DISTINCT o_custkey) AS keys, 16::BIGINT AS buckets, 0::BIGINT AS parted FROM orders")
def bucket_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written to a table of 16 buckets: rows, keys, buckets that hold rows, and keys in more than one of them."""
    catalog = _database(spark, sf)
    fields = [("o_custkey", "bigint"), ("o_orderkey", "bigint"), ("o_totalprice", "double")]
    catalog.create_table("lakeread_meta", "bucketed", TableSchema(fields, ["o_custkey"]), buckets=16)
    catalog.write("lakeread_meta", "bucketed", _t(spark, sf, "orders").select(*(n for n, _ in fields)))
    keys = catalog.bucket_rows("lakeread_meta", "bucketed").groupBy("o_custkey").agg(F.count("*").alias("rows"), F.min("bucket").alias("low"), F.max("bucket").alias("high"))
    return keys.agg(
        F.sum("rows").alias("rows"), F.count("*").alias("keys"), F.countDistinct("low").alias("buckets"), F.count_if(F.col("low") < F.col("high")).alias("parted")
    )


_NULL_RATE = "SELECT unnest([{names}]) AS name, 4096::BIGINT AS rows, true AS near_a_tenth_null"


@query(_NULL_RATE.format(names=", ".join(f"'c{i}'" for i in range(len(_TYPES)))))
def populate_types(spark: SparkSession, sf: str) -> DataFrame:
    """Generated rows of many types: how many of each column, and whether about a tenth of them are null."""
    kinds = {f"c{i}": k if k.startswith("nullable") else f"nullable({k})" for i, k in enumerate(_TYPES)}
    made = generators.populate(spark, TableSchema(list(kinds.items())).spark(), 4096)
    counts = made.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in made.columns), F.count("*").alias("rows"))
    nulls = counts.select("rows", F.explode(F.create_map(*(x for c in made.columns for x in (F.lit(c), F.col(c))))).alias("name", "nulls"))
    return nulls.select("name", "rows", (F.col("nulls") / F.col("rows")).between(0.07, 0.13).alias("near_a_tenth_null"))


@query("SELECT (range // 512)::BIGINT AS batch, range::INT AS ints, 'row-' || range AS strs FROM range(2048)")
def source_inmemory(spark: SparkSession, sf: str) -> DataFrame:
    return generators.synthetic(spark, 4, 512)


@query("SELECT * FROM supplier")
def format_orc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "supplier-orc")
    _t(spark, sf, "supplier").write.orc(path)
    return scan.read(spark, path, "orc")


@query("SELECT count(*) AS rows, 4096::BIGINT AS largest, true AS filled FROM lineitem")
def arrow_batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Batches as arrow_batches() gives them: all rows, none over 4,096, and no more that are not full than partitions."""
    table = _t(spark, sf, "lineitem")
    sizes = batches.batch_sizes(table, 4096).groupBy(F.spark_partition_id().alias("partition")).agg(
        F.sum("rows").alias("rows"), F.max("rows").alias("largest"), F.count_if(F.col("rows") < 4096).alias("short")
    )
    return sizes.agg(F.sum("rows").alias("rows"), F.max("largest").alias("largest"), (F.max("short") <= 1).alias("filled"))


# Conversions.


@query("""
    SELECT event_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us, epoch_us(ts) * 1000 AS ns,
      date_trunc('millisecond', ts) AS back FROM events""")
def conv_epoch_units(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    units = {u: conv.to_epoch(ts, u).alias(u) for u in conv.UNITS}
    return _t(spark, sf, "events").select("event_id", *units.values(), conv.from_epoch(conv.to_epoch(ts, "ms"), "ms").alias("back"))


@query("SELECT o_orderkey, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::INT AS day, o_orderdate::DATE AS back FROM orders")
def conv_epoch_day(spark: SparkSession, sf: str) -> DataFrame:
    day = conv.to_epoch_day(F.col("o_orderdate"))
    return _t(spark, sf, "orders").select("o_orderkey", day.alias("day"), conv.from_epoch_day(day).alias("back"))


@query("SELECT o_orderkey, o_totalprice::DECIMAL(12, 2)::DECIMAL(18, 6)::VARCHAR AS price FROM orders")
def conv_decimal_rescale(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return _t(spark, sf, "orders").select("o_orderkey", conv.rescale(price, 18, 6).cast("string").alias("price"))


@query("SELECT 'only prefixes can be pushed: %a%' AS dropped")
def pred_dropped_conjuncts(spark: SparkSession, sf: str) -> DataFrame:
    """What the lenient filter of pred_and_failover left out."""
    found = parse(PREDICATES["pred_and_failover"][2], _t(spark, sf, "part").schema)
    return spark.createDataFrame([(d,) for d in found.dropped], "dropped string")


QUERIES |= workload.QUERIES
ORACLE_SQL |= workload.ORACLE_SQL

"""Databases, tables, their declared schemas and their partitions, over Spark's own catalog."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import LogicalType, parse_ddl, physical_of
from ..operators.merge import latest_by_key
from ..operators.predicate import parse
from .base import TableSource
from .scan import Scan

DECLARED = "lakeread.declared"  # table property with what Spark's own schema can't hold
FILLER = "_lakeread_filler"  # stored column of tables that have partition keys only, which Spark doesn't allow
COMMIT, PLACE = "_lakeread_commit", "_lakeread_place"  # stored columns of tables with primary keys: a row's write, and its place in that
COMMITS = "lakeread.commits"  # table property: how many writes were begun

#: Parameters that a store must have.
S3_REQUIRED = ["endpoint", "accessKey", "secretKey"]


def connection_conf(params: str | dict) -> dict[str, str]:
    """Spark settings for catalog parameters: metastoreType hive or filesystem; filesystem LOCAL, HDFS or S3."""
    p = json.loads(params) if isinstance(params, str) else params
    kind, store = p.get("metastoreType"), (p.get("filesystemParams") or {})
    conf: dict[str, str] = {}
    if kind == "hive":
        if not p.get("uri"):
            raise ValueError("a hive metastore needs a uri")
        conf |= {"spark.sql.catalogImplementation": "hive", "spark.hadoop.hive.metastore.uris": p["uri"]}
    elif kind != "filesystem":
        raise ValueError(f"unsupported metastoreType: {kind}")
    if p.get("warehouse"):
        conf["spark.sql.warehouse.dir"] = p["warehouse"]
    system = store.get("type", "LOCAL").upper()
    if system == "S3":
        if missing := [k for k in S3_REQUIRED if not store.get(k)]:
            raise ValueError(f"S3 needs {', '.join(missing)}")
        conf |= {f"spark.hadoop.fs.s3a.{k}": store[v] for k, v in (("endpoint", "endpoint"), ("access.key", "accessKey"), ("secret.key", "secretKey"))}
    elif system == "HDFS":
        conf |= {f"spark.hadoop.{k}": str(v) for k, v in store.items() if k != "type"}
    elif system != "LOCAL":
        raise ValueError(f"unsupported filesystem: {system}")
    return conf


@dataclass(frozen=True)
class TableSchema:
    """Fields as declared, in the table's order, with its keys and options."""

    fields: list[tuple[str, str]]  # name, declared type
    primary_keys: list[str] = field(default_factory=list)
    partition_keys: list[str] = field(default_factory=list)
    options: dict[str, str] = field(default_factory=dict)

    def logical(self) -> list[tuple[str, LogicalType]]:
        return [(n, parse_ddl(t)) for n, t in self.fields]

    def spark(self) -> T.StructType:
        return T.StructType([t.field(n) for n, t in self.logical()])

    def lines(self) -> list[str]:
        """As a description shows it."""
        out = ["\tFields:", *(f"\t\t`{n}` {t}" for n, t in self.logical())]
        out += ["\tPrimaryKeys:", *(f"\t\t{k}" for k in self.primary_keys)]
        out += ["\tPartitionKeys:", *(f"\t\t{k}" for k in self.partition_keys)]
        return [*out, "\tSchemaOptions:", *(f"\t\t{k}:{v}" for k, v in self.options.items())]


def schema_rows(df: DataFrame) -> DataFrame:
    """(position, name, type, nullable) of a DataFrame's columns, with physical type strings."""
    rows = [(i, f.name, physical_of(f.dataType), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


class Catalog(TableSource):
    """Three-level names may be given as @catalog#database."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    @staticmethod
    def database(name: str) -> str:
        """The database's name, quoted; @catalog#database names its catalog."""
        if name.startswith("@") and "#" in name:
            return _quoted(*name[1:].split("#", 1))
        return _quoted(name)

    def table(self, database: str, table: str) -> str:
        return f"{self.database(database)}.{_quoted(table)}"

    def list_databases(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def list_tables(self, database: str) -> list[str]:
        return sorted(r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {self.database(database)}").collect() if not r["isTemporary"])

    def database_exists(self, database: str) -> bool:
        return self.spark.catalog.databaseExists(self.database(database))

    def table_exists(self, database: str, table: str) -> bool:
        return self.database_exists(database) and self.spark.catalog.tableExists(self.table(database, table))

    def create_database(self, database: str) -> bool:
        """False if it was there."""
        if self.database_exists(database):
            return False
        self.spark.sql(f"CREATE DATABASE {self.database(database)}")
        return True

    def drop_database(self, database: str) -> list[str] | None:
        """The tables that were dropped with it; None if it wasn't there."""
        if not self.database_exists(database):
            return None
        tables = self.list_tables(database)
        for table in tables:
            self.drop_table(database, table)
        self.spark.sql(f"DROP DATABASE {self.database(database)}")
        return tables

    def create_table(self, database: str, table: str, schema: TableSchema, file_format: str = "parquet", buckets: int = 0) -> None:
        """Fields, keys and options are kept as declared in a property: files neither hold NOT NULL nor lengths.

        With buckets and primary keys the rows of a key go to one of so many files; the option file.compression is the
        files' codec; sequence.field names a column by which the last row of a key is told before the order of writing. All
        columns may be partition keys.
        """
        if not self.database_exists(database):
            raise ValueError(f"Database '{database}' not exists.")
        if self.table_exists(database, table):
            raise ValueError(f"Table '{table}' already exists.")
        names = [n for n, _ in schema.fields]
        if unknown := [k for k in (*schema.primary_keys, *schema.partition_keys) if k not in names]:
            raise ValueError(f"no column for the keys {unknown}")
        columns = ", ".join(f"{_quoted(n)} {t.spark().simpleString()}" for n, t in schema.logical())
        if schema.primary_keys:
            columns += f", {COMMIT} bigint, {PLACE} bigint"
        if set(names) == set(schema.partition_keys):
            columns += f", {FILLER} tinyint"
        sql = f"CREATE TABLE {self.table(database, table)} ({columns}) USING {file_format}"
        if codec := schema.options.get("file.compression"):
            sql += f" OPTIONS (compression '{codec}')"
        if schema.partition_keys:
            sql += f" PARTITIONED BY ({', '.join(map(_quoted, schema.partition_keys))})"
        bucketed = [k for k in schema.primary_keys if k not in schema.partition_keys]
        if buckets and bucketed:
            sql += f" CLUSTERED BY ({', '.join(map(_quoted, bucketed))}) INTO {buckets} BUCKETS"
        declared = json.dumps(asdict(schema)).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"{sql} TBLPROPERTIES ('{DECLARED}' = '{declared}')")

    def drop_table(self, database: str, table: str) -> bool:
        if not self.table_exists(database, table):
            return False
        self.spark.sql(f"DROP TABLE {self.table(database, table)}")
        return True

    def schema(self, database: str, table: str) -> TableSchema:
        """What was declared; for tables of other origin what Spark knows."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table(database, table)}").collect()
        properties = {r["key"]: r["value"] for r in rows}
        if DECLARED in properties:
            found = json.loads(properties[DECLARED])
            return TableSchema([tuple(f) for f in found["fields"]], found["primary_keys"], found["partition_keys"], found["options"])
        columns = self.spark.catalog.listColumns(self.table(database, table))
        plain = {"smallint": "smallint", "string": "varchar(2147483647)", "binary": "varbinary(2147483647)", "timestamp": "localzonedtimestamp", "timestamp_ntz": "timestamp"}
        fields = [(c.name, f"nullable({plain.get(c.dataType, c.dataType)})") for c in columns]
        return TableSchema(fields, [], [c.name for c in columns if c.isPartition], {})

    def read(self, database: str, table: str, merged: bool = True) -> DataFrame:
        """The table with its declared types as column metadata, columns in declared order.

        Of a table with primary keys the last row of each key, unless merged is False: that of the greatest sequence.field,
        if the table has one, then of the last write, and in a write the last. It takes one exchange, on the keys, for
        partial results.
        """
        df, declared = self.spark.table(self.table(database, table)), self.schema(database, table)
        if declared.primary_keys and merged and COMMIT in df.columns:
            first = [F.col(_quoted(declared.options["sequence.field"]))] if "sequence.field" in declared.options else []
            df = latest_by_key(df, declared.primary_keys, [*first, COMMIT, PLACE])
        return df.select(*(F.col(f"`{n}`").alias(n, metadata={"declared_type": str(t)}) for n, t in declared.logical()))

    def write(self, database: str, table: str, rows: DataFrame, overwrite: bool = False) -> int:
        """Appends rows, or replaces all of the table's, by column name, in one commit; returns how many there were.

        Rows of tables with primary keys are numbered by write, from a counter in the table's properties that is raised
        before it, and by their place in the write, so neither clocks nor file names decide which row is the last.
        """
        seen = Observation()
        name = self.table(database, table)
        if COMMIT in self.spark.table(name).columns:
            known = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            number = int(known.get(COMMITS, 0)) + 1
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{COMMITS}' = '{number}')")
            rows = rows.withColumns({COMMIT: F.lit(number).cast("long"), PLACE: F.monotonically_increasing_id()})
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView("_lakeread_rows")
        columns = ", ".join(_quoted(c) for c in rows.columns)
        self.spark.sql(f"INSERT {'OVERWRITE' if overwrite else 'INTO'} {name} ({columns}) SELECT {columns} FROM _lakeread_rows")
        self.spark.catalog.dropTempView("_lakeread_rows")
        return seen.get["rows"]

    def splits(self, database: str, table: str, predicate: str = "") -> DataFrame:
        """(partition_index, *partition keys, path, offset, length, size, modified, rows) of the file parts of each partition.

        Partitions that the filter leaves out are not opened; those left are numbered from 0 in the order of their keys. A
        table without partition keys has its root as its one partition.
        """
        keys = self.schema(database, table).partition_keys
        parts = Scan(self.spark.table(self.table(database, table)), filter=predicate, complete=True).files(matching=bool(predicate), keys=keys)
        if not keys:
            return parts.select(F.lit(0).alias("partition_index"), *parts.columns)
        found = self.partitions(database, table)
        condition = parse(predicate, found.schema, strict=True).condition if predicate else None
        found = found if condition is None else found.where(condition)
        order = Window.orderBy(*(F.col(_quoted(k)) for k in keys))  # over the catalog's table of partitions alone
        numbered = F.broadcast(found.select(F.struct(*map(_quoted, keys)).alias("_keys"), (F.row_number().over(order) - 1).alias("partition_index")))
        joined = parts.join(numbered, F.struct(*map(_quoted, keys)).eqNullSafe(F.col("_keys")))
        return joined.select("partition_index", *parts.columns)

    def bucket_rows(self, database: str, table: str) -> DataFrame:
        """The table's rows with `bucket`, the number of the bucket that each was written to, null in a table without."""
        number = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5})\.", 1)
        return self.spark.table(self.table(database, table)).withColumn("bucket", F.when(number != "", number.cast("int")))

    def partitions(self, database: str, table: str) -> DataFrame:
        """(*partition keys) of the partitions there are, from the catalog alone."""
        keys = self.schema(database, table).partition_keys
        shown = self.spark.sql(f"SHOW PARTITIONS {self.table(database, table)}")
        pairs = F.str_to_map("partition", F.lit("/"), F.lit("="))
        kinds = self.spark.table(self.table(database, table)).schema
        unescaped = lambda k: F.url_decode(F.replace(pairs[k], F.lit("+"), F.lit("%2B")))
        value = lambda k: F.when(pairs[k] != "__HIVE_DEFAULT_PARTITION__", unescaped(k)).cast(kinds[k].dataType)
        return shown.select(*(value(k).alias(k) for k in keys))

    def partitions_by_filter(self, database: str, table: str, predicate: str, max_parts: int = -1) -> DataFrame:
        """The partitions that a prefix-notation filter keeps, at most max_parts of them if that is not negative."""
        found = self.partitions(database, table)
        condition = parse(predicate, found.schema, strict=True).condition
        found = found if condition is None else found.where(condition)
        return found if max_parts < 0 else found.orderBy(*found.columns).limit(max_parts)

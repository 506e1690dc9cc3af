"""Whole tables: declared, loaded from text in each format, with and without keys, and read back value by value."""

import pytest
from lakeread.sources import datasource
from lakeread.sources.catalog import Catalog, TableSchema
from lakeread.sources.load import read_csv
from lakeread.sources.populate import synthetic
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DECLARED = {
    "region": ([("r_regionkey", "int"), ("r_name", "varchar(25)")], ["r_regionkey"]),
    "nation": ([("n_nationkey", "int"), ("n_name", "char(25)"), ("n_regionkey", "nullable(int)")], ["n_nationkey"]),
    "supplier": ([("s_suppkey", "bigint"), ("s_name", "varchar(25)"), ("s_nationkey", "int"), ("s_acctbal", "double")], ["s_suppkey"]),
    "customer": ([("c_custkey", "bigint"), ("c_name", "varchar(25)"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "char(10)")], ["c_custkey"]),
    "part": ([("p_partkey", "bigint"), ("p_name", "varchar(55)"), ("p_brand", "char(10)"), ("p_type", "varchar(25)"), ("p_size", "int"), ("p_retailprice", "double")], ["p_partkey"]),
    "orders": ([("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "char(1)"), ("o_totalprice", "double"), ("o_orderdate", "timestamp(6)"), ("o_orderpriority", "char(15)")], ["o_orderkey"]),
    "lineitem": (
        [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
         ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "char(1)"), ("l_linestatus", "char(1)"), ("l_shipdate", "timestamp(6)")],
        ["l_orderkey"],
    ),
}


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("file_format", ["parquet", "orc"])
def test_tables_are_loaded_and_read_back(spark, tmp_path, file_format, keyed):
    catalog = Catalog(spark)
    catalog.drop_database("test_tables")
    catalog.create_database("test_tables")
    for name, (fields, keys) in DECLARED.items():
        source = spark.read.parquet(f"{SF}/{name}.parquet")
        text = source.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if t.startswith("timestamp") else F.col(c).cast("string") for c, t in fields))
        text.write.csv(f"{tmp_path}/{name}", quoteAll=True)
        schema = TableSchema(fields, keys if keyed else [])
        catalog.create_table("test_tables", name, schema, file_format)
        assert catalog.write("test_tables", name, read_csv(spark, f"{tmp_path}/{name}", schema.spark())) == source.count()
        got = catalog.read("test_tables", name)
        if not keyed:
            assert sorted(map(repr, got.collect())) == sorted(map(repr, source.select(*(c for c, _ in fields)).collect()))
        else:
            assert got.count() == source.select(*keys).distinct().count()
            assert got.exceptAll(source.select(*(c for c, _ in fields))).count() == 0
    assert catalog.list_tables("test_tables") == sorted(DECLARED)
    catalog.drop_database("test_tables")


def test_the_synthetic_source(spark):
    datasource.register(spark)
    df = spark.read.format("lakeread_synthetic").option("batches", 3).option("rows", 100).load()
    assert df.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, synthetic(spark, 3, 100).collect()))

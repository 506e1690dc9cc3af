import json

import pytest
from lakeread.sources import scan
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LESS = "@function(less,2)@identifier(l_quantity)@literal(Float64_10)"


def test_files_are_told_from_footers_unless_rows_must_match(spark):
    table = scan.read(spark, f"{SF}/lineitem.parquet")
    one = scan.Scan(table, ["l_orderkey"], filter=LESS)
    assert one.files().first()["rows"] == table.count()
    assert one.files(matching=True).first()["rows"] == table.where("l_quantity < 10").count()
    plan = one.files()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    found = json.loads(one.raw_files().first()["descriptor"])
    assert found["format"] == "parquet" and found["path"].endswith("lineitem.parquet") and found["size"] >= found["length"] > 0


def test_a_scan_keeps_more_or_refuses(spark):
    table = scan.read(spark, f"{SF}/lineitem.parquet")
    part = f"@function(and,2){LESS}@function(like,2)@identifier(l_returnflag)@literal('%R')"
    assert scan.Scan(table, filter=part).df().count() == table.where("l_quantity < 10").count()
    with pytest.raises(ValueError):
        scan.Scan(table, filter=part, complete=True).df()
    with pytest.raises(ValueError):
        scan.Scan(table, ["nowhere"]).df()


def test_splits_in_native_form(spark):
    row = (True, True, 0, [("s3a://b/x.orc", "orc")])
    df = spark.createDataFrame([row, (None, True, 0, row[3])], "is_data boolean, raw_convertible boolean, deletion_files int, files array<struct<path:string,format:string>>")
    assert [r[0] for r in df.select(scan.native(df)).collect()] == [True, False]
    assert [r[0] for r in df.select(scan.native(df, force_row=True)).collect()] == [False, False]


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tmp_path, file_format):
    spark.range(5).select(F.col("id").cast("string")).write.format(file_format).save(f"{tmp_path}/t")
    assert scan.read(spark, f"{tmp_path}/t", file_format).count() == 5
    with pytest.raises(NotImplementedError, match="spark-avro"):
        scan.read(spark, f"{tmp_path}/t", "avro")

from lakeread.streaming import upsert
from pyspark.sql import functions as F

SCHEMA = "k int, at int, v string, gone boolean"


def test_a_stream_of_changes_is_merged_with_its_base(spark, tmp_path):
    source, log = f"{tmp_path}/in", f"{tmp_path}/log"
    base = spark.createDataFrame([(1, 0, "base1", False), (2, 0, "base2", False)], SCHEMA)
    merged = lambda path: sorted((r["k"], r["v"]) for r in upsert.read_merged(spark, base, path, ["k"], "at", F.col("gone")).collect())
    for batch, want in (
        ([(1, 1, "a", False), (3, 1, "c", False)], [(1, "a"), (2, "base2"), (3, "c")]),
        ([(1, 1, "later", False), (2, 5, None, True)], [(1, "later"), (3, "c")]),
        ([(2, 4, "too old", False), (3, 0, "too old", False)], [(1, "later"), (3, "c")]),
    ):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        upsert.write_changes(stream, log, f"{tmp_path}/checkpoint").awaitTermination()
        assert merged(log) == want
    upsert.compact(spark, log, f"{tmp_path}/compact", ["k"], "at")
    assert merged(f"{tmp_path}/compact") == want
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 3

"""Consumer queries over scans: they show that scans compose with Spark's own joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pricing_summary(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        _t(spark, sf, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("sum_disc_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"),
        )
    )


def revenue_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    orders = _t(spark, sf, "orders").where(F.year("o_orderdate") == 1996).select("o_orderkey", "o_custkey")
    customers = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return (
        _t(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("n_name").agg(F.round(F.sum(price), 2).alias("revenue"))
    )


def top_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def star_flat(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each region, brand and year of a star join."""
    t = lambda name: _t(spark, sf, name)
    places = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(places.select("s_suppkey", "r_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.groupBy("r_name", "p_brand", F.year("l_shipdate").alias("year")).agg(
        F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count("*").alias("lines")
    )


QUERIES = {
    "workload_pricing_summary": pricing_summary,
    "workload_revenue_by_nation": revenue_by_nation,
    "workload_top_orders": top_orders,
    "workload_star_flat": star_flat,
}

ORACLE_SQL = {
    "workload_pricing_summary": """
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
          round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""",
    "workload_revenue_by_nation": """
        SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE year(o_orderdate) = 1996 GROUP BY ALL""",
    "workload_top_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "workload_star_flat": """
        SELECT r_name, p_brand, year(l_shipdate)::INT AS "year", round(sum(l_quantity), 2) AS quantity, count(*) AS lines
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
}

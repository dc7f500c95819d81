"""Panels derived from the driver tables, each in Spark and in SQL.

``nation_year``: nation x year from orders; a small balanced panel with a region as stratum.
``customer_month``: customer x month from order lines; many units, unbalanced; the nation is the stratum.
``user_day`` / ``user_day_wide``: mean event value per user, day and event type; sparse, so the wide form has nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.panel import pivot_mean

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
COMPONENTS = ["click", "error", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nation_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(
        F.sum("o_totalprice").alias("price"), F.count(F.lit(1)).alias("n")
    )
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    grouped = joined.groupBy("c_nationkey", "period").agg(
        (F.sum("price") / F.sum("n") / 1000).alias("y"),
        (F.sum(F.col("c_acctbal") * F.col("n")) / F.sum("n") / 1000).alias("x"),
        F.sum("n").alias("n_orders"),
    )
    named = grouped.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.select(F.col("n_name").alias("unit"), F.col("r_name").alias("stratum"), "period", "y", "x", "n_orders")


NATION_YEAR = """
ny AS (
  SELECT n_name AS unit, r_name AS stratum, CAST(year(o_orderdate) AS INTEGER) AS period,
         avg(o_totalprice) / 1000 AS y, avg(c_acctbal) / 1000 AS x, CAST(count(*) AS BIGINT) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3
)"""


def customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customer = table(spark, sf_dir, "customer")
    lines = lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_discount").alias("discount"),
        F.sum("l_extendedprice").alias("price"),
        F.count(F.lit(1)).alias("n"),
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    grouped = joined.groupBy("o_custkey", month.alias("period")).agg(
        (F.sum("revenue") / 1000).alias("y"),
        (F.sum("quantity") / F.sum("n") / 10).alias("x"),
        (F.sum("discount") / F.sum("n") * 10).alias("x2"),
        (F.sum("price") / F.sum("n") / 10000).alias("x3"),
    )
    return grouped.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("unit"), F.col("c_nationkey").alias("stratum"), "period", "y", "x", "x2", "x3"
    )


CUSTOMER_MONTH = """
cm AS (
  SELECT o_custkey AS unit, c_nationkey AS stratum,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS period,
         sum(l_extendedprice * (1 - l_discount)) / 1000 AS y, avg(l_quantity) / 10 AS x,
         avg(l_discount) * 10 AS x2, avg(l_extendedprice) / 10000 AS x3
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2, 3
)"""


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on the long contract: unit, period, measure, value."""
    events = table(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return events.select(
        F.col("user_id").alias("unit"), day.alias("period"), F.col("event_type").alias("measure"), "value"
    )


def user_day_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_mean(user_day(spark, sf_dir), ["unit", "period"], "measure", "value", EVENT_TYPES)


USER_DAY = """
ud AS (
  SELECT user_id AS unit, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS period,
         event_type AS measure, value
  FROM events
)"""

USER_DAY_WIDE = USER_DAY + """,
uw AS (
  SELECT unit, period, avg(value) FILTER (measure = 'click') AS click, avg(value) FILTER (measure = 'error') AS error,
         avg(value) FILTER (measure = 'purchase') AS purchase, avg(value) FILTER (measure = 'signup') AS signup,
         avg(value) FILTER (measure = 'view') AS view
  FROM ud GROUP BY unit, period
)"""

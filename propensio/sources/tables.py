"""The client table, derived from the driver's customer and orders tables.

Column meanings follow the client schema (ID, Age, Gender, FamilyMembers,
FinancialEducation, RiskPropensity, Income, Wealth and two 0/1 labels). The
derivation rules are fixed values shared with the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"Unknown table '{name}'.")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def clients_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer left join per-customer order totals, shaped as clients.

    Orders are pre-aggregated per customer before the join (map-side partial
    aggregation), so a customer holding a third of all orders costs one row
    per map task, not a hot shuffle partition. Money is summed in integer
    cents so the value does not depend on summation order.
    """
    orders = read_driver_table(spark, sf_dir, "orders")
    customer = read_driver_table(spark, sf_dir, "customer")
    per_customer = orders.groupBy("o_custkey").agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    key = F.col("c_custkey")
    joined = customer.join(per_customer, key == F.col("o_custkey"), "left")
    return joined.select(
        key.cast("bigint").alias("ID"),
        (F.lit(18) + (key * 7) % 62).cast("int").alias("Age"),
        (key % 2).cast("int").alias("Gender"),
        (key % 6).cast("int").alias("FamilyMembers"),
        (F.lit(1) + F.col("c_nationkey") % 4).cast("int").alias("FinancialEducation"),
        (F.lit(1) + (key * 3) % 4).cast("int").alias("RiskPropensity"),
        F.when(key % 50 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("cents") / F.lit(100.0))
        .alias("Income"),
        (F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 100).alias("Wealth"),
        F.when(F.coalesce(F.col("n_orders"), F.lit(0)) >= 10, 1).otherwise(0).cast("int")
        .alias("AccumulationInvestment"),
        F.when((F.col("c_acctbal") > 4500) | (key % 7 == 0), 1).otherwise(0).cast("int")
        .alias("IncomeInvestment"),
    )


# The same view in SQL (DuckDB dialect) for the oracle side.
CLIENTS_SQL = """
clients AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS ID,
         CAST(18 + (c.c_custkey * 7) % 62 AS INTEGER) AS Age,
         CAST(c.c_custkey % 2 AS INTEGER) AS Gender,
         CAST(c.c_custkey % 6 AS INTEGER) AS FamilyMembers,
         CAST(1 + c.c_nationkey % 4 AS INTEGER) AS FinancialEducation,
         CAST(1 + (c.c_custkey * 3) % 4 AS INTEGER) AS RiskPropensity,
         CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE o.cents / CAST(100.0 AS DOUBLE) END AS Income,
         greatest(c.c_acctbal, 0.0) * 100 AS Wealth,
         CAST(CASE WHEN coalesce(o.n_orders, 0) >= 10 THEN 1 ELSE 0 END AS INTEGER) AS AccumulationInvestment,
         CAST(CASE WHEN c.c_acctbal > 4500 OR c.c_custkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS IncomeInvestment
  FROM customer c
  LEFT JOIN (SELECT o_custkey,
                    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
                    count(*) AS n_orders
             FROM orders GROUP BY o_custkey) o
    ON c.c_custkey = o.o_custkey
)"""

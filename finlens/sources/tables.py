"""Parquet table access and the shared ``accounts`` view.

``accounts`` plays the part of the company-ratio CSV on the driver's tables:
one row per customer with a category, several ratios, injected missing values,
zero prices, negatives and duplicate rows.  It is a pure DataFrame derivation of
``customer`` and ``orders`` so its size grows with them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.functions.exprs import round_half_away

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# Fixed values of the test view: which keys get a missing sector / ebitda / pe,
# which get a zero price, and which rows are duplicated.
SECTOR_NULL_EVERY = 29
PRICE_ZERO_EVERY = 97
EBITDA_NULL_EVERY = 13
PE_NULL_EVERY = 17
DUPLICATE_EVERY = 50


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer (+ duplicates): id, name, sector, price, ebitda,
    eps, pe, volume, low52, high52, target."""
    orders = load_table(spark, sf_dir, "orders")
    customer = load_table(spark, sf_dir, "customer")
    per_cust = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        round_half_away(F.sum("o_totalprice"), 2).alias("s"),
        round_half_away(F.avg("o_totalprice"), 2).alias("a"),
        F.min("o_totalprice").alias("lo"),
        F.max("o_totalprice").alias("hi"),
    )
    k = F.col("c_custkey")
    base = customer.join(per_cust, k == F.col("o_custkey"), "left").select(
        k.alias("id"),
        F.col("c_name").alias("name"),
        F.when(k % SECTOR_NULL_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("sector"),
        F.when(k % PRICE_ZERO_EVERY == 0, F.lit(0.0)).otherwise(F.col("a")).alias("price"),
        F.when(k % EBITDA_NULL_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal")).alias("ebitda"),
        (F.col("c_acctbal") / F.col("n_orders")).alias("eps"),
        F.when(k % PE_NULL_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("a") / (1 + F.abs(F.col("c_acctbal")))).alias("pe"),
        F.col("n_orders").cast("double").alias("volume"),
        F.col("lo").alias("low52"),
        F.col("hi").alias("high52"),
        F.col("s").alias("target"),
    )
    # duplicates come from a generator in the same pass (a self-union would
    # run the scan and the join twice)
    copies = F.when(F.col("id") % DUPLICATE_EVERY == 0, F.lit(2)).otherwise(F.lit(1))
    return base.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy")


ACCOUNTS_SQL = f"""
WITH o AS (
  SELECT o_custkey, COUNT(*) AS n_orders, ROUND(SUM(o_totalprice),2) AS s, ROUND(AVG(o_totalprice),2) AS a,
         MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi
  FROM orders GROUP BY o_custkey),
b AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey % {SECTOR_NULL_EVERY} = 0 THEN NULL ELSE c_mktsegment END AS sector,
         CASE WHEN c_custkey % {PRICE_ZERO_EVERY} = 0 THEN 0.0 ELSE a END AS price,
         CASE WHEN c_custkey % {EBITDA_NULL_EVERY} = 0 THEN NULL ELSE c_acctbal END AS ebitda,
         c_acctbal / n_orders AS eps,
         CASE WHEN c_custkey % {PE_NULL_EVERY} = 0 THEN NULL ELSE a / (1 + ABS(c_acctbal)) END AS pe,
         CAST(n_orders AS DOUBLE) AS volume, lo AS low52, hi AS high52, s AS target
  FROM customer LEFT JOIN o ON c_custkey = o_custkey)
SELECT * FROM b UNION ALL SELECT * FROM b WHERE id % {DUPLICATE_EVERY} = 0
"""
"""The same view as SQL text (valid in DuckDB and Spark) for the oracle."""

"""Registry of named queries over the given tables, each with its SQL check where one exists."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions.columns import encode_target, rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Registers a query and, if given, the SQL that must give the same rows."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


ROWS_A_TASK = 1 << 20


def by_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows dealt by the keys to the session's shuffle partitions, or to more where ``rows`` would make tasks large.

    What a task groups by the keys then stays the same size, however large the table.
    """
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffled, -(-rows // ROWS_A_TASK)), *keys)


def count_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """(n, different): rows of the first frame, and rows that only one of the two has."""
    sides = first.withColumn("__side", F.lit(1)).unionByName(second.withColumn("__side", F.lit(-1)))
    balance = sides.groupBy(*first.columns).agg(
        F.sum("__side").alias("balance"), F.count(F.when(F.col("__side") == 1, 1)).alias("n")
    )
    return balance.agg(F.sum("n").alias("n"), F.sum(F.abs("balance")).alias("different"))


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_ORDER = [*LINE_KEY, "l_extendedprice"]  # the key alone repeats in the smallest tables
NUMERIC = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice", "o_totalprice",
]
TEXT = ["l_linestatus", "p_brand", "p_type", "o_orderpriority"]


def modelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with part and order attributes and the target y (returned or not)."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            *LINE_KEY, *NUMERIC, *TEXT, "o_orderstatus",
            F.year("o_orderdate").alias("o_year"),
            encode_target(F.col("l_returnflag"), "R").alias("y"),
        )
    )


MODELLING_SQL = """m AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
         l_tax, p_size, p_retailprice, o_totalprice, l_linestatus, p_brand, p_type,
         o_orderpriority, o_orderstatus, year(o_orderdate) AS o_year,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the target and a closed-form score, so no model is needed."""
    logit = 0.05 * (F.col("l_quantity") - 25) - 8 * (F.col("l_discount") - 0.05)
    return table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        encode_target(F.col("l_returnflag"), "R").alias("y"),
        rounded(1 / (1 + F.exp(-logit)), 10).alias("score"),
    ).withColumn("prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))


SCORED_SQL = """s AS (
  SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
           round(1 / (1 + exp(-(0.05 * (l_quantity - 25) - 8 * (l_discount - 0.05)))), 10) + 0.0 AS score
    FROM lineitem))"""

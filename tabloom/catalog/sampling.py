"""Samples, splits and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import LINE_KEY, big, query, rounded, table
from tabloom.operators import sampling
from tabloom.operators.impute import apply_fill, fit_fill, impute
from tabloom.operators.profile import describe_numeric
from tabloom.operators.ranking import exact_quantile


def _bucket(parts: str, salt: str = "") -> str:
    prefix = f"'{salt}|' || " if salt else ""
    return f"('0x' || substr(md5({prefix}{parts}), 1, 8))::bigint"


def _below(share: float) -> int:
    """The 32-bit hash values below which a share of the keys lies."""
    return round(share * (1 << 32))


@query("sample_srs")
def _(spark, sf):
    return sampling.sample(table(spark, sf, "orders"), 0.4, 42)


@query("sample_srs_replace")
def _(spark, sf):
    return sampling.sample(table(spark, sf, "orders"), 0.4, 42, replace=True)


@query("sample_stratified")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return sampling.sample_strata(orders, "year", {1996: 0.2, 1997: 0.4, 1998: 0.4}, 11)


@query("sample_hash", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_bucket('o_orderkey::varchar')} < {_below(0.4)}")
def _(spark, sf):
    return sampling.sample_by_key(table(spark, sf, "orders"), "o_orderkey", 0.4).select("o_orderkey", "o_totalprice")


@query("sample_hash_fine", f"SELECT o_orderkey FROM orders WHERE {_bucket('o_orderkey::varchar')} < {_below(0.00123)}")
def _(spark, sf):
    return sampling.sample_by_key(table(spark, sf, "orders"), "o_orderkey", 0.00123).select("o_orderkey")


@query(
    "sample_hash_stratified",
    f"""SELECT o_orderkey, year(o_orderdate)::bigint AS year FROM orders
        WHERE {_bucket("o_orderkey::varchar", "11")} <
              CASE year(o_orderdate) WHEN 1996 THEN {_below(0.2)} WHEN 1997 THEN {_below(0.4)} WHEN 1998 THEN {_below(0.4)} ELSE 0 END""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", big(F.year("o_orderdate")).alias("year"))
    return sampling.sample_by_key(orders, "o_orderkey", {1996: 0.2, 1997: 0.4, 1998: 0.4}, strata="year", seed="11")


@query("split_random")
def _(spark, sf):
    train, test = sampling.split(table(spark, sf, "orders").select("o_orderkey"), [0.7, 0.3], 12345)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "split_hash",
    f"""SELECT o_orderkey, CASE WHEN b < {_below(0.7)} THEN 'train' WHEN b < {_below(0.7 + 0.2)} THEN 'test' ELSE 'holdout' END AS part
        FROM (SELECT o_orderkey, {_bucket("o_orderkey::varchar", "12345")} AS b FROM orders)""",
)
def _(spark, sf):
    parts = sampling.split(table(spark, sf, "orders").select("o_orderkey"), [0.7, 0.2, 0.1], 12345, key="o_orderkey")
    train, test, holdout = (p.withColumn("part", F.lit(n)) for p, n in zip(parts, ["train", "test", "holdout"]))
    return train.unionByName(test).unionByName(holdout)


@query(
    "split_stratified",
    f"""SELECT o_orderstatus, CASE WHEN b < {_below(0.7)} THEN 'train' ELSE 'test' END AS part, count(*) AS n, sum(o_orderkey)::bigint AS keys
        FROM (SELECT *, {_bucket("o_orderkey::varchar || '|' || o_orderstatus", "12345")} AS b FROM orders) GROUP BY ALL""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    part = sampling.part_of(["train", "test"], [0.7, 0.3], "o_orderkey", seed="12345", strata="o_orderstatus")
    return orders.groupBy("o_orderstatus", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


_GAPS = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_tax, 0.0) AS l_tax, nullif(l_quantity, 1.0) AS l_quantity FROM lineitem)"
_KEYS_BIG = ", ".join(f"{k}::bigint AS {k}" for k in LINE_KEY)


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        *[big(k).alias(k) for k in LINE_KEY],
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"),
    )


@query(
    "impute_constant",
    f"SELECT {_KEYS_BIG}, coalesce(l_tax, 0.0)::double AS l_tax, coalesce(l_quantity, 0.0)::double AS l_quantity FROM {_GAPS}",
)
def _(spark, sf):
    return impute(_lines(spark, sf), ["l_tax", "l_quantity"], "constant", value=0.0)


@query(
    "impute_median",
    f"""SELECT {_KEYS_BIG}, l_quantity, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM {_GAPS}))::double AS imp_l_quantity
        FROM {_GAPS}""",
)
def _(spark, sf):
    lines = _lines(spark, sf).drop("l_tax")
    median = exact_quantile(lines.select("l_quantity"), "l_quantity").first().quantile  # one row
    return apply_fill(lines, {"l_quantity": median}, prefix="imp_")


@query("impute_median_approx")
def _(spark, sf):
    lines = _lines(spark, sf)
    fill = fit_fill(lines, ["l_tax", "l_quantity"], "median", relative_error=0.1)
    return describe_numeric(apply_fill(lines, fill), ["l_tax", "l_quantity"])


@query(
    "impute_mean",
    f"""SELECT 'l_tax' AS "column", round(avg(l_tax), 8) AS mean_before,
               round(avg(coalesce(l_tax, (SELECT avg(l_tax) FROM {_GAPS}))), 8) AS mean_after FROM {_GAPS}
        UNION ALL SELECT 'l_quantity', round(avg(l_quantity), 8),
               round(avg(coalesce(l_quantity, (SELECT avg(l_quantity) FROM {_GAPS}))), 8) FROM {_GAPS}""",
)
def _(spark, sf):
    lines, columns = _lines(spark, sf), ["l_tax", "l_quantity"]
    before = describe_numeric(lines, columns).select("column", rounded(F.col("mean"), 8).alias("mean_before"))
    filled = impute(lines, columns, "mean")
    after = describe_numeric(filled, columns).select("column", rounded(F.col("mean"), 8).alias("mean_after"))
    return before.join(after, "column")

"""Aggregations, column profiles and window functions."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tabloom.catalog.base import LINE_KEY, LINE_ORDER, SCORED_SQL, big, query, scored, table
from tabloom.functions.columns import rounded, safe_ratio
from tabloom.operators import profile, ranking
from tabloom.operators.evaluate import accuracy_sql

_GAPS = """g AS (SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_tax, 0.0) AS l_tax,
  nullif(l_discount, 0.0) AS l_discount,
  CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linestatus END AS l_linestatus,
  nullif(l_returnflag, 'A') AS l_returnflag, 'x' AS fixed FROM lineitem)"""
_GAP_COLUMNS = ["l_quantity", "l_tax", "l_discount", "l_linestatus", "l_returnflag", "fixed"]


def lines_with_gaps(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_linestatus", F.lit("F")).alias("l_linestatus"),
        F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"),
        F.lit("x").alias("fixed"),
    )


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg_group_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return profile.frequency(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query(
    "agg_freq_having",
    """SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 4
       ORDER BY n DESC, p_name LIMIT 10""",
)
def _(spark, sf):
    return profile.frequent_values(table(spark, sf, "part"), "p_name", 4, 10)


@query(
    "agg_group_avg",
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_quantity, round(avg(l_extendedprice), 4) AS avg_price,
              round(avg(l_discount), 8) AS avg_discount FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    means = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        {"l_quantity": "avg", "l_extendedprice": "avg", "l_discount": "avg"}
    )
    return means.select(
        "l_returnflag",
        rounded(F.col("avg(l_quantity)"), 6).alias("avg_quantity"),
        rounded(F.col("avg(l_extendedprice)"), 4).alias("avg_price"),
        rounded(F.col("avg(l_discount)"), 8).alias("avg_discount"),
    )


@query(
    "agg_variance",
    """SELECT round(sum(pow(l_quantity - m, 2)), 3) AS sum_squared, round(var_samp(l_quantity), 7) AS variance,
              round(stddev_samp(l_quantity), 8) AS sd
       FROM lineitem, (SELECT avg(l_quantity) AS m FROM lineitem)""",
)
def _(spark, sf):
    spread = profile.spread_by_deviation(table(spark, sf, "lineitem").select("l_quantity"), "l_quantity")
    return spread.select(
        rounded(F.col("sum_squared"), 3).alias("sum_squared"),
        rounded(F.col("variance"), 7).alias("variance"),
        rounded(F.col("sd"), 8).alias("sd"),
    )


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd,
        min({c})::double AS min, max({c})::double AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
)


@query("agg_describe", _DESCRIBE)
def _(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    table_ = profile.describe_numeric(table(spark, sf, "lineitem"), columns)
    return table_.withColumns({"mean": rounded(F.col("mean"), 4), "sd": rounded(F.col("sd"), 4)})


@query("agg_median", "SELECT round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem WHERE l_extendedprice <> 0")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_extendedprice <> 0").select("l_extendedprice")
    return ranking.exact_quantile(lines, "l_extendedprice").select(rounded(F.col("quantile"), 4).alias("median"))


@query("agg_median_approx")
def _(spark, sf):
    return profile.approx_median(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice", 0.001)


@query("agg_count_distinct", "SELECT count(DISTINCT l_partkey) AS distinct_parts FROM lineitem")
def _(spark, sf):
    return profile.distinct_counts(table(spark, sf, "lineitem"), "l_partkey").withColumnRenamed("distinct", "distinct_parts")


@query(
    "agg_count_distinct_by_group",
    "SELECT year(o_orderdate)::bigint AS year, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(big(F.year("o_orderdate")).alias("year"), "o_custkey")
    return profile.distinct_counts(orders, "o_custkey", ["year"]).withColumnRenamed("distinct", "customers")


_CARDINALITY = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct", count(DISTINCT {c}) <= 1 AS constant FROM g"""
    for c in _GAP_COLUMNS
)


@query("agg_exact_distinct", f"WITH {_GAPS} {_CARDINALITY}")
def _(spark, sf):
    return profile.cardinality_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS, exact=True)


@query("agg_approx_distinct")
def _(spark, sf):
    return profile.cardinality_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS)


@query(
    "agg_constant_columns",
    f"WITH {_GAPS}, c AS ({_CARDINALITY}) SELECT \"column\" FROM c WHERE constant",
)
def _(spark, sf):
    return profile.cardinality_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS).where("constant").select("column")


@query("agg_distinct_values", "SELECT DISTINCT p_type FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_type").distinct()


@query(
    "agg_drop_duplicates",
    """SELECT o_custkey, o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return profile.first_per_key(orders, ["o_custkey", "o_orderstatus"], [F.asc("o_orderkey")])


@query("agg_drop_duplicates_count", "SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders)")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return orders.dropDuplicates(["o_custkey", "year"]).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_collect_list",
    """SELECT o_orderpriority, string_agg(year || ':' || n, ',' ORDER BY year) AS years FROM (
         SELECT o_orderpriority, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year"))
    counted = profile.collect_counted(orders, ["o_orderpriority"], "year", "years")
    text = F.transform("years", lambda s: F.concat_ws(":", s["value"].cast("string"), s["times"].cast("string")))
    return counted.select("o_orderpriority", F.array_join(text, ",").alias("years"))


@query(
    "agg_collect_list_expanded",
    """SELECT p_name, string_agg(p_size::varchar, ',' ORDER BY p_size) AS sizes FROM part GROUP BY p_name""",
)
def _(spark, sf):
    counted = profile.collect_counted(table(spark, sf, "part"), ["p_name"], "p_size", "sizes")
    return counted.select("p_name", F.array_join(profile.expand_counted(F.col("sizes")), ",").alias("sizes"))


_MISSING = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, round((count(*) - count({c})) / count(*), 8) AS share FROM g"""
    for c in _GAP_COLUMNS
)


@query("agg_missing_profile", f"WITH {_GAPS} {_MISSING}")
def _(spark, sf):
    found = profile.missing_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS, empty=True)
    return found.withColumn("share", rounded(F.col("share"), 8))


@query("agg_missing_select_drop", f"WITH {_GAPS}, p AS ({_MISSING}) SELECT \"column\" FROM p WHERE share >= 0.3")
def _(spark, sf):
    found = profile.missing_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS)
    return profile.select_by_missing(found, 0.3, "drop").select("column")


@query("agg_missing_select_keep", f"WITH {_GAPS}, p AS ({_MISSING}) SELECT \"column\" FROM p WHERE share <= 0.3")
def _(spark, sf):
    found = profile.missing_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS)
    return profile.select_by_missing(found, 0.3, "keep").select("column")


def _profile_row(c: str) -> str:
    numeric = c in ("l_quantity", "l_tax", "l_discount")
    value = c if numeric else "NULL::double"
    return f"""SELECT '{c}' AS "column", '{'numeric' if numeric else 'text'}' AS kind, count(*) AS "rows",
      count(*) - count({c}) AS missing, count(DISTINCT {c}) AS "distinct", round(avg({value}), 6) AS mean,
      round(stddev_samp({value}), 6) AS sd, min({value})::double AS min, max({value})::double AS max FROM g"""


@query("agg_column_profile", f"WITH {_GAPS} " + " UNION ALL ".join(_profile_row(c) for c in _GAP_COLUMNS))
def _(spark, sf):
    found = profile.column_profile(lines_with_gaps(spark, sf), _GAP_COLUMNS, exact=True)
    return found.withColumns({"mean": rounded(F.col("mean"), 6), "sd": rounded(F.col("sd"), 6)})


def _histogram_sql(where: str) -> str:
    return f"""WITH v AS (SELECT o_totalprice AS x FROM orders {where}),
     r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
     b AS (SELECT least(floor((x - lo) / ((hi - lo) / 25)), 24)::bigint AS bin, count(*) AS n FROM v, r GROUP BY 1)
SELECT i.bin, round(lo + i.bin * ((hi - lo) / 25), 4) AS low,
       round(CASE WHEN i.bin = 24 THEN hi ELSE lo + (i.bin + 1) * ((hi - lo) / 25) END, 4) AS high,
       coalesce(n, 0)::bigint AS frequency
FROM (SELECT unnest(range(25)) AS bin) i CROSS JOIN r LEFT JOIN b ON i.bin = b.bin"""


def _histogram(df):
    found = profile.histogram(df, "o_totalprice", 25)
    return found.select(big("bin").alias("bin"), rounded(F.col("low"), 4).alias("low"), rounded(F.col("high"), 4).alias("high"), big("frequency").alias("frequency"))


@query("agg_histogram", _histogram_sql(""))
def _(spark, sf):
    return _histogram(table(spark, sf, "orders"))


@query("agg_histogram_filtered", _histogram_sql("WHERE o_totalprice < 220000"))
def _(spark, sf):
    return _histogram(table(spark, sf, "orders").filter("o_totalprice < 220000"))


@query(
    "agg_bar_by_year",
    """SELECT year(o_orderdate)::bigint AS year, count(*) AS n FROM orders
       WHERE year(o_orderdate) > 1995 AND year(o_orderdate) < 2000 GROUP BY 1 ORDER BY 1 DESC""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(big(F.year("o_orderdate")).alias("year"))
    return profile.frequency(orders.filter("year > 1995 and year < 2000"), ["year"]).orderBy(F.desc("year"))


_DECILES = """d AS (SELECT o_orderkey, o_totalprice,
  ntile(10) OVER (ORDER BY o_totalprice DESC, o_orderkey)::bigint AS decile FROM orders)"""


def _order_deciles(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.global_ntile(orders, "o_totalprice", ["o_orderkey"], 10, out="decile")


@query(
    "agg_bucket_minmax",
    f"""WITH {_DECILES} SELECT decile, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, count(*) AS n
        FROM d GROUP BY decile""",
)
def _(spark, sf):
    return _order_deciles(spark, sf).groupBy(big("decile").alias("decile")).agg(
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_sql_ratio",
    f"WITH {SCORED_SQL} SELECT round(sum(CASE WHEN y = prediction THEN 1 ELSE 0 END) / count(*), 10) AS accuracy FROM s",
)
def _(spark, sf):
    return accuracy_sql(scored(spark, sf), "y", "prediction").select(rounded(F.col("accuracy"), 10).alias("accuracy"))


@query(
    "agg_fillna_freq",
    """SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'Missing') AS priority, count(*) AS n FROM orders GROUP BY 1""",
)
def _(spark, sf):
    gaps = table(spark, sf, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    return profile.frequency(gaps.fillna("Missing", ["priority"]), ["priority"])


# ---- windows -------------------------------------------------------------------------


@query("win_ntile", f"WITH {_DECILES} SELECT * FROM d")
def _(spark, sf):
    return _order_deciles(spark, sf).withColumn("decile", big("decile"))


@query(
    "win_rank_nth",
    """SELECT o_orderkey, o_totalprice, year, r AS rank FROM (
         SELECT o_orderkey, o_totalprice, year(o_orderdate)::bigint AS year,
                rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC)::bigint AS r FROM orders)
       WHERE r = 2""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", big(F.year("o_orderdate")).alias("year"))
    return ranking.nth_ranked(orders, "year", "o_totalprice", 2)


@query(
    "win_gap_to_max",
    """SELECT o_orderkey, year(o_orderdate)::bigint AS year,
              round(max(o_totalprice) OVER (PARTITION BY year(o_orderdate)) - o_totalprice, 4) AS below_top
       FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", big(F.year("o_orderdate")).alias("year"))
    gaps = ranking.gap_to_group_max(orders, "year", "o_totalprice", "gap")
    return gaps.select("o_orderkey", "year", rounded(F.col("gap"), 4).alias("below_top"))


_KEYS = ", ".join(LINE_ORDER)
_KEYS_BIG = ", ".join(f"{k}::bigint AS {k}" for k in LINE_KEY)


def _long_keys(df):
    return df.withColumn("l_linenumber", big("l_linenumber"))


@query(
    "win_row_number",
    f"WITH {SCORED_SQL} SELECT {_KEYS_BIG}, row_number() OVER (ORDER BY score DESC, {_KEYS}) AS row_number FROM s",
)
def _(spark, sf):
    placed = ranking.running_totals(
        scored(spark, sf).select(*LINE_ORDER, "score"), "score", LINE_ORDER, position="row_number"
    )
    return _long_keys(placed.select(*LINE_KEY, "row_number"))


@query(
    "win_ntile_rownum",
    f"""WITH {SCORED_SQL} SELECT {_KEYS_BIG}, ntile(7) OVER (ORDER BY score DESC, {_KEYS})::bigint AS bucket FROM s""",
)
def _(spark, sf):
    placed = ranking.global_ntile(scored(spark, sf).select(*LINE_ORDER, "score"), "score", LINE_ORDER, 7)
    return _long_keys(placed.select(*LINE_KEY, big("bucket").alias("bucket")))


@query(
    "win_cumulative",
    """SELECT year, n, sum(n) OVER (ORDER BY year)::bigint AS cum_n FROM (
         SELECT year(o_orderdate)::bigint AS year, count(*) AS n FROM orders GROUP BY 1)""",
)
def _(spark, sf):
    yearly = profile.frequency(table(spark, sf, "orders").select(big(F.year("o_orderdate")).alias("year")), ["year"])
    upto = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per year
    return yearly.withColumn("cum_n", F.sum("n").over(upto))


@query(
    "win_cumulative_rows",
    """SELECT o_orderkey, sum(round(o_totalprice * 100)::bigint) OVER (ORDER BY o_orderkey)::bigint AS running_cents
       FROM orders""",
)
def _(spark, sf):
    cents = big(F.round(F.col("o_totalprice") * 100))
    orders = table(spark, sf, "orders").select("o_orderkey", cents.alias("cents"))
    placed = ranking.running_totals(
        orders, "o_orderkey", descending=False, position=None, sums={"running_cents": F.col("cents")}
    )
    return placed.select("o_orderkey", "running_cents")


@query(
    "win_share_of_total",
    """SELECT l_returnflag, round(sum(l_quantity), 2) AS total,
              round(sum(l_quantity) / sum(sum(l_quantity)) OVER (), 8) AS share FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    found = profile.share_of_total(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_quantity"))
    return found.select("l_returnflag", rounded(F.col("total"), 2).alias("total"), rounded(F.col("share"), 8).alias("share"))


@query(
    "win_share_within",
    """SELECT l_returnflag, l_linestatus, round(sum(l_tax) / sum(sum(l_tax)) OVER (PARTITION BY l_returnflag), 8) AS share
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_tax").alias("t"))
    share = safe_ratio(F.col("t"), F.sum("t").over(Window.partitionBy("l_returnflag")))
    return sums.select("l_returnflag", "l_linestatus", rounded(share, 8).alias("share"))

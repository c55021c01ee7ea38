"""Models without a group, merged sketches, checked records, a selecting stage and bucketed tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabloom.catalog.base import big, query, rounded, table, unique_name
from tabloom.operators import joins, leave_out, sketches
from tabloom.operators.ranking import numbered, numbered_ntile
from tabloom.operators.selection import CorrelationSelector
from tabloom.session import scratch_path
from tabloom.sources import records, writers


@query(
    "cv_leave_one_group_out_linear",
    """WITH g AS (SELECT l_suppkey AS g, count(*) AS n, sum(l_quantity) AS x, sum(l_extendedprice) AS y FROM lineitem GROUP BY 1),
       fit AS (SELECT g.g, g.n, count(*) AS n_left, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
               FROM g JOIN lineitem ON l_suppkey <> g.g GROUP BY g.g, g.n)
       SELECT f.g AS "group", f.n, f.n_left, round(f.a, 4) + 0.0 AS intercept, round(f.b, 6) + 0.0 AS slope,
              round(sqrt(avg((l_extendedprice - f.a - f.b * l_quantity) ** 2)), 4) + 0.0 AS rmse
       FROM fit f JOIN lineitem ON l_suppkey = f.g GROUP BY f.g, f.n, f.n_left, f.a, f.b""",
)
def _(spark, sf):
    """A regression without each of the suppliers, and its error on that supplier's lines."""
    found = leave_out.linear_without_groups(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice", "l_suppkey")
    return found.select(
        "group", "n", "n_left", rounded(F.col("intercept"), 4).alias("intercept"),
        rounded(F.col("coefficients")[0], 6).alias("slope"), rounded(F.col("rmse"), 4).alias("rmse"),
    )


@query(
    "cv_leave_one_group_out_bayes",
    """WITH o AS (SELECT p_type AS g, l_returnflag AS label, count(*) AS n, sum(l_quantity) AS q, sum(p_size) AS s
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
       t AS (SELECT label, sum(n) AS n, sum(q) AS q, sum(s) AS s FROM o GROUP BY label),
       l AS (SELECT g.g, t.label, t.n - coalesce(o.n, 0) AS n, t.q - coalesce(o.q, 0) AS q, t.s - coalesce(o.s, 0) AS s
             FROM (SELECT DISTINCT g FROM o) g CROSS JOIN t LEFT JOIN o ON o.g = g.g AND o.label = t.label)
       SELECT g AS "group", label, round(ln(n + 1) - ln(sum(n) OVER w + count(*) OVER w), 8) + 0.0 AS prior,
              round(ln(q + 1) - ln(q + s + 2), 8) + 0.0 AS quantity, round(ln(s + 1) - ln(q + s + 2), 8) + 0.0 AS size
       FROM l WINDOW w AS (PARTITION BY g)""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    found = leave_out.bayes_without_groups(lines, ["l_quantity", "p_size"], "l_returnflag", "p_type")
    return found.select(
        "group", "label", rounded(F.col("prior"), 8).alias("prior"),
        rounded(F.col("weights")[0], 8).alias("quantity"), rounded(F.col("weights")[1], 8).alias("size"),
    )


_COUNTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "agg_approx_distinct_merged",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n, true AS near, true AS same FROM lineitem" for c in _COUNTED),
)
def _(spark, sf):
    """Sketches by day of shipping, written, merged over all days: near the exact counts, and equal to one sketch of all rows."""
    lines, path = table(spark, sf, "lineitem"), scratch_path(spark, "sketches")
    sketches.distinct_sketches(lines, ["l_shipdate"], _COUNTED).write.parquet(path)
    merged = sketches.merged_distinct(spark.read.parquet(path), _COUNTED)
    direct = sketches.merged_distinct(sketches.distinct_sketches(lines, [], _COUNTED), _COUNTED)
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in _COUNTED])
    long = lambda df, out: df.select(F.explode(F.create_map(*[x for c in _COUNTED for x in (F.lit(c), F.col(c))])).alias("feature", out))
    both = long(exact, "n").join(long(merged, "merged"), "feature").join(long(direct, "direct"), "feature")
    # Register sketches of equal rows agree but for rounding of the estimate.
    near = F.abs(F.col("merged") - F.col("n")) <= 5 * sketches.distinct_error() * F.col("n") + 1
    same = F.abs(F.col("merged") - F.col("direct")) <= 2 * sketches.distinct_error() * F.col("n") + 1
    return both.select("feature", "n", near.alias("near"), same.alias("same"))


@query("agg_median_merged", "SELECT 'l_extendedprice' AS feature, count(*) AS n, true AS near FROM lineitem")
def _(spark, sf):
    """The share of rows below the merged sketches' median lies within 2 percent of a half."""
    lines, path = table(spark, sf, "lineitem"), scratch_path(spark, "sketches")
    sketches.quantile_sketches(lines, ["l_shipdate"], ["l_extendedprice"]).write.parquet(path)
    middle = sketches.merged_quantiles(spark.read.parquet(path), ["l_extendedprice"], 0.5).scalar()
    rows = lines.select("l_extendedprice", middle.alias("m"))
    below = F.avg((F.col("l_extendedprice") < F.col("m")).cast("double"))
    upto = F.avg((F.col("l_extendedprice") <= F.col("m")).cast("double"))
    return rows.agg(F.lit("l_extendedprice").alias("feature"), F.count(F.lit(1)).alias("n"), ((below <= 0.52) & (upto >= 0.48)).alias("near"))


_EVENT = "event_id long, user_id long, event_type string, value double"
_SIDES_SQL = """SELECT CASE WHEN event_id % 10 = 0 THEN 'not a record' WHEN event_id % 10 = 5 THEN 'wrong type' ELSE 'good' END AS side,
       count(*) AS n, sum(event_id)::bigint AS ids FROM events GROUP BY 1"""


def _event_lines(spark, sf):
    """Events as JSON lines; those with a number ending in 0 are cut off, in 5 have a text for the value."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    wrong = F.to_json(F.struct("event_id", "user_id", "event_type", F.concat(F.lit("v"), F.col("value")).alias("value")))
    whole = F.to_json(F.struct(*events.columns))
    last = F.col("event_id") % 10
    return events.select(F.when(last == 0, F.substring(whole, 1, 25)).when(last == 5, wrong).otherwise(whole).alias("value"))


def _sides(good, rejects):
    number = F.regexp_extract("text", r'"event_id":(\d+)', 1).cast("long")
    sides = good.select(F.lit("good").alias("side"), big("event_id").alias("id"))
    return sides.unionByName(rejects.select(F.col("reason").alias("side"), number.alias("id"))).groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")
    )


@query("src_json_rejects", _SIDES_SQL)
def _(spark, sf):
    path = scratch_path(spark, "lines")
    _event_lines(spark, sf).write.text(path)
    return _sides(*records.read_checked(spark, path, _EVENT))


@query("src_stream_rejects", _SIDES_SQL)
def _(spark, sf):
    """The same through a stream that is stopped after half of its lines and started again."""
    path, good, rejects, state = (scratch_path(spark, x) for x in ("lines", "good", "rejects", "state"))
    lines = _event_lines(spark, sf)
    for part in (0, 1):
        lines.where(F.pmod(F.hash("value"), F.lit(2)) == part).write.mode("append").text(path)
        records.split_stream(records.line_stream(spark, path), _EVENT, good, rejects, state).awaitTermination()
    return _sides(spark.read.parquet(good), spark.read.parquet(rejects))


_STAGE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "stat_corr_stage",
    "WITH c AS (" + " UNION ALL ".join(
        f"SELECT {i} AS i, '{a}' AS a, {j} AS j, abs(corr({a}, {b})) AS v FROM lineitem"
        for i, a in enumerate(_STAGE) for j, b in enumerate(_STAGE)
    ) + ") SELECT a AS feature, max(CASE WHEN j < i THEN v ELSE 0 END) <= 0.5 AS kept FROM c GROUP BY a",
)
def _(spark, sf):
    """The columns that a saved and loaded pipeline lets through."""
    lines = table(spark, sf, "lineitem").select(*_STAGE)
    path = scratch_path(spark, "stage")
    Pipeline(stages=[CorrelationSelector(inputCols=_STAGE, cutoff=0.5)]).fit(lines).write().save(path)
    kept = PipelineModel.load(path).transform(lines)
    through = kept.agg(*[F.count(c).alias(c) for c in kept.columns])  # the columns as Spark finds them
    counts = [F.struct(F.lit(c).alias("feature"), F.lit(c in through.columns).alias("kept")) for c in _STAGE]
    return through.select(F.explode(F.array(*counts)).alias("f")).select("f.*")


@query(
    "sink_table_bucketed",
    """SELECT o_orderstatus, count(*) AS n, round(sum(l_quantity), 2) + 0.0 AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _(spark, sf):
    """Two managed tables in buckets of the order key, joined without an exchange, and dropped after use."""
    lines, orders, out = unique_name("lines"), unique_name("orders"), scratch_path(spark, "bucketed")
    try:
        writers.write_bucketed(table(spark, sf, "lineitem").select("l_orderkey", "l_quantity"), lines, ["l_orderkey"], 8)
        writers.write_bucketed(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), orders, ["o_orderkey"], 8)
        both = spark.table(lines).join(spark.table(orders).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("l_quantity"), 2).alias("quantity")).write.parquet(out)
    finally:
        for name in (lines, orders):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(out)


def _names():
    return [F.col("c_nationkey").desc(), F.col("c_mktsegment"), F.col("c_name"), F.col("c_custkey")]


_NAMES_SQL = "ORDER BY c_nationkey DESC, c_mktsegment, c_name, c_custkey"


@query("win_row_number_text", f"SELECT c_custkey, row_number() OVER ({_NAMES_SQL}) AS position FROM customer")
def _(spark, sf):
    """Places in an order whose ties are settled by texts."""
    placed = numbered(table(spark, sf, "customer"), _names(), "place")
    return placed.select("c_custkey", (F.col("place") + 1).alias("position"))


@query("win_ntile_text", f"SELECT c_custkey, ntile(7) OVER ({_NAMES_SQL}) AS bucket FROM customer")
def _(spark, sf):
    return numbered_ntile(table(spark, sf, "customer"), _names(), 7).select("c_custkey", big("bucket").alias("bucket"))


def _hot_sides(spark, sf):
    """Customers and suppliers by a key that a third of both share."""
    hot = lambda c: F.when(F.col(c) % 3 == 0, -1).otherwise(F.col(c))
    left = table(spark, sf, "customer").select("c_custkey", hot("c_custkey").alias("c_key"))
    return left, table(spark, sf, "supplier").select("s_suppkey", hot("s_suppkey").alias("s_key"))


def _hot_sql(how: str) -> str:
    return f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE c_custkey END AS c_key FROM customer),
       s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_suppkey END AS s_key FROM supplier)
       SELECT c_key, s_key, count(*) AS n, sum(c_custkey)::bigint AS customers, sum(s_suppkey)::bigint AS suppliers
       FROM c {how} JOIN s ON c_key = s_key GROUP BY ALL"""


for _how in ("inner", "left", "right", "full"):

    @query(f"join_{_how}_hot", _hot_sql(_how))
    def _(spark, sf, how=_how):
        left, right = _hot_sides(spark, sf)
        found = joins.join_totals(left, right, "c_key", "s_key", how, ["c_custkey", "s_suppkey"], salts=4)
        return found.withColumnsRenamed({"c_custkey": "customers", "s_suppkey": "suppliers"})

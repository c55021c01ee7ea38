"""Samples of exact size, leading vectors of wide matrices, and runs compared in a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabloom.catalog.base import LINE_ORDER, SCORED_SQL, big, query, rounded, scored, table, unique_name
from tabloom.operators import sampling
from tabloom.operators.evaluate import validation_metrics
from tabloom.operators.range_finder import leading_vectors, left_vectors
from tabloom.plans import run_table
from tabloom.session import scratch_path

_PLACE = "('0x' || substr(md5('7|' || o_orderkey), 1, 8))::bigint, o_orderkey"


@query("sample_exact", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_PLACE} LIMIT 500")
def _(spark, sf):
    return sampling.sample_exact(table(spark, sf, "orders"), "o_orderkey", 500, seed="7").select("o_orderkey", "o_totalprice")


@query(
    "sample_exact_stratified",
    f"""SELECT o_orderkey, year FROM (
          SELECT o_orderkey, year(o_orderdate)::bigint AS year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY {_PLACE}) AS i FROM orders)
        WHERE i <= CASE year WHEN 1996 THEN 20 WHEN 1997 THEN 40 WHEN 1998 THEN 40 ELSE 0 END""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", big(F.year("o_orderdate")).alias("year"))
    return sampling.sample_exact(orders, "o_orderkey", {1996: 20, 1997: 40, 1998: 40}, strata="year", seed="7")


@query(
    "sample_exact_merged",
    f"""SELECT o_orderkey, o_orderstatus FROM (
          SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_PLACE}) AS i FROM orders)
        WHERE i <= 100""",
)
def _(spark, sf):
    """Samples of two halves of the orders, sampled again together."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    draw = lambda df: sampling.sample_exact(df, "o_orderkey", 100, strata="o_orderstatus", seed="7")
    halves = [draw(orders.where(F.col("o_custkey") % 2 == half)) for half in (0, 1)]
    return draw(halves[0].unionByName(halves[1])).select("o_orderkey", "o_orderstatus")


@query(
    "fx_svd_wide_energy",
    """SELECT 4::bigint AS components, round(sum(l_quantity * l_quantity + pow(l_discount * 100, 2) + pow(l_tax * 100, 2) + l_linenumber * l_linenumber), 2) + 0.0 AS energy
       FROM lineitem""",
)
def _(spark, sf):
    """The squares of all singular values add up to the squares of all numbers."""
    own = [F.col(c).cast("double") for c in ("l_quantity", "l_linenumber")]
    vector = F.array(*own, F.col("l_discount") * 100, F.col("l_tax") * 100)
    values, _ = leading_vectors(table(spark, sf, "lineitem").select(vector.alias("v")), "v", 4)
    squares = spark.createDataFrame([(float(s) ** 2,) for s in values], "square double")
    return squares.agg(F.count(F.lit(1)).alias("components"), rounded(F.sum("square"), 2).alias("energy"))


@query(
    "fx_svd_wide_facts",
    """SELECT count(*) AS n, 5::bigint AS components, true AS left_whole, true AS right_whole, true AS rest_whole, true AS falling FROM embeddings
       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0""",
)
def _(spark, sf):
    """U'U and V'V are unit matrices, and A - USV' holds what the values leave of the total."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = table(spark, sf, "embeddings").where(finite).select("embedding")
    values, right = leading_vectors(vectors, "embedding", 5)
    k = len(values)
    rows = left_vectors(vectors, "embedding", values, right, ["embedding"])
    back = F.lit((right * values).tolist())
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda total, z: total + z)
    rest = F.zip_with("embedding", back, lambda x, weights: x - dot(F.col("u"), weights))
    own = F.col("embedding").cast("array<double>")
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(dot(own, own)).alias("total"), F.sum(dot(rest, rest)).alias("rest"),
        *[F.sum(F.col("u")[i] * F.col("u")[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)],
    )
    off = [F.abs(F.col(f"p{i}_{j}") - float(i == j)) for i in range(k) for j in range(i, k)]
    left = F.greatest(*off) < 1e-8
    apart = F.abs(F.col("rest") - (F.col("total") - float((values**2).sum())))
    return sums.select(
        "n", F.lit(k).cast("bigint").alias("components"), left.alias("left_whole"),
        F.lit(bool(np.abs(right.T @ right - np.eye(k)).max() < 1e-8)).alias("right_whole"),
        (apart < 1e-6 * F.col("total")).alias("rest_whole"), F.lit(bool((np.diff(values) <= 0).all())).alias("falling"),
    )


_RUNS = {"low": 0.45, "high": 0.55}


def _recorded(spark, sf):
    """Two runs of one score with two cuts; the first is written twice, at first with another cut."""
    path = scratch_path(spark, unique_name("runs"))
    part = F.when(F.col("l_linenumber") % 2 == 0, "test").otherwise("train")
    rows = scored(spark, sf).withColumn("dataset", part).withColumn("model", F.lit("closed_form"))
    for run_id, cut in (("low", 0.9), *_RUNS.items()):
        cut_rows = rows.withColumn("prediction", (F.col("score") >= cut).cast("int"))
        metrics = validation_metrics(cut_rows, "y", "score", "prediction", LINE_ORDER, ["model", "dataset"])
        run_table.record_run(path, run_id, {"cut": cut}, metrics.where("metric <> 'ks'"))
    return run_table.runs(spark, path)


_RUNS_SQL = f"""{SCORED_SQL}, d AS (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'test' ELSE 'train' END AS dataset FROM s),
  r AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY dataset, score) - 1) / 2 AS place FROM d WINDOW w AS (PARTITION BY dataset ORDER BY score)),
  v AS (SELECT dataset, 'roc' AS metric, (sum(place * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS low,
               (sum(place * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))) AS high FROM r GROUP BY dataset
        UNION ALL SELECT dataset, 'accuracy', avg(((score >= 0.45)::int = y)::int), avg(((score >= 0.55)::int = y)::int) FROM d GROUP BY dataset)"""


@query(
    "auto_runs_compared",
    f"""WITH {_RUNS_SQL} SELECT 'closed_form' AS model, dataset, metric, round(low, 8) + 0.0 AS first, round(high, 8) + 0.0 AS second,
               round(high - low, 8) + 0.0 AS change FROM v""",
)
def _(spark, sf):
    found = run_table.compare_runs(_recorded(spark, sf), "low", "high")
    return found.select("model", "dataset", "metric", *[rounded(F.col(c), 8).alias(c) for c in ("first", "second", "change")])


@query(
    "auto_runs_champion",
    f"""WITH {_RUNS_SQL}, a AS (SELECT dataset, unnest(['low', 'high']) AS run_id, unnest([low, high]) AS value FROM v WHERE metric = 'accuracy'),
        c AS (SELECT t.run_id, max(t.value) AS chosen, sum((abs(t.value - a.value) > 0.03)::int)::bigint AS counter
              FROM a t JOIN a USING (run_id) WHERE t.dataset = 'train' GROUP BY t.run_id),
        p AS (SELECT *, row_number() OVER (ORDER BY counter, chosen DESC, run_id) AS place FROM c)
        SELECT run_id, 'closed_form' AS model, round(chosen, 8) + 0.0 AS chosen, counter, place, CASE place WHEN 1 THEN 'Champion' ELSE 'Challenger' END AS selected FROM p""",
)
def _(spark, sf):
    found = run_table.champion_of_runs(_recorded(spark, sf), "accuracy", "train")
    return found.withColumn("chosen", rounded(F.col("chosen"), 8)).withColumn("place", big("place"))

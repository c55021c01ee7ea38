"""Best partners by inner product, pruned."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import big, query, rounded, table
from tabloom.catalog.models import _ratings
from tabloom.operators import nearest, recommend


@query(
    "un_topk_products",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
       SELECT o.vec_id AS owner, row_number() OVER (PARTITION BY o.vec_id ORDER BY list_inner_product(o.e, p.e) DESC, p.vec_id) AS place,
              p.vec_id AS partner, round(list_inner_product(o.e, p.e), 6) + 0.0 AS rating
       FROM v o, v p QUALIFY place <= 10""",
)
def _(spark, sf):
    """The ten best vectors of every vector, itself among them, with blocks small enough to be pruned."""
    vectors = table(spark, sf, "embeddings")
    found = nearest.best_partners(vectors, vectors, 10, "vec_id", "vec_id", "embedding", block=64)
    return nearest.best_rows(found, "owner", "partner").select("owner", big("place").alias("place"), "partner", rounded(F.col("rating"), 6).alias("rating"))


@query(
    "un_als_topk_pruned",
    """SELECT count(DISTINCT o_custkey) AS users, count(DISTINCT o_custkey) * least(10, count(DISTINCT l_partkey)) AS n,
              0::bigint AS different FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf):
    """Place by place, the pruned ratings are those of the model's own product of all users and items."""
    model = recommend.fit_als(_ratings(spark, sf), "user", "item", "rating")
    mine = recommend.best_items_pruned(model, 10)
    own = recommend.best_items_product(model, 10).select("user", "place", F.col("rating").alias("own"))
    differs = F.col("own").isNull() | F.col("rating").isNull() | (F.abs(F.col("own") - F.col("rating")) > 1e-5 * (1 + F.abs("own")))
    return mine.join(own, ["user", "place"], "full").agg(
        F.count_distinct("user").alias("users"), F.count(F.lit(1)).alias("n"), F.count(F.when(differs, 1)).alias("different")
    )

"""Facts that hold for every sample or fit, so that results which depend on a seed are checked in SQL too.

Each query makes the sample or fit of its namesake at full size and sums up what must be true of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.catalog.base import LINE_KEY, MODELLING_SQL, QUERIES, big, by_rows, modelling, query, table
from tabloom.catalog.models import _CUSTOMER, _customers, _four_importances, _ratings, binary
from tabloom.operators import cluster, learners, recommend, sampling
from tabloom.functions.columns import positive_share

_LARGEST_Z = 6.0  # a sample's size lies within so many standard deviations


def _counted(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _near(taken: Column, rows: Column, share: Column | float, spread: Column | float) -> Column:
    return F.abs(taken - rows * share) <= _LARGEST_Z * F.sqrt(rows * share * spread)


def _sample_facts(name: str, replace: bool):
    @query(f"{name}_facts", f"SELECT count(*) AS n_rows, 0::bigint AS outside, {str(replace).lower()} AS repeats, true AS near FROM orders")
    def run(spark, sf):
        orders = table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("known"))
        taken = QUERIES[name](spark, sf).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
        both = orders.join(taken, "o_orderkey", "full").agg(
            F.count("known").alias("n_rows"), F.sum("times").alias("taken"),
            _counted(F.col("known").isNull()).alias("outside"), _counted(F.col("times") > 1).alias("repeated"),
        )
        spread = 1.0 if replace else 0.6
        near = _near(F.col("taken"), F.col("n_rows"), 0.4, spread)
        return both.select("n_rows", "outside", (F.col("repeated") > 0).alias("repeats"), near.alias("near"))


_sample_facts("sample_srs", False)
_sample_facts("sample_srs_replace", True)


@query("sample_stratified_facts", "SELECT year(o_orderdate)::bigint AS year, count(*) AS n_rows, 0::bigint AS outside, true AS near FROM orders GROUP BY 1")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", big(F.year("o_orderdate")).alias("year"))
    taken = QUERIES["sample_stratified"](spark, sf).select("o_orderkey", F.lit(1).alias("taken"))
    found = orders.join(taken, "o_orderkey", "full").groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("taken").alias("taken"), _counted(F.col("year").isNull()).alias("outside")
    )
    share = F.when(F.col("year") == 1996, 0.2).when(F.col("year").isin(1997, 1998), 0.4).otherwise(0.0)
    return found.select("year", "n_rows", "outside", _near(F.col("taken"), F.col("n_rows"), share, 1 - share).alias("near"))


def _distance(x: Column, centre) -> Column:
    return reduce(Column.__add__, [(x[j] - F.lit(float(c))) ** 2 for j, c in enumerate(centre)])


def _cluster_facts(name: str, kind: str):
    @query(
        f"{name}_facts",
        """SELECT count(*) AS n, 2::bigint AS clusters, 0::bigint AS not_nearest, 0::bigint AS not_mean
           FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    )
    def run(spark, sf):
        model, assigned = cluster.cluster_shares(_customers(spark, sf), _CUSTOMER, 2, kind)
        centres = model.clusterCenters()
        rows = assigned.select("prediction", vector_to_array("features").alias("x"))
        away = F.array(*[_distance(F.col("x"), c) for c in centres])
        per_cluster = rows.groupBy("prediction").agg(
            F.count(F.lit(1)).alias("n"),
            _counted(F.get(away, F.col("prediction")) > F.array_min(away) + 1e-12).alias("not_nearest"),
            F.array(*[F.avg(F.col("x")[j]) for j in range(len(_CUSTOMER))]).alias("mean"),
        )
        # The last step of the fit may still move a centre by less than its tolerance of 1e-4.
        apart = F.get(F.array(*[_distance(F.col("mean"), c) for c in centres]), F.col("prediction"))
        return per_cluster.agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"), F.sum("not_nearest").alias("not_nearest"),
            _counted(apart > 1e-6).alias("not_mean"),
        )


_cluster_facts("un_kmeans", "kmeans")
_cluster_facts("un_bisecting", "bisecting")


@query(
    "stat_importance_facts",
    """SELECT unnest(['decision_tree', 'gradient_boosting', 'logistic', 'random_forest']) AS method, 6::bigint AS features,
              0::bigint AS negative, true AS whole""",
)
def _(spark, sf):
    """Importances of trees sum to 1; those of logistic regression are sizes of coefficients."""
    whole = (F.col("method") == "logistic") | (F.abs(F.col("total") - 1) < 1e-6)
    return _four_importances(spark, sf).groupBy("method").agg(
        F.count_distinct("feature").alias("features"), _counted(F.col("importance") < 0).alias("negative"), F.sum("importance").alias("total")
    ).withColumn("whole", whole).drop("total")


@query("ml_linear_svc_facts", f"WITH {MODELLING_SQL} SELECT count(*) AS n, 0::bigint AS different, true AS better FROM m")
def _(spark, sf):
    """Predictions follow the sign of the fitted plane, whose hinge loss is below that of no plane (1)."""
    rows = binary(spark, sf)
    model = learners.train(rows, "linear_svc")
    x = vector_to_array("features")
    margin = reduce(Column.__add__, [x[j] * F.lit(float(c)) for j, c in enumerate(model.coefficients)]) + F.lit(float(model.intercept))
    scored = model.transform(rows).select("label", "prediction", margin.alias("margin"))
    # Within 1e-9 of the plane, the order of the additions decides.
    clear = F.abs("margin") > 1e-9
    hinge = F.greatest(F.lit(0.0), 1 - (2 * F.col("label") - 1) * F.col("margin"))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), _counted(clear & (F.col("prediction") != (F.col("margin") > 0).cast("double"))).alias("different"),
        (F.avg(hinge) < 1).alias("better"),
    )


@query("ml_mlp_facts", f"WITH {MODELLING_SQL} SELECT count(*) AS n, 0::bigint AS not_whole, 0::bigint AS not_likelier, true AS not_worse FROM m")
def _(spark, sf):
    """Probabilities sum to 1, the likelier class is predicted, and log loss is at most that of the base rate."""
    rows = binary(spark, sf)
    model = learners.train(rows, "neural_network", **learners.DEFAULTS["neural_network"])
    p = vector_to_array("probability")
    scored = model.transform(rows).select("label", "prediction", positive_share(F.col("probability")).alias("p"), (p[0] + p[1]).alias("whole"))
    likelier = (F.col("p") > 0.5).cast("double") == F.col("prediction")
    loss = -F.log(F.greatest(F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p")), F.lit(1e-15)))
    found = scored.agg(
        F.count(F.lit(1)).alias("n"), _counted(F.abs(F.col("whole") - 1) > 1e-9).alias("not_whole"),
        _counted(~likelier & (F.abs(F.col("p") - 0.5) > 1e-9)).alias("not_likelier"), F.avg(loss).alias("loss"), F.avg("label").alias("base"),
    )
    rate = -(F.col("base") * F.log("base") + (1 - F.col("base")) * F.log(1 - F.col("base")))
    return found.select("n", "not_whole", "not_likelier", (F.col("loss") <= rate * (1 + 1e-3)).alias("not_worse"))


def _dot(a: str, b: str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _factors(model) -> tuple[DataFrame, DataFrame]:
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("u"))
    return users, model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("i"))


def _with_factors(model, pairs: DataFrame) -> DataFrame:
    users, items = _factors(model)
    return pairs.join(users, "user").join(items, "item").withColumn("dot", _dot("u", "i"))


_PAIRS_SQL = "pairs AS (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


@query("un_als_facts", f"WITH {_PAIRS_SQL} SELECT count(*) AS n, 0::bigint AS different, true AS better FROM pairs")
def _(spark, sf):
    """Predictions are the products of the factors, and closer to the ratings than their mean."""
    ratings = _ratings(spark, sf)
    model = recommend.fit_als(ratings, "user", "item", "rating")
    users, items = _factors(model)
    # Spark's model joins by user and then by item: the users' factors go along, so that pairs are dealt twice only.
    both = model.transform(ratings.join(users, "user")).join(items, "item").withColumn("dot", _dot("u", "i"))
    off = F.abs(F.col("dot") - F.col("prediction")) > 1e-4 * (1 + F.abs("dot"))
    error = F.avg((F.col("rating") - F.col("prediction")) ** 2)
    return both.agg(F.count(F.lit(1)).alias("n"), _counted(off).alias("different"), (error < F.var_pop("rating")).alias("better"))


@query(
    "un_als_topk_facts",
    f"""WITH {_PAIRS_SQL} SELECT count(DISTINCT o_custkey) AS users, count(DISTINCT o_custkey) * least(10, count(DISTINCT l_partkey)) AS n,
        0::bigint AS repeated, 0::bigint AS different, 0::bigint AS rising FROM pairs""",
)
def _(spark, sf):
    """Every user has ten items, once each, by falling rating, and the ratings are the products of the factors."""
    model = recommend.fit_als(_ratings(spark, sf), "user", "item", "rating")
    best = _with_factors(model, recommend.best_items(model, 10))
    by_user = best.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items"),
        _counted(F.abs(F.col("dot") - F.col("rating")) > 1e-4 * (1 + F.abs("dot"))).alias("different"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "rating"))), lambda r: r["rating"]).alias("ratings"),  # ten at most
    )
    rising = F.col("ratings") != F.sort_array("ratings", asc=False)
    return by_user.agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("n"), F.sum(F.col("n") - F.col("items")).alias("repeated"),
        F.sum("different").alias("different"), _counted(rising).alias("rising"),
    )


@query("src_random_facts", "SELECT count(*) AS n, true AS near_mean, true AS near_sd FROM lineitem")
def _(spark, sf):
    """As many draws as rows, with mean 1 and standard deviation 2 within six standard errors."""
    found = QUERIES["src_random"](spark, sf)
    error = 2.0 / F.sqrt("n")
    return found.select(
        "n", (F.abs(F.col("mean") - 1.0) <= _LARGEST_Z * error).alias("near_mean"),
        (F.abs(F.col("sd") - 2.0) <= _LARGEST_Z * error / F.sqrt(F.lit(2.0))).alias("near_sd"),
    )


@query("split_random_facts", "SELECT count(*) AS n_rows, 0::bigint AS outside, 0::bigint AS repeated, true AS near FROM orders")
def _(spark, sf):
    """Every order is in one part, once, and the training part is near 70 percent."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.lit(1).alias("known"))
    parts = QUERIES["split_random"](spark, sf).groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("times"), _counted(F.col("part") == "train").alias("train")
    )
    found = orders.join(parts, "o_orderkey", "full").agg(
        F.count("known").alias("n_rows"), _counted(F.col("known").isNull() | F.col("times").isNull()).alias("outside"),
        _counted(F.col("times") > 1).alias("repeated"), F.sum("train").alias("train"),
    )
    return found.select("n_rows", "outside", "repeated", _near(F.col("train"), F.col("n_rows"), 0.7, 0.3).alias("near"))


@query(
    "stat_reduce_features_facts",
    f"WITH {MODELLING_SQL} SELECT count(*) AS n, 0::bigint AS different, 5::bigint AS kept, sum(y)::bigint AS positive FROM m",
)
def _(spark, sf):
    """Five features stay, and the target goes with its own row."""
    reduced = QUERIES["stat_reduce_features"](spark, sf)
    features = [c for c in reduced.columns if c not in (*LINE_KEY, "label")]
    own = modelling(spark, sf).select(*LINE_KEY, F.col("y").alias("label"))
    sides = reduced.select(*LINE_KEY, "label", F.lit(1).alias("side")).unionByName(own.withColumn("side", F.lit(-1)))
    sides = by_rows(sides, table(spark, sf, "lineitem").count(), *LINE_KEY)
    balance = sides.groupBy(*LINE_KEY, "label").agg(F.sum("side").alias("balance"), _counted(F.col("side") == 1).alias("n"))
    return balance.agg(
        F.sum("n").alias("n"), F.sum(F.abs("balance")).alias("different"), F.lit(len(features)).cast("long").alias("kept"),
        F.sum(F.col("n") * F.col("label")).cast("long").alias("positive"),
    )

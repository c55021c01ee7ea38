"""Trained models: learners, tuning, clustering, topics, recommendations."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.catalog.base import (
    LINE_KEY, MODELLING_SQL, NUMERIC, TEXT, big, count_differences, modelling, query, rounded, table,
)
from tabloom.functions.columns import encode_target, positive_share
from tabloom.functions.text import tokenize
from tabloom.operators import cluster, learners, recommend, sampling, topics, tuning
from tabloom.operators.encode import assemble, assembler, fit_index, fit_term_vectors, row_shares
from tabloom.operators.evaluate import multiclass_accuracy, regression_metrics
from tabloom.session import scratch_path, written
from tabloom.sources.writers import load_pipeline, save_model

FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice", "o_totalprice"]


def binary(spark, sf, keep=()):
    rows = modelling(spark, sf).withColumn("label", F.col("y"))
    return learners.spread(assemble(rows, FEATURES, "label", keep))


def continuous(spark, sf):
    rows = modelling(spark, sf).withColumn("label", F.col("l_extendedprice"))
    return learners.spread(assemble(rows, FEATURES, "label"))


def outcome(model, df, by=("label", "prediction")):
    return model.transform(df).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


# ---- linear models -------------------------------------------------------------------


@query(
    "ml_linear_regression",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem""",
)
def _(spark, sf):
    rows = assemble(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    model = learners.train(rows, "linear_regression", label="l_extendedprice", solver="normal")
    fit = regression_metrics(model.transform(rows), "l_extendedprice", "prediction")
    return fit.select(
        rounded(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        rounded(F.lit(float(model.intercept)), 2).alias("intercept"),
        rounded(F.col("r2"), 8).alias("r2"),
    )


@query("ml_linear_regression_many")
def _(spark, sf):
    rows = continuous(spark, sf)
    return learners.coefficient_table(learners.train(rows, "linear_regression"), rows)


# With one 0/1 feature the fitted log-odds are those of the two groups.
_FLAGGED = "(SELECT CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS f, l_returnflag AS r FROM lineitem)"


def _flagged(spark, sf, label):
    lines = table(spark, sf, "lineitem").select(
        encode_target(F.col("l_linestatus"), "F").cast("double").alias("f"), label.alias("label")
    )
    return learners.spread(assemble(lines, ["f"], "label"))


def _fitted(model, rows):
    found = learners.coefficient_table(model, rows)
    return found.select(
        big("class").alias("class"), "feature", rounded(F.col("coefficient"), 5).alias("coefficient")
    )


@query(
    "ml_logistic_binary",
    f"""WITH g AS (SELECT f, avg(CASE WHEN r = 'R' THEN 1.0 ELSE 0.0 END) AS p FROM {_FLAGGED} GROUP BY f),
       o AS (SELECT max(CASE WHEN f = 1 THEN ln(p / (1 - p)) END) AS one, max(CASE WHEN f = 0 THEN ln(p / (1 - p)) END) AS zero FROM g)
       SELECT 0::bigint AS class, 'f' AS feature, round(one - zero, 5) + 0.0 AS coefficient FROM o
       UNION ALL SELECT 0, '(intercept)', round(zero, 5) + 0.0 FROM o""",
)
def _(spark, sf):
    rows = _flagged(spark, sf, encode_target(F.col("l_returnflag"), "R"))
    return _fitted(learners.train(rows, "logistic", family="binomial", maxIter=100, tol=1e-9), rows)


# Class weights are the log shares of the groups, centred over the classes.
@query(
    "ml_logistic_multinomial",
    f"""WITH n AS (SELECT f, CASE r WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS k, count(*) AS n FROM {_FLAGGED} GROUP BY ALL),
       p AS (SELECT f, k, ln(n / sum(n) OVER (PARTITION BY f)) AS l FROM n),
       c AS (SELECT f, k, l - avg(l) OVER (PARTITION BY f) AS l FROM p)
       SELECT a.k::bigint AS class, 'f' AS feature, round(a.l - b.l, 5) + 0.0 AS coefficient FROM c a JOIN c b ON a.k = b.k AND a.f = 1 AND b.f = 0
       UNION ALL SELECT k, '(intercept)', round(l, 5) + 0.0 FROM c WHERE f = 0""",
)
def _(spark, sf):
    flag = F.col("l_returnflag")
    rows = _flagged(spark, sf, F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2))
    return _fitted(learners.train(rows, "logistic", family="multinomial", maxIter=100, tol=1e-9), rows)


@query("ml_logistic_binary_many")
def _(spark, sf):
    rows = binary(spark, sf)
    return learners.coefficient_table(learners.train(rows, "logistic", family="binomial"), rows)


@query("ml_logistic_multinomial_many")
def _(spark, sf):
    rows = binary(spark, sf)
    return learners.coefficient_table(learners.train(rows, "logistic", family="multinomial"), rows)


@query("ml_linear_svc")
def _(spark, sf):
    rows = binary(spark, sf)
    return learners.coefficient_table(learners.train(rows, "linear_svc"), rows)


# ---- trees ---------------------------------------------------------------------------


def _tree(name, kind, frame, **params):
    @query(name)
    def run(spark, sf):
        rows = frame(spark, sf)
        return learners.importance_table(learners.train(rows, kind, **params), rows)


_tree("ml_decision_tree_cls_deep", "decision_tree", binary, impurity="gini", maxDepth=5)
_tree("ml_decision_tree_cls_entropy_deep", "decision_tree", binary, impurity="entropy", maxDepth=5)
_tree("ml_decision_tree_reg_deep", "decision_tree_regressor", continuous, impurity="variance", maxDepth=5)
_tree("ml_random_forest_cls_deep", "random_forest", binary, numTrees=20)
_tree("ml_random_forest_reg_deep", "random_forest_regressor", continuous, numTrees=20)
_tree("ml_gbt_cls_deep", "gradient_boosting", binary)
_tree("ml_gbt_reg_deep", "gradient_boosting_regressor", continuous)

# A one-level tree on 0/1 features splits on the one whose split leaves the least impurity,
# which therefore holds all of the importance. The class here depends on the features, because
# leaves that predict the same class are merged.
_STUMP = {"large": "l_quantity > 25", "reduced": "l_discount > 0.05", "taxed": "l_tax > 0.04", "late": "l_linenumber > 4"}
_STUMP_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {test} AS side, CASE WHEN l_quantity + 5 * l_linenumber > 45 THEN 1.0 ELSE 0.0 END AS y, l_extendedprice AS v FROM lineitem"
    for name, test in _STUMP.items()
)


def _stump_label(kind):
    return F.col("l_extendedprice") if kind.endswith("regressor") else F.expr("int(l_quantity + 5 * l_linenumber > 45)")


def _stump_sql(impurity: str) -> str:
    return f"""WITH r AS ({_STUMP_ROWS}), g AS (SELECT feature, side, count(*) AS n, avg(y) AS p, var_pop(v) AS var FROM r GROUP BY ALL),
      i AS (SELECT feature, sum(n * ({impurity})) AS left_over FROM g GROUP BY feature)
      SELECT feature, CASE WHEN left_over = min(left_over) OVER () THEN 1.0 ELSE 0.0 END::double AS importance FROM i"""


def _stump(name, kind, impurity, measure):
    @query(name, _stump_sql(measure))
    def run(spark, sf):
        lines = table(spark, sf, "lineitem")
        label = _stump_label(kind)
        tests = [F.expr(test).cast("double").alias(name) for name, test in _STUMP.items()]
        rows = learners.spread(assemble(lines.select(label.alias("label"), *tests), list(_STUMP), "label"))
        model = learners.train(rows, kind, impurity=impurity, maxDepth=1)
        return learners.importance_table(model, rows).withColumn("importance", rounded(F.col("importance"), 8))


_stump("ml_decision_tree_cls", "decision_tree", "gini", "2 * p * (1 - p)")
_stump("ml_decision_tree_cls_entropy", "decision_tree", "entropy", "-p * log2(p) - (1 - p) * log2(1 - p)")
_stump("ml_decision_tree_reg", "decision_tree_regressor", "variance", "var")


# Unresampled forests and one boosting round on one 0/1 feature reproduce the group means.
def _means(name, kind, value_sql, score, **params):
    @query(
        name,
        f"""WITH g AS (SELECT l_quantity > 25 AS side, count(*) AS n, avg(CASE WHEN l_quantity + 5 * l_linenumber > 45 THEN 1.0 ELSE 0.0 END) AS p,
              avg(l_extendedprice) AS v FROM lineitem GROUP BY 1) SELECT n, round({value_sql}, 6) + 0.0 AS value FROM g""",
    )
    def run(spark, sf):
        lines = table(spark, sf, "lineitem")
        label = _stump_label(kind)
        large = F.expr("l_quantity > 25").cast("double").alias("large")
        rows = learners.spread(assemble(lines.select(label.alias("label"), large), ["large"], "label", ["large"]))
        model = learners.train(rows, kind, maxDepth=1, **params)
        scored = model.transform(rows).select("large", score().alias("value"))
        return scored.groupBy("large").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("value"), 6).alias("value")).drop("large")


_share = lambda: positive_share(F.col("probability"))
_forest = {"numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"}
_means("ml_random_forest_cls", "random_forest", "p", _share, **_forest)
_means("ml_random_forest_reg", "random_forest_regressor", "v", lambda: F.col("prediction"), **_forest)
_means("ml_gbt_reg", "gradient_boosting_regressor", "v", lambda: F.col("prediction"), maxIter=1)
# The first round predicts the mean of labels coded -1 and 1; its probability is sigmoid(2 x raw).
_means("ml_gbt_cls", "gradient_boosting", "1 / (1 + exp(-2 * (2 * p - 1)))", _share, maxIter=1)


# A one-level tree on one 0/1 feature has one leaf per value.
@query(
    "ml_tree_leaf_profile",
    """SELECT count(*) AS "rows", round(avg(l_extendedprice), 4) AS label_mean FROM lineitem GROUP BY l_quantity > 25""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_quantity") > 25).cast("double").alias("large"), "l_extendedprice")
    rows = assemble(lines, ["large"], "l_extendedprice")
    model = learners.train(rows, "decision_tree_regressor", label="l_extendedprice", maxDepth=1)
    found = learners.leaf_profile(model, rows, "l_extendedprice")
    return found.select("rows", rounded(F.col("label_mean"), 4).alias("label_mean"))


@query("ml_tree_leaf_profile_cls")
def _(spark, sf):
    rows = binary(spark, sf)
    return learners.leaf_profile(learners.train(rows, "decision_tree", maxDepth=4), rows, "label")


# ---- other learners ------------------------------------------------------------------


@query("ml_mlp")
def _(spark, sf):
    rows = binary(spark, sf)
    return outcome(learners.train(rows, "neural_network", **learners.DEFAULTS["neural_network"]), rows)


@query("ml_one_vs_rest")
def _(spark, sf):
    rows = table(spark, sf, "embeddings").where("embedding IS NOT NULL").select(
        "vec_id", F.col("label").cast("double").alias("label"), array_to_vector("embedding").alias("features")
    )
    train, test = sampling.split(rows, [0.7, 0.3], 12345, key="vec_id")
    model = learners.train(train, "one_vs_rest", base="random_forest")
    return multiclass_accuracy(model.transform(test), "label", "prediction")


_NB = ["l_quantity", "l_linenumber", "p_size"]


@query(
    "ml_naive_bayes",
    f"""WITH {MODELLING_SQL}, c AS (SELECT y, count(*) AS n, sum(l_quantity) AS s0, sum(l_linenumber) AS s1, sum(p_size) AS s2 FROM m GROUP BY y),
        t AS (SELECT sum(n) AS n, count(*) AS k FROM c)
        SELECT y::bigint AS class, feature, round(ln((c.n + 1) / (t.n + k)), 8) AS log_prior, round(ln((v + 1) / (s0 + s1 + s2 + 3)), 8) AS log_weight
        FROM c, t, LATERAL (SELECT unnest(['l_quantity', 'l_linenumber', 'p_size']) AS feature, unnest([s0, s1, s2]) AS v)""",
)
def _(spark, sf):
    rows = modelling(spark, sf).withColumn("label", F.col("y"))
    model = learners.train(assemble(rows, _NB, "label"), "naive_bayes")
    prior, weight = model.pi.toArray(), model.theta.toArray()
    fitted = [(c, f, float(prior[c]), float(weight[c][i])) for c in range(len(prior)) for i, f in enumerate(_NB)]
    found = spark.createDataFrame(fitted, "class bigint, feature string, log_prior double, log_weight double")
    return found.withColumns({c: rounded(F.col(c), 8) for c in ("log_prior", "log_weight")})


# ---- importances ---------------------------------------------------------------------


def _four_importances(spark, sf):
    # A fit reads the rows a few times and keeps its own form of them, for which memory is left.
    rows = binary(spark, sf).persist(StorageLevel.DISK_ONLY)
    methods = {
        "decision_tree": {}, "gradient_boosting": {}, "logistic": {}, "random_forest": {"numTrees": 20},
    }
    found = None
    try:
        for kind, params in methods.items():
            ranked = learners.importance_table(learners.train(rows, kind, **params), rows)
            ranked = ranked.select(F.lit(kind).alias("method"), "feature", "importance")
            found = ranked if found is None else found.unionByName(ranked)
    finally:
        rows.unpersist()
    return found


@query("stat_importance")
def _(spark, sf):
    return _four_importances(spark, sf)


@query("stat_vote_models")
def _(spark, sf):
    return learners.vote(_four_importances(spark, sf), 3)


_GROUP_CORR = " UNION ALL ".join(
    f"SELECT o_orderpriority AS method, '{f}' AS feature, round(abs(corr({f}, y)), 10) AS importance FROM m GROUP BY 1" for f in NUMERIC
)


@query(
    "stat_vote",
    f"""WITH {MODELLING_SQL}, i AS ({_GROUP_CORR}),
        r AS (SELECT feature, row_number() OVER (PARTITION BY method ORDER BY importance DESC, feature) AS r FROM i)
        SELECT feature, sum(CASE WHEN r <= 3 THEN 1 ELSE 0 END)::bigint AS votes FROM r GROUP BY feature""",
)
def _(spark, sf):
    wide = modelling(spark, sf).groupBy(F.col("o_orderpriority").alias("method")).agg(
        *[rounded(F.abs(F.corr(F.col(f).cast("double"), F.col("y").cast("double"))), 10).alias(f) for f in NUMERIC]
    )
    importances = wide.unpivot("method", NUMERIC, "feature", "importance")
    return learners.vote(importances, 3)


@query("stat_reduce_features")
def _(spark, sf):
    rows = modelling(spark, sf).withColumn("label", F.col("y"))
    _, indexed = fit_index(rows, TEXT)
    vectors = assemble(indexed, [*NUMERIC, *[f"{c}_index" for c in TEXT]], "label")
    # The forest keeps its own form of a task's rows, for which memory is left.
    training = learners.spread(vectors.select("label", "features"), table(spark, sf, "lineitem").count()).persist(StorageLevel.DISK_ONLY)
    try:
        forest = learners.train(training, "random_forest", numTrees=20)
    finally:
        training.unpersist()
    kept = learners.top_features(learners.importance_table(forest, vectors), 5)
    return indexed.select(*LINE_KEY, "label", *kept)


# ---- scoring helpers -----------------------------------------------------------------


# Naive Bayes probabilities have a closed form, so the extracted element can be checked.
@query(
    "fn_vector_element",
    f"""WITH {MODELLING_SQL}, c AS (SELECT y, count(*) AS n, sum(l_quantity) AS s0, sum(l_linenumber) AS s1, sum(p_size) AS s2 FROM m GROUP BY y),
        w AS (SELECT y, ln((n + 1) / (sum(n) OVER () + 2)) AS prior, ln((s0 + 1) / (s0 + s1 + s2 + 3)) AS w0,
                     ln((s1 + 1) / (s0 + s1 + s2 + 3)) AS w1, ln((s2 + 1) / (s0 + s1 + s2 + 3)) AS w2 FROM c),
        o AS (SELECT m.*, a.prior - b.prior + l_quantity * (a.w0 - b.w0) + l_linenumber * (a.w1 - b.w1) + p_size * (a.w2 - b.w2) AS odds
              FROM m, (SELECT * FROM w WHERE y = 1) a, (SELECT * FROM w WHERE y = 0) b)
        SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_partkey, l_suppkey, round(1 / (1 + exp(-odds)), 8) AS probability FROM o""",
)
def _(spark, sf):
    rows = assemble(modelling(spark, sf).withColumn("label", F.col("y")), _NB, "label", LINE_KEY)
    scored = learners.train(rows, "naive_bayes").transform(rows)
    return scored.select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey",
        rounded(positive_share(F.col("probability")), 8).alias("probability"),
    )


@query("model_save_load", f"WITH {MODELLING_SQL} SELECT count(*) AS n, 0::bigint AS different FROM m")
def _(spark, sf):
    rows = modelling(spark, sf).withColumn("label", F.col("y"))
    indexer, indexed = fit_index(rows, TEXT)
    slots = [*FEATURES, *[f"{c}_index" for c in TEXT]]
    vectors = assemble(indexed, slots, "label", LINE_KEY)
    model = learners.train(learners.spread(vectors), "random_forest", numTrees=5)
    path = save_model(PipelineModel([indexer, assembler(slots), model]), scratch_path(spark, "model"))
    share = rounded(positive_share(F.col("probability")), 12).alias("share")
    fresh = load_pipeline(path).transform(rows).select(*LINE_KEY, share)
    return count_differences(model.transform(vectors).select(*LINE_KEY, share), fresh)


# ---- tuning --------------------------------------------------------------------------


@query("cv_grid_train_valid")
def _(spark, sf):
    return tuning.grid_by_holdout(binary(spark, sf))[0]


@query(
    "cv_fold_sizes",
    """SELECT ('0x' || substr(md5('7|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), 1, 8))::bigint % 3 AS fold,
              count(*) AS n FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    fold = big(sampling.fold_of(LINE_KEY, 3, "7")).alias("fold")
    return table(spark, sf, "lineitem").groupBy(fold).agg(F.count(F.lit(1)).alias("n"))


# With one 0/1 feature a fitted score has two values, so its area under the ROC curve depends
# only on the sign of the coefficient: 0.5 + sign x (true rate - false rate) / 2. A penalty with
# an L1 part sets the coefficient to zero where |covariance of label and standardised feature|
# does not exceed regularisation x elastic net.
_LATE = """(SELECT *, CASE WHEN l_linenumber > 4 THEN 1.0 ELSE 0.0 END AS f,
  CASE WHEN l_quantity + 2 * l_linenumber > 33 THEN 1.0 ELSE 0.0 END AS label FROM lineitem)"""
_FOLD = "('0x' || substr(md5('7|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), 1, 8))::bigint % 3"


def _late(rows, keep):
    marked = rows.withColumns({
        "f": F.expr("double(l_linenumber > 4)"), "label": F.expr("int(l_quantity + 2 * l_linenumber > 33)"),
    })
    return assemble(marked, ["f"], "label", keep)


@query(
    "cv_kfold",
    f"""WITH r AS (SELECT f, label, {_FOLD} AS fold FROM {_LATE}), k AS (SELECT unnest([0, 1, 2]) AS fold),
       c AS (SELECT k.fold, covar_pop(f, label) / stddev_samp(f) AS c FROM k JOIN r ON r.fold <> k.fold GROUP BY k.fold),
       t AS (SELECT fold, avg(f) FILTER (label = 1) - avg(f) FILTER (label = 0) AS gap FROM r GROUP BY fold),
       g AS (SELECT * FROM (VALUES (0.1), (0.01)) a(reg_param), (VALUES (0.0), (0.5), (1.0)) b(elastic_net))
       SELECT reg_param::double AS reg_param, elastic_net::double AS elastic_net,
              round(avg(0.5 + CASE WHEN abs(c) > reg_param * elastic_net THEN sign(c) ELSE 0 END * gap / 2), 8) AS auc
       FROM g, c JOIN t USING (fold) GROUP BY ALL""",
)
def _(spark, sf):
    rows = _late(table(spark, sf, "lineitem"), LINE_KEY).withColumn("fold", sampling.fold_of(LINE_KEY, 3, "7"))
    found, _ = tuning.grid_by_folds(rows.select("label", "features", "fold"), "fold", 3, repeats=True)
    return found.withColumn("auc", rounded(F.col("auc"), 8))


@query("cv_kfold_many")
def _(spark, sf):
    rows = binary(spark, sf, LINE_KEY).withColumn("fold", sampling.fold_of(LINE_KEY, 3, "7"))
    return tuning.grid_by_folds(rows.select("label", "features", "fold"), "fold", 3)[0]


@query(
    "cv_leave_one_group_out",
    f"""WITH r AS (SELECT f, label, l_returnflag AS g FROM {_LATE}), k AS (SELECT DISTINCT g FROM r),
       c AS (SELECT k.g, covar_pop(f, label) AS c, avg(f) FILTER (label = 1) - avg(f) FILTER (label = 0) AS gap FROM k JOIN r ON r.g <> k.g GROUP BY k.g),
       t AS (SELECT g, avg(f) FILTER (label = 1) - avg(f) FILTER (label = 0) AS gap FROM r GROUP BY g)
       SELECT g AS "group", round(0.5 + sign(c) * c.gap / 2, 8) AS train_auc, round(0.5 + sign(c) * t.gap / 2, 8) AS test_auc FROM c JOIN t USING (g)""",
)
def _(spark, sf):
    found = tuning.leave_one_group_out(learners.spread(_late(table(spark, sf, "lineitem"), ["l_returnflag"])), "l_returnflag")
    return found.select("group", *[rounded(F.col(c), 8).alias(c) for c in ("train_auc", "test_auc")])


@query(
    "cv_leave_one_group_out_mean",
    f"""WITH r AS (SELECT f, label, l_returnflag AS g FROM {_LATE}), k AS (SELECT DISTINCT g FROM r),
       c AS (SELECT k.g, covar_pop(f, label) AS c, avg(f) FILTER (label = 1) - avg(f) FILTER (label = 0) AS gap FROM k JOIN r ON r.g <> k.g GROUP BY k.g),
       t AS (SELECT g, avg(f) FILTER (label = 1) - avg(f) FILTER (label = 0) AS gap FROM r GROUP BY g)
       SELECT count(*) AS "groups", round(avg(0.5 + sign(c) * c.gap / 2), 8) AS train_auc, round(avg(0.5 + sign(c) * t.gap / 2), 8) AS test_auc
       FROM c JOIN t USING (g)""",
)
def _(spark, sf):
    found = tuning.leave_one_group_out(learners.spread(_late(table(spark, sf, "lineitem"), ["l_returnflag"])), "l_returnflag")
    return tuning.mean_areas(found).select("groups", *[rounded(F.col(c), 8).alias(c) for c in ("train_auc", "test_auc")])


@query("cv_leave_one_group_out_many")
def _(spark, sf):
    return tuning.leave_one_group_out(binary(spark, sf, ["o_orderstatus"]), "o_orderstatus")


# ---- clustering ----------------------------------------------------------------------

def _customers(spark, sf):
    spend = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("spend"), F.count(F.lit(1)).cast("double").alias("orders"), F.max("o_totalprice").alias("largest")
    )
    customers = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") + 1000).alias("balance"))
    return customers.join(spend, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


_CUSTOMER = ["balance", "spend", "orders", "largest"]


@query("un_kmeans")
def _(spark, sf):
    model, assigned = cluster.cluster_shares(_customers(spark, sf), _CUSTOMER, 2, "kmeans")
    sizes = assigned.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return cluster.centre_table(model, _CUSTOMER, spark).join(sizes, "cluster")


@query("un_kmeans_embeddings")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").where("embedding IS NOT NULL").select("vec_id", array_to_vector("embedding").alias("raw"))
    _, assigned = cluster.cluster_vector_shares(vectors, "raw", 10, "kmeans")
    return assigned.select("vec_id", F.col("prediction").alias("cluster"))


@query("un_bisecting")
def _(spark, sf):
    model, assigned = cluster.cluster_shares(_customers(spark, sf), _CUSTOMER, 2, "bisecting")
    sizes = assigned.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return cluster.centre_table(model, _CUSTOMER, spark).join(sizes, "cluster")


# The silhouette by squared distance needs only cluster sizes, sums and squared norms.
@query(
    "ev_silhouette",
    """WITH r AS (SELECT CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS k, o_totalprice / 100000 AS x, (o_custkey % 10)::double AS z FROM orders),
       c AS (SELECT k, count(*) AS n, sum(x) AS sx, sum(z) AS sz, sum(x * x + z * z) AS q FROM r GROUP BY k),
       d AS (SELECT r.k, (x * x + z * z) + a.q / a.n - 2 * (x * a.sx + z * a.sz) / a.n AS own, a.n AS n,
                    (x * x + z * z) + b.q / b.n - 2 * (x * b.sx + z * b.sz) / b.n AS other
             FROM r JOIN c a ON a.k = r.k JOIN c b ON b.k <> r.k)
       SELECT round(avg(CASE WHEN own * n / (n - 1) < other THEN 1 - own * n / (n - 1) / other ELSE other / (own * n / (n - 1)) - 1 END), 6) AS silhouette FROM d""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_totalprice") / 100000).alias("x"), (F.col("o_custkey") % 10).cast("double").alias("z"),
        F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("prediction"),
    )
    value = cluster.silhouette(assemble(orders, ["x", "z"], keep=["prediction"]))
    return spark.createDataFrame([(round(value, 6) + 0.0,)], "silhouette double")


@query("cv_cluster_sweep")
def _(spark, sf):
    return cluster.sweep(row_shares(_customers(spark, sf), _CUSTOMER), range(2, 8), "kmeans")


@query("cv_cluster_sweep_bisecting")
def _(spark, sf):
    return cluster.sweep(row_shares(_customers(spark, sf), _CUSTOMER), range(2, 8), "bisecting")


# ---- topics and recommendations ------------------------------------------------------


@query("un_lda")
def _(spark, sf):
    tokens = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", tokenize(F.col("text")).alias("words"))
    terms = fit_term_vectors(tokens, "words", vocabulary=5000, min_documents=10)
    vectors = learners.spread(terms.transform(tokens).select("doc_id", "features")).persist()
    try:
        model = topics.fit_topics(vectors)
    finally:
        vectors.unpersist()
    return topics.topic_terms(model, terms)


def _ratings(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    ratings = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"))
        .agg(F.avg("l_quantity").cast("float").alias("rating"))
    )
    return written(ratings, "ratings")  # joined and grouped once, read for the fit and for what follows it


@query("un_als")
def _(spark, sf):
    train, test = sampling.split(_ratings(spark, sf), [0.8, 0.2], 12345, key=["user", "item"])
    model = recommend.fit_als(train, "user", "item", "rating")
    found = regression_metrics(model.transform(test), "rating", "prediction")
    return found.select("n", "rmse")


@query("un_als_topk")
def _(spark, sf):
    return recommend.best_items(recommend.fit_als(_ratings(spark, sf), "user", "item", "rating"), 10)


@query("un_als_topk_users")
def _(spark, sf):
    return recommend.best_users(recommend.fit_als(_ratings(spark, sf), "user", "item", "rating"), 10)

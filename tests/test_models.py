"""Hand-checked values, invariants of scores and metrics, and the automated build."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tabloom.operators import association, encode, evaluate, learners, tuning
from tabloom.operators.sampling import with_normal
from tabloom.plans import automodel
from tabloom.session import scratch_path


@pytest.fixture(scope="module")
def scores(spark):
    df = spark.range(2000).select(
        "id", F.round(F.rand(3), 2).alias("score"), (F.rand(4) < F.rand(3)).cast("int").alias("y")
    )
    return df.persist()


def close(a, b, tol=1e-6):
    return math.isclose(a, b, rel_tol=0, abs_tol=tol)


# ---- hand-checked values -------------------------------------------------------------


def test_four_row_regression(spark):
    df = spark.createDataFrame([(58, 50, 12), (37, 95, 27), (29, 137, 39), (19, 150, 45)], "x1 int, x2 int, y int")
    rows = encode.assemble(df, ["x1"], "y")
    model = learners.train(rows, "linear_regression", label="y")
    assert close(model.coefficients[0], -0.8705560620) and close(model.intercept, 61.8723792160)
    found = evaluate.regression_metrics(model.transform(rows), "y", "prediction").first()
    wanted = {
        "mse": 3.3035551504, "rmse": 1.8175684720, "mae": 1.4968094804,
        "explained_variance": 155.8839448496, "r2": 0.9792473960, "r2_adjusted": 0.9688710940,
    }
    for name, value in wanted.items():
        assert close(found[name], value), name


def test_or_gate(spark):
    rows = [(0, 0, 0.5, 0), (1, 0, 0.5, 0), (1, 1, 1.0, 1), (1, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "y int, x1 int, p double, prediction int")
    m = evaluate.classification_metrics(df, "y", "prediction").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (1, 0, 1, 2)
    assert close(m.accuracy, 0.75) and close(m.precision, 1) and close(m.recall, 2 / 3) and close(m.f1, 0.8)
    assert close(evaluate.roc_auc(df, "y", "p").first().auc, 0.8333333333)
    assert close(evaluate.pr_auc(df, "y", "p").first().auc, 0.9583333333)


def test_chi_square(spark):
    rows = [(0, 0.5, 10), (0, 1.5, 20), (1, 1.5, 30), (0, 3.5, 30), (0, 3.5, 40), (1, 3.5, 40)]
    df = spark.createDataFrame([(a, float(b), float(c)) for a, b, c in rows], "label int, f1 double, f2 double")
    found = {r.feature: r for r in association.chi_square(df, ["f1", "f2"], "label").collect()}
    assert close(found["f1"].p_value, 0.6873, 1e-4) and close(found["f2"].p_value, 0.6823, 1e-4)
    assert (found["f1"].degrees_of_freedom, found["f2"].degrees_of_freedom) == (2, 3)
    assert close(found["f1"].statistic, 0.75) and close(found["f2"].statistic, 1.5)
    counted = {r.feature: r.statistic for r in association.chi_square_counts(df, ["f1", "f2"], "label").collect()}
    assert close(counted["f1"], 0.75) and close(counted["f2"], 1.5)


def test_ks_normal(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 0.15, 0.2, 0.3, 0.25)], "x double")
    row = association.ks_normal(df, "x").first()
    assert close(row.statistic, 0.5398278373) and close(row.p_value, 0.0682146311)


def test_small_tree(spark):
    rows = [(30, 0, 1), (25, 1, 0), (45, 0, 0), (57, 1, 1), (27, 0, 1), (54, 1, 1), (35, 1, 1)]
    df = encode.assemble(spark.createDataFrame(rows, "age int, gender int, y int"), ["age", "gender"], "y")
    leaves = learners.leaf_profile(learners.train(df, "decision_tree", label="y"), df, "y").collect()
    assert sum(r["rows"] for r in leaves) == 7


def test_string_index(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    model, _ = encode.fit_index(fit, ["s"])
    new = spark.createDataFrame([("b",), ("a",), ("c",), ("zz",), (None,)], "s string")
    assert {r.s: r.s_index for r in model.transform(new).collect()} == {"c": 0, "a": 1, "b": 2, "zz": 3, None: 3}
    with pytest.raises(ValueError):
        encode.fit_index(fit, ["s"], max_labels=2)


# ---- metric invariants ---------------------------------------------------------------


def test_auc_equals_spark_and_flips(spark, scores):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    mine = evaluate.roc_auc(scores, "y", "score").first().auc
    exact = lambda name: BinaryClassificationEvaluator(
        labelCol="y", rawPredictionCol="score", metricName=name, numBins=0
    ).evaluate(scores)
    assert close(mine, exact("areaUnderROC"), 1e-12)
    assert close(evaluate.pr_auc(scores, "y", "score").first().auc, exact("areaUnderPR"), 1e-12)
    flipped = evaluate.roc_auc(scores.withColumn("score", -F.col("score")), "y", "score").first().auc
    assert close(mine + flipped, 1, 1e-12)


def test_one_class_has_no_area(spark, scores):
    assert evaluate.roc_auc(scores.where("y = 1"), "y", "score").first().auc is None


def test_decile_sizes_and_end(scores):
    rows = evaluate.decile_table(scores, "y", "score", ["id"], slices=12).orderBy("decile").collect()
    sizes = [r.total for r in rows]
    assert sum(sizes) == 2000 and max(sizes) - min(sizes) <= 1
    assert close(rows[-1].target_dist, 100) and close(rows[-1].spread, 0)
    assert all(r.target + r.non_target == r.total for r in rows)


def test_curve_rises(scores):
    points = sorted((r.x, r.y) for r in evaluate.curve_points(scores, "y", "score").collect())
    assert points[0] == (0, 0) and points[-1] == (1, 1)
    assert all(a[1] <= b[1] for a, b in zip(points, points[1:]))


def test_woe_shares_sum_to_one(spark, scores):
    df = scores.withColumn("c", (F.col("id") % 5).cast("string"))
    table = association.woe_table(df, ["c", "score"], "y")
    for row in table.groupBy("varname").agg(F.sum("dist_event").alias("e"), F.sum("dist_nonevent").alias("n"), F.min("iv").alias("iv")).collect():
        assert close(row.e, 1) and close(row.n, 1) and row.iv >= 0


def test_woe_of_one_class_bin_is_zero(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 1), (None, 0)], "c string, y int")
    rows = {r.bin: r for r in association.woe_table(df, ["c"], "y").collect()}
    assert rows["a"].woe == 0 and rows[None].woe == 0
    assert close(rows["b"].woe, math.log((1 / 3) / (1 / 2)))
    assert close(rows["b"].iv, (1 / 3 - 1 / 2) * math.log((1 / 3) / (1 / 2)))


def test_monotone_search_finds_a_trend(spark):
    df = spark.range(4000).select((F.col("id") % 200).cast("double").alias("x"), (F.rand(1) * 200 < F.col("id") % 200).cast("int").alias("y"))
    rows = association.monotone_bins(df, ["x"], "y", max_bins=12).orderBy("bin").collect()
    rates = [r.event_rate for r in rows]
    assert len(rows) >= 5 and rates == sorted(rates) and sum(r["count"] for r in rows) == 4000


def test_vif_equals_regressions(spark):
    df = with_normal(with_normal(spark.range(500), 0, 1, 1, "a"), 0, 1, 2, "e").select("a", (F.col("a") + F.col("e")).alias("b"), F.col("e").alias("c"))
    df = df.withColumn("c", F.col("c") * 0.5 + F.rand(9)).persist()
    features = ["a", "b", "c"]
    found = {r.feature: r.vif for r in association.vif(df, features).collect()}
    for target in features:
        rows = encode.assemble(df, [f for f in features if f != target], target)
        r2 = learners.train(rows, "linear_regression", label=target).summary.r2
        assert math.isclose(found[target], 1 / (1 - r2), rel_tol=1e-6)


def test_correlation_arguments(spark, scores):
    with pytest.raises(ValueError):
        association.correlation_pairs(scores, ["score", "y"], "kendall")
    with pytest.raises(ValueError):
        association.correlation_pairs(scores, ["score", "y"], cutoff=1.5)


def test_psi_of_equal_tables_is_zero(spark, scores):
    df = scores.withColumn("b", F.floor(F.col("score") * 4))
    assert close(association.population_stability(df, df, "b").agg(F.sum("psi")).first()[0], 0, 1e-12)


# ---- learners ------------------------------------------------------------------------


def test_learner_arguments(spark):
    rows = encode.assemble(spark.createDataFrame([(0, -1.0, 2.0), (1, 1.0, 0.0)], "label int, a double, b double"), ["a", "b"], "label")
    with pytest.raises(ValueError):
        learners.train(rows, "naive_bayes")
    with pytest.raises(ValueError):
        learners.train(rows, "neural_network", layers=[3, 2, 2])
    with pytest.raises(ValueError):
        learners.train(rows, "unknown")


def test_vote(spark):
    rows = [("m1", "a", 3.0), ("m1", "b", 2.0), ("m1", "c", 1.0), ("m2", "a", 1.0), ("m2", "b", 3.0), ("m2", "c", 2.0)]
    found = learners.vote(spark.createDataFrame(rows, "method string, feature string, importance double"), 2)
    assert [(r.feature, r.votes) for r in found.collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_svd_rebuilds_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 5.0, 7.0)], "id int, a double, b double")
    values, right, left = encode.singular_values(df, ["a", "b"], 2, keep=["id"])
    s = {r.component: r.singular_value for r in values.collect()}
    v = {(r.component, r.feature): r.loading for r in right.collect()}
    row = left.where("id = 2").first()
    assert close(sum(row[f"u{c}"] * s[c] * v[c, "b"] for c in (1, 2)), 4.0, 1e-8)


def test_leave_one_group_out(spark, scores):
    df = encode.assemble(scores.withColumn("g", F.col("id") % 3), ["score"], "y", ["g"]).withColumnRenamed("y", "label")
    rows = tuning.leave_one_group_out(df, "g").collect()
    assert [r.group for r in rows] == ["0", "1", "2"] and all(0 <= r.test_auc <= 1 for r in rows)
    with pytest.raises(ValueError):
        tuning.leave_one_group_out(df, "g", max_groups=2)


# ---- automated build -----------------------------------------------------------------


def test_champion_rule(spark):
    values = {
        "steady": (0.70, 0.71, 0.69, 0.70, 0.70), "best": (0.90, 0.80, 0.90, 0.90, 0.90), "tied": (0.65, 0.66, 0.65, 0.65, 0.64),
    }
    names = ("train", "valid", "test", "oot1", "oot2")
    rows = [(m, d, "roc", v) for m, vs in values.items() for d, v in zip(names, vs)]
    metrics = spark.createDataFrame(rows, "model string, dataset string, metric string, value double")
    found = {r.model: (r.counter, r.selected) for r in automodel.select_champion(metrics, "ROC").collect()}
    assert found == {"steady": (0, "Champion"), "tied": (0, "Challenger"), "best": (1, "")}
    in_percent = metrics.withColumns({"metric": F.lit("ks"), "value": F.col("value") * 100})
    assert automodel.select_champion(in_percent).where("selected = 'Champion'").first().model == "steady"


@pytest.fixture(scope="module")
def churn(spark):
    df = spark.range(3000).select(
        F.col("id").alias("row_id"), (F.col("id") % 7).cast("double").alias("tenure"), F.round(F.rand(5), 3).alias("balance"),
        F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), (F.col("id") % 3 + 1).cast("int")).alias("region"),
        F.when(F.col("id") % 10 < 9, None).otherwise(F.lit(1.0)).alias("mostly_missing"),
        F.lit("2024-01-01").cast("date").alias("opened"),
    )
    df = df.withColumn("balance", F.when(F.col("row_id") % 11 > 0, F.col("balance")))
    return df.withColumn("exited", ((F.col("tenure") > 3) | (F.col("region") == "z")).cast("int")).persist()


def test_build_and_score(spark, churn):
    path = scratch_path(spark, "test-build")
    metrics, selection = automodel.run(churn, "exited", ["row_id"], path, {"oot1": churn}, ["logistic", "decision_tree"])
    assert metrics.count() == 2 * 4 * 3
    assert selection.where("selected = 'Champion'").count() == 1
    assert selection.first().model == "decision_tree"
    plan, stages = automodel.load_build(spark, path)
    assert sorted(plan.features) == ["balance", "region", "tenure"] and plan.text == ["region"]
    from tabloom.plans.scoring import score

    # An unseen category and missing values must still be scored.
    new = spark.createDataFrame([(1, 5.0, None, "unseen"), (2, 1.0, 0.5, None)], "row_id bigint, tenure double, balance double, region string")
    rows = score(new, plan, stages, ["row_id"]).orderBy("row_id").collect()
    assert rows[0].prediction == 1.0 and all(0 <= r.probability <= 1 for r in rows)
    log = spark.read.parquet(f"{path}/runs")
    assert log.count() == 24 and json.loads(log.first().parameters)["criterion"] == "ks"


def test_transforms_learn_from_train_only(spark, churn):
    odd = churn.withColumn("region", F.when(F.col("row_id") % 100 == 0, "rare").otherwise(F.col("region")))
    prepared = automodel.prepare(odd, "exited", ["row_id"])
    labels = prepared.stages.stages[0].labelsArray[0]
    train_ids = prepared.part("train").select("row_id")
    seen = odd.join(train_ids, "row_id").select("region").distinct().count()
    assert len(labels) == seen


def test_feature_cut(spark, churn):
    prepared = automodel.prepare(churn, "exited", ["row_id"], max_features=2)
    assert len(prepared.plan.features) == 2 and "tenure" in prepared.plan.features


def test_stream_equals_batch_over_several_files(spark, churn):
    from tabloom.plans.scoring import score
    from tabloom.streaming.scoring import record_stream, score_stream

    prepared = automodel.prepare(churn, "exited", ["row_id"])
    model = learners.train(prepared.part("train"), "decision_tree")
    path = automodel.save_build(prepared, model, scratch_path(spark, "test-stream-build"))
    plan, stages = automodel.load_build(spark, path)
    arriving, out, state = (scratch_path(spark, f"test-{x}") for x in ("in", "out", "state"))
    rows = churn.drop("exited", "opened", "mostly_missing")
    rows.where("row_id < 1000").repartition(3).write.parquet(arriving)
    start = lambda: score_stream(record_stream(spark, arriving, rows.schema, "parquet", 1), plan, stages, out, state, ["row_id"])
    start().awaitTermination()
    assert spark.read.parquet(out).count() == 1000
    rows.where("row_id >= 1000").write.mode("append").parquet(arriving)
    start().awaitTermination()  # continues from its state: each record is scored once
    online = spark.read.parquet(out)
    assert online.count() == 3000
    assert score(rows, plan, stages, ["row_id"]).exceptAll(online).count() == 0

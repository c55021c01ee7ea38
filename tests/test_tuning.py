"""Grid searches: exact areas from one pass, and equal rows combined to one with a weight."""

import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate, learners, tuning


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(6000).select(
        F.col("id").alias("row_id"), (F.col("id") % 7 > 3).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        (F.xxhash64("id") % 3 + (F.col("id") % 7 > 3).cast("int") * 2 > 0).cast("int").alias("label"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(3)).alias("fold"),
    )
    return encode.assemble(df, ["a", "b"], "label", ["row_id", "fold"]).persist()


def test_areas_are_exact(spark):
    df = spark.range(5000).repartition(7).select(
        (F.xxhash64("id") % 3 == 0).cast("int").alias("label"), F.rand(3).alias("p"), F.round(F.rand(4), 1).alias("tied"), F.lit(0.2).alias("same"),
        (1.0 + F.col("id") % 3).alias("w"),
    ).persist()
    scores = ["p", "tied", "same"]
    for weight in (None, "w"):
        exact = BinaryClassificationEvaluator(numBins=0, **({"weightCol": weight} if weight else {}))
        wanted = [exact.setRawPredictionCol(c).evaluate(df) for c in scores]
        found = evaluate.roc_areas(df, "label", [F.col(c) for c in scores], F.col(weight) if weight else None)
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(found, wanted))
    assert evaluate.roc_areas(df.where("label = 1"), "label", [F.col("p")]) == [1.0]
    assert evaluate.roc_areas(df.where("label = 0"), "label", [F.col("p")]) == [0.0]


def test_repeated_rows_are_fitted_as_one_with_the_same_result(rows):
    kept = rows.select("label", "features", "fold")
    single, one = tuning.grid_by_folds(kept, "fold", max_iter=100)
    combined, other = tuning.grid_by_folds(kept, "fold", max_iter=100, repeats=True)
    order = ["reg_param", "elastic_net"]
    for a, b in zip(single.orderBy(*order).collect(), combined.orderBy(*order).collect()):
        assert a[:2] == b[:2] and math.isclose(a.auc, b.auc, abs_tol=1e-9)
    assert all(math.isclose(x, y, abs_tol=1e-4) for x, y in zip([*one.coefficients, one.intercept], [*other.coefficients, other.intercept]))


def test_a_search_over_few_values_fits_few_rows(rows, monkeypatch):
    fitted = []
    monkeypatch.setattr(tuning, "_fits", lambda learner, train, *a, fits=tuning._fits: fitted.append((train.count(), train.rdd.getNumPartitions())) or fits(learner, train, *a))
    tuning.grid_by_folds(rows.select("label", "features", "fold"), "fold", reg=(0.1,), net=(0.0,), repeats=True)
    assert len(fitted) == 3 and max(fitted) <= (2 * 2 * 5 * 2, 1)  # before, about 4,000 rows each
    assert {tasks for _, tasks in fitted} == {1}


def test_folds_out_of_range_are_refused(rows):
    with pytest.raises(ValueError):
        tuning.grid_by_folds(rows.withColumn("fold", F.col("fold") + 1), "fold")
    with pytest.raises(ValueError):
        tuning.grid_by_folds(rows.where("fold < 2"), "fold")


def test_the_holdout_is_the_one_of_spark(rows):
    from pyspark.ml.tuning import TrainValidationSplit

    found, _ = tuning.grid_by_holdout(rows, reg=(0.01,), net=(0.0,))
    learner = learners.estimator("logistic", maxIter=10)
    search = TrainValidationSplit(
        estimator=learner, estimatorParamMaps=tuning._grid(learner, (0.01,), (0.0,)), trainRatio=0.7, seed=12345, evaluator=BinaryClassificationEvaluator(numBins=0),
    )
    assert math.isclose(found.first().auc, search.fit(rows).validationMetrics[0], abs_tol=1e-12)


def test_all_rows_wait_on_disk_while_candidates_are_fitted(rows, monkeypatch):
    levels = []
    kept = rows.select("label", "features")
    monkeypatch.setattr(tuning, "_fits", lambda *a, fits=tuning._fits: levels.append((a[1].storageLevel.useMemory, kept.storageLevel.useMemory, kept.storageLevel.useDisk)) or fits(*a))
    tuning.grid_by_holdout(kept, reg=(0.1,), net=(0.0,))
    assert levels == [(True, False, True)]  # before, all rows stood in memory beside the two parts
    assert not kept.storageLevel.useDisk


def test_importances_leave_memory_to_the_fits(spark, sf, monkeypatch):
    from tabloom.catalog import models

    levels = []
    monkeypatch.setattr(models.learners, "train", lambda df, kind, **k: levels.append(df.storageLevel))
    monkeypatch.setattr(models.learners, "importance_table", lambda model, df: spark.createDataFrame([("a", 1.0)], "feature string, importance double"))
    assert models._four_importances(spark, sf).count() == 4
    assert len(levels) == 4 and all(level.useDisk and not level.useMemory for level in levels)  # before, in memory

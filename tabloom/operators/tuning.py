"""Parameter search and validation schemes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.evaluate import roc_areas, roc_auc
from tabloom.operators.learners import ROWS_A_TASK, estimator
from tabloom.functions.columns import positive_share

# The elastic-net grid of the tuning workload.
REG_PARAMS = (0.1, 0.01)
ELASTIC_NETS = (0.0, 0.5, 1.0)
WEIGHT = "__times"


def _grid(learner, reg: Sequence[float], net: Sequence[float]):
    return (
        ParamGridBuilder().addGrid(learner.regParam, list(reg)).addGrid(learner.elasticNetParam, list(net)).build()
    )


def _table(spark, learner, grid, metrics) -> DataFrame:
    rows = [
        (float(p[learner.regParam]), float(p[learner.elasticNetParam]), float(m)) for p, m in zip(grid, metrics)
    ]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, auc double")


def _margin(model) -> Column:
    """A fitted plane as a column; weights of zero add nothing."""
    x = vector_to_array(model.getFeaturesCol())
    weighed = [x[j] * F.lit(float(c)) for j, c in enumerate(model.coefficients) if c]
    return reduce(Column.__add__, weighed, F.lit(float(model.intercept)))


def _for_repeats(learner, grid, rows: DataFrame):
    """The grid that has the same penalties on weighted rows as the given one on the rows repeated.

    Spark standardises by deviations that take weights for reliabilities, not for numbers of rows; all of a
    frame's deviations are larger by the same ratio, so that the coefficients are, and the penalties of them.
    """
    n, squares = rows.agg(F.sum(WEIGHT), F.sum(F.col(WEIGHT) * F.col(WEIGHT))).first()
    if squares in (n, n * n):  # no row repeated, or all rows one
        return grid
    ratio = sqrt((n - 1) / (n - squares / n))
    changed = []
    for candidate in grid:
        reg, net = candidate[learner.regParam], candidate[learner.elasticNetParam]
        l1, l2 = reg * net / ratio, reg * (1 - net) / ratio**2
        changed.append({learner.regParam: l1 + l2, learner.elasticNetParam: l1 / (l1 + l2) if reg else net})
    return changed


def _fits(learner, train: DataFrame, grid, parallelism: int) -> list:
    models = learner.fitMultiple(train, grid)
    fit = inheritable_thread_target(train.sparkSession)(lambda _: next(models))
    with ThreadPool(min(parallelism, len(grid))) as pool:
        return [model for _, model in sorted(pool.imap_unordered(fit, grid), key=lambda found: found[0])]


def _areas(learner, train: DataFrame, held: DataFrame, grid, parallelism: int) -> list[float]:
    """The area of each candidate on the held-out rows, which are read once for all of them."""
    weighed = WEIGHT in train.columns
    train.persist()
    try:
        models = _fits(learner, train, _for_repeats(learner, grid, train) if weighed else grid, parallelism)
    finally:
        train.unpersist()
    return roc_areas(held, learner.getLabelCol(), [_margin(m) for m in models], F.col(WEIGHT) if weighed else None)


def _searched(df: DataFrame, learner, reg, net, parallelism: int, parts):
    """(metric table, best model): candidates by their mean area over the (training, held-out) parts of kept rows.

    All rows are read a few times only and wait on disk; memory is for the training part, which each fit reads.
    """
    grid = _grid(learner, reg, net)
    kept = not df.is_cached
    if kept:
        df.persist(StorageLevel.DISK_ONLY)
    try:
        areas = np.mean([_areas(learner, train, held, grid, parallelism) for train, held in parts(df)], axis=0)
        best = [grid[int(np.argmax(areas))]]
        model = learner.fit(df, *(_for_repeats(learner, best, df) if WEIGHT in df.columns else best))
    finally:
        if kept:
            df.unpersist()
    return _table(df.sparkSession, learner, grid, areas), model


def grid_by_holdout(
    df: DataFrame, label: str = "label", train_ratio: float = 0.7, parallelism: int = 3, seed: int = 12345,
    reg=REG_PARAMS, net=ELASTIC_NETS, max_iter: int = 10,
):
    """(metric table, best model) of a grid scored on one held-out part."""

    def parts(rows):
        dealt = rows.withColumn("__rand", F.rand(seed))
        held = F.col("__rand") >= train_ratio
        yield dealt.where(~held), dealt.where(held)

    return _searched(df, estimator("logistic", label=label, maxIter=max_iter), reg, net, parallelism, parts)


def grid_by_folds(
    df: DataFrame, fold_col: str, folds: int = 3, label: str = "label", parallelism: int = 3,
    reg=REG_PARAMS, net=ELASTIC_NETS, max_iter: int = 10, repeats: bool = False,
):
    """(metric table, best model) of a grid scored by k folds given as a column.

    ``repeats``: for features of few values; equal rows of a fold are fitted and scored as one row with
    their number as its weight, so that the search costs one pass over the rows, however many they are.
    """

    def parts(rows):
        found = {r[0] for r in rows.select(fold_col).distinct().limit(folds + 1).collect()}
        if found != set(range(folds)):
            raise ValueError(f"{fold_col} must hold each of 0 to {folds - 1} and nothing else")
        for k in range(folds):
            yield rows.where(F.col(fold_col) != k), rows.where(F.col(fold_col) == k)

    learner = estimator("logistic", label=label, maxIter=max_iter)
    if not repeats:
        return _searched(df, learner, reg, net, parallelism, parts)
    combined = df.groupBy(label, "features", fold_col).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT)).persist()
    try:
        few = combined.coalesce(max(1, -(-combined.count() // ROWS_A_TASK)))
        return _searched(few, learner.setWeightCol(WEIGHT), reg, net, parallelism, parts)
    finally:
        combined.unpersist()


def leave_one_group_out(
    df: DataFrame, group: str, label: str = "label", learner=None, max_groups: int = 100
) -> DataFrame:
    """(group, train_auc, test_auc): for each group a model fitted without it.

    One model per group is the scheme itself, so the number of groups is checked. The area
    is null where a part holds one class only.
    """
    spark = df.sparkSession
    groups = [r[0] for r in df.select(group).distinct().limit(max_groups + 1).collect()]
    if len(groups) > max_groups:
        raise ValueError(f"more than {max_groups} groups")
    learner = learner or estimator("logistic", label=label, maxIter=10)
    df = df.persist()
    rows = []
    try:
        for value in sorted(groups, key=str):
            inside = F.col(group).eqNullSafe(F.lit(value))
            model = learner.fit(df.where(~inside))
            scored = model.transform(df).select(
                inside.alias("held"), label, positive_share(F.col("probability")).alias("score")
            ).persist()
            areas = [roc_auc(scored.where(F.col("held") == h), label, "score").first().auc for h in (False, True)]
            scored.unpersist()
            rows.append((None if value is None else str(value), *areas))
    finally:
        df.unpersist()
    return spark.createDataFrame(rows, "group string, train_auc double, test_auc double")


def mean_areas(found: DataFrame) -> DataFrame:
    """One row (groups, train_auc, test_auc): the means over the left-out groups, null areas aside."""
    return found.agg(
        F.count(F.lit(1)).alias("groups"), F.avg("train_auc").alias("train_auc"), F.avg("test_auc").alias("test_auc")
    )

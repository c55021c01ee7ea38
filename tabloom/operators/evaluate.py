"""Model evaluation from (label, score, prediction) columns, aggregated before ordering."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions.columns import safe_ratio
from tabloom.operators.ranking import global_ntile, running_totals


def confusion(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, n)."""
    return scored.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row of class-1 metrics from conditional sums; empty denominators give null."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    count = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("bigint")
    cells = scored.agg(
        count(y & p).alias("tp"), count(~y & ~p).alias("tn"),
        count(~y & p).alias("fp"), count(y & ~p).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    accuracy = safe_ratio(tp + tn, tp + tn + fp + fn)
    return cells.select(
        "tp", "tn", "fp", "fn",
        accuracy.alias("accuracy"),
        (1 - accuracy).alias("misclassification"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_ratio(tn, tn + fp).alias("specificity"),
        safe_ratio(fp, fp + tn).alias("false_positive_rate"),
    )


def thresholds(
    scored: DataFrame, label: str, score: str, digits: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score, best first: counts, running counts, class totals.

    ``digits`` rounds the score first, which bounds the number of thresholds. Rows without a
    label or a score take no part.
    """
    scored = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    value = F.col(score).cast("double")
    value = F.round(value, digits) if digits is not None else value
    grouped = scored.groupBy(*by, value.alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    return running_totals(
        grouped, "threshold", within=by, descending=True, position=None, overall=True,
        sums={"tp": F.col("pos"), "fp": F.col("neg")},
    )


def roc_auc(
    scored: DataFrame, label: str, score: str, digits: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row (auc) per group: the share of positive-negative pairs in the right order.

    Each threshold's positives beat the negatives not yet passed, and tie with its own.
    The area is null where only one class is present.
    """
    points = thresholds(scored, label, score, digits, by)
    won = F.col("pos") * (F.col("fp_all") - F.col("fp") + F.col("neg") * 0.5)
    pairs = F.max(F.col("tp_all").cast("double") * F.col("fp_all"))
    return points.groupBy(*by).agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def _won(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per score, the pairs won among a task's rows, which come by rising value."""
    found = {}
    for batch in batches:
        at, value, pos, neg = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for k in np.unique(at):
            own = at == k
            p, n = pos[own], neg[own]
            lowest, p_before, n_before, won = found.get(k, (value[own][0], 0.0, 0.0, 0.0))
            below = n_before + np.cumsum(n) - n
            found[k] = (lowest, p_before + p.sum(), n_before + n.sum(), won + (p * (below + n / 2)).sum())
    rows = [(int(k), *map(float, v)) for k, v in found.items()]
    kinds = [pa.int32()] + [pa.float64()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)], names=_PART)


_PART = ["at", "lowest", "pos", "neg", "won"]


def roc_areas(scored: DataFrame, label: str, scores: Sequence[Column], weight: Column | None = None) -> list[float]:
    """The exact area under the ROC curve of each of several scores, from one pass over the rows.

    Rows are grouped by score, dealt along it and summed in order; one row a task and score comes back.
    Labels above 0.5 are positive. As in Spark's evaluator, without negatives the area is 1, without positives 0.
    """
    weight = F.lit(1.0) if weight is None else weight
    long = scored.select((F.col(label) > 0.5).alias("y"), weight.alias("w"), F.posexplode(F.array(*scores)).alias("at", "value"))
    counts = long.groupBy("at", "value").agg(
        F.sum(F.when(F.col("y"), F.col("w")).otherwise(0.0)).alias("pos"), F.sum(F.when(F.col("y"), 0.0).otherwise(F.col("w"))).alias("neg")
    )
    dealt = counts.repartitionByRange("at", "value").sortWithinPartitions("at", "value")
    parts = dealt.mapInArrow(_won, "at int, lowest double, pos double, neg double, won double").collect()
    areas = []
    for k in range(len(scores)):
        pos = neg = won = 0.0
        for part in sorted((r for r in parts if r.at == k), key=lambda r: r.lowest):
            won += part.won + part.pos * neg
            pos, neg = pos + part.pos, neg + part.neg
        areas.append(won / (pos * neg) if pos and neg else float(pos > 0))
    return areas


def curve_points(
    scored: DataFrame, label: str, score: str, kind: str = "roc", digits: int | None = None
) -> DataFrame:
    """(threshold, x, y) by falling threshold: ROC (fpr, tpr) or PR (recall, precision).

    As usual the ROC curve is closed with (0, 0) and (1, 1), and the PR curve starts at
    recall 0 with the precision of its first point. Those rows have no threshold.
    """
    if kind not in ("roc", "pr"):
        raise ValueError("kind is 'roc' or 'pr'")
    points = thresholds(scored, label, score, digits)
    tpr = safe_ratio(F.col("tp"), F.col("tp_all"))
    blank = F.lit(None).cast("double").alias("threshold")
    if kind == "roc":
        fpr = safe_ratio(F.col("fp"), F.col("fp_all"))
        curve = points.select("threshold", fpr.alias("x"), tpr.alias("y"))
        end = F.col("id").cast("double")
        ends = scored.sparkSession.range(2).select(blank, end.alias("x"), end.alias("y"))
        return curve.unionByName(ends)
    precision = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    curve = points.select("threshold", tpr.alias("x"), precision.alias("y"))
    first = curve.agg(F.max_by("y", "threshold").alias("y"))
    return curve.unionByName(first.select(blank, F.lit(0.0).alias("x"), "y"))


def pr_auc(
    scored: DataFrame, label: str, score: str, digits: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One row (auc) per group: area under the precision-recall curve by trapezoids.

    The point before a threshold is its running count minus its own count, so no row needs
    its neighbour; before the first point the precision is level.
    """
    points = thresholds(scored, label, score, digits, by)
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    here = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    before = F.coalesce(safe_ratio(tp0, tp0 + fp0), here)
    step = safe_ratio(F.col("pos"), F.col("tp_all"))
    return points.groupBy(*by).agg(F.sum(step * (here + before) / 2).alias("auc"))


def decile_table(
    scored: DataFrame,
    label: str,
    score: str,
    keys: Sequence[str],
    buckets: int = 10,
    signed: bool = True,
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Score buckets, best first, with cumulative class distributions and their spread (%).

    Rows are placed in the score order without a single-task window; everything after the
    one aggregate works on ``buckets`` rows per group. Percentages are unrounded; the
    largest spread is the KS value. The scores are read three times: persist them first if
    they come straight from a model.
    """
    bucketed = global_ntile(
        scored.select(*by, *keys, F.col(label).alias("__y"), F.col(score).cast("double").alias("__s")),
        "__s", keys, buckets, within=by, descending=True, out="decile", slices=slices,
    )
    table = bucketed.groupBy(*by, "decile").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("__y").cast("bigint").alias("target"),
        F.sum(1 - F.col("__y")).cast("bigint").alias("non_target"),
        F.avg("__s").alias("mean_score"),
    )
    group = Window.partitionBy(*by)
    upto = group.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = table.withColumns({
        "cum_target": F.sum("target").over(upto),
        "cum_non_target": F.sum("non_target").over(upto),
        "target_pct": safe_ratio(F.col("target"), F.col("total")) * 100,
    })
    dist = lambda c: safe_ratio(F.col(f"cum_{c}"), F.sum(c).over(group)) * 100
    shares = running.withColumns({"target_dist": dist("target"), "non_target_dist": dist("non_target")})
    spread = F.col("target_dist") - F.col("non_target_dist")
    return shares.withColumn("spread", spread if signed else F.abs(spread))


def ks_value(deciles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return deciles.groupBy(*by).agg(F.max("spread").alias("ks"))


def gains_table(
    scored: DataFrame, label: str, score: str, keys: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Per bucket: population %, actual rate, mean score, cumulative gains %, lift."""
    table = decile_table(scored, label, score, keys, buckets)
    population = F.col("decile") * (100.0 / buckets)
    return table.select(
        population.alias("decile_pct"),
        safe_ratio(F.col("target"), F.col("total")).alias("actual"),
        F.col("mean_score").alias("pred"),
        F.col("target_dist").alias("gains"),
        (F.col("target_dist") / population).alias("lift"),
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str, predictors: int = 1) -> DataFrame:
    """One row (n, mse, rmse, mae, explained_variance, r2, r2_adjusted) from one aggregate.

    Explained variance is the mean squared distance of the predictions from the label mean,
    which is their own variance plus the squared difference of the two means.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = y - p
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.var_pop(p) + F.pow(F.avg(p) - F.avg(y), 2)).alias("explained_variance"),
        F.var_pop(y).alias("label_variance"),
    )
    unexplained = F.try_divide(F.col("mse"), F.col("label_variance"))
    n = F.col("n")
    return sums.select(
        "n", "mse", F.sqrt("mse").alias("rmse"), "mae", "explained_variance",
        (1 - unexplained).alias("r2"),
        (1 - F.try_divide(unexplained * (n - 1), n - predictors - 1)).alias("r2_adjusted"),
    )


def multiclass_accuracy(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return scored.agg(hit.alias("accuracy"), (1 - hit).alias("error"))


def accuracy_sql(scored: DataFrame, label: str, prediction: str, view: str = "scored_rows") -> DataFrame:
    """Accuracy through a temporary view and SQL text."""
    hit: Column = F.when(F.col(label) == F.col(prediction), 1).otherwise(0)
    scored.select(hit.alias("acc")).createOrReplaceTempView(view)
    return scored.sparkSession.sql(f"select sum(acc) / count(1) as accuracy from {view}")


def validation_metrics(
    scored: DataFrame, label: str, score: str, prediction: str, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """(by…, metric, value) with metrics roc, accuracy and ks (rounded to 2 digits).

    All groups, such as models and data sets, are measured in the same passes.
    """
    areas = roc_auc(scored, label, score, by=by)
    hits = scored.groupBy(*by).agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy")
    )
    spreads = ks_value(decile_table(scored, label, score, keys, signed=False, by=by), by)
    long = lambda df, name, value: df.select(*by, F.lit(name).alias("metric"), value.alias("value"))
    return (
        long(areas, "roc", F.col("auc"))
        .unionByName(long(hits, "accuracy", F.col("accuracy")))
        .unionByName(long(spreads, "ks", F.round("ks", 2)))
    )

"""Leaving out one group at a time without fitting each model anew.

One pass sums the moments of each group; the model without a group follows from the moments of all
rows less those of the group. Any number of groups costs one read of the rows and one small solution
per group on the executors. Features are taken from their overall means first, which keeps the differences
of sums exact enough. Moments combine before the shuffle, so a group on a third of the rows is
one row per task. A null group is a group of its own; rows with a null feature or target are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.session import written


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _complete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for name in names:
        condition = condition & _number(name).isNotNull()
    return df.where(condition)


def linear_moments(df: DataFrame, features: Sequence[str], target: str, group: str, centre: Sequence[float]) -> DataFrame:
    """(group, n, moments): the upper triangle of Z'Z, row by row, for Z = (1, features, target) less ``centre``."""
    z = [F.lit(1.0), *[_number(c) - F.lit(m) for c, m in zip([*features, target], centre)]]
    products = [F.sum(z[i] * z[j]) for i in range(len(z)) for j in range(i, len(z))]
    return df.groupBy(F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("n"), F.array(*products).alias("moments"))


def linear_without_groups(df: DataFrame, features: Sequence[str], target: str, group: str) -> DataFrame:
    """(group, n, n_left, intercept, coefficients, rmse): least squares on all rows but the group's, and its error on them.

    Where the rows left do not determine the coefficients, those of the least length are taken; with no
    rows left they are null.
    """
    import numpy as np
    import pyarrow as pa

    rows = _complete(df, [*features, target])
    means = rows.agg(*[F.avg(_number(c)) for c in [*features, target]]).first()
    centre = [0.0 if m is None else float(m) for m in means]
    moments = linear_moments(rows, features, target, group, centre).persist()  # read for the total, then per group
    width = len(features) + 2
    upper = np.triu_indices(width)
    try:
        sums = moments.agg(*[F.sum(F.col("moments")[i]).alias(f"m{i}") for i in range(len(upper[0]))], F.sum("n").alias("n")).first()
        total = np.array([s or 0.0 for s in sums[:-1]])
        kind = moments.schema["group"].dataType.simpleString()

        def square(flat):
            full = np.zeros((width, width))
            full[upper] = flat
            return full + np.triu(full, 1).T

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for n, flat in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    own = square(np.array(flat))
                    left = square(total) - own
                    if left[0, 0] < 0.5:
                        out.append((n, 0, None, None, None))
                        continue
                    beta = np.linalg.lstsq(left[:-1, :-1], left[:-1, -1], rcond=1e-12)[0]
                    error = own[-1, -1] - 2 * beta @ own[:-1, -1] + beta @ own[:-1, :-1] @ beta
                    intercept = beta[0] + centre[-1] - float(np.dot(beta[1:], centre[:-1]))
                    out.append((n, round(left[0, 0]), float(intercept), beta[1:].tolist(), float(np.sqrt(max(error, 0.0) / n))))
                cells = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, k) for c, k in zip(cells, kinds)]],
                    names=["group", "n", "n_left", "intercept", "coefficients", "rmse"],
                )

        schema = f"group {kind}, n long, n_left long, intercept double, coefficients array<double>, rmse double"
        found = moments.mapInArrow(run, schema)
        return written(found, "left-out")
    finally:
        moments.unpersist()


def bayes_without_groups(df: DataFrame, features: Sequence[str], label: str, group: str, smoothing: float = 1.0) -> DataFrame:
    """(group, label, prior, weights): multinomial naive Bayes, as logarithms, of all rows but the group's.

    One row for each group and class of the whole table; a class that only the left-out group holds
    keeps the smoothed share of none.
    """
    rows = _complete(df, features).where(F.col(label).isNotNull())
    sums = [F.sum(_number(c)).alias(f"s{i}") for i, c in enumerate(features)]
    own = rows.groupBy(F.col(group).alias("group"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), *sums)
    own = written(own, "class-sums")
    names = ["n", *[f"s{i}" for i in range(len(features))]]
    total = own.groupBy("label").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
    classes = total.agg(F.collect_list(F.struct("*"))).scalar()  # one row for each class
    pairs = own.select("group").distinct().select("group", F.explode(classes).alias("c")).select("group", "c.*")
    joined = pairs.alias("p").join(own.alias("o"), F.col("p.group").eqNullSafe(F.col("o.group")) & (F.col("p.label") == F.col("o.label")), "left")
    left = joined.select(
        F.col("p.group").alias("group"), F.col("p.label").alias("label"),
        *[(F.col(f"all_{c}") - F.coalesce(F.col(f"o.{c}"), F.lit(0))).alias(c) for c in names],
    )
    by_group = left.groupBy(F.col("group").alias("__g")).agg(F.sum("n").alias("__n"), F.count(F.lit(1)).alias("__classes"))
    left = left.join(by_group, F.col("group").eqNullSafe(F.col("__g")))
    held = sum((F.col(c) for c in names[1:]), F.lit(0.0)) + smoothing * len(features)
    weights = F.array(*[F.log(F.col(c) + smoothing) - F.log(held) for c in names[1:]])
    prior = F.log(F.col("n") + smoothing) - F.log(F.col("__n") + smoothing * F.col("__classes"))
    return left.select("group", "label", prior.alias("prior"), weights.alias("weights"))

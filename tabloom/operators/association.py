"""Association between features and with the target: WOE, correlation, VIF, tests, PSI."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from tabloom.operators.encode import assemble, quantile_binner
from tabloom.operators.ranking import running_totals


def _bin_entries(features: Sequence[str], bins: Mapping[str, Column]) -> Column:
    """Array of (varname, bin, value): text features are their own bin."""
    entries = []
    for name in features:
        numeric = name in bins
        entries.append(
            F.struct(
                F.lit(name).alias("varname"),
                (bins[name] if numeric else F.col(name)).cast("string").alias("bin"),
                (F.col(name) if numeric else F.lit(None)).cast("double").alias("value"),
            )
        )
    return F.array(*entries)


def binned_counts(df: DataFrame, features: Sequence[str], target: str, bins: Mapping[str, Column]) -> DataFrame:
    """(varname, bin, min_value, max_value, count, event) of all features in one aggregate.

    The long rows are combined map-side, so only (features x bins) rows are shuffled.
    """
    long = df.select(F.col(target).alias("__y"), F.inline(_bin_entries(features, bins)))
    return long.groupBy("varname", "bin").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count("__y").alias("count"),
        F.sum("__y").cast("bigint").alias("event"),
    )


def split_bins(df: DataFrame, splits: Mapping[str, Sequence[float]]) -> tuple[DataFrame, dict[str, Column]]:
    """Adds one bin column per split list; values outside or missing get their own bin."""
    if not splits:
        return df, {}
    names = list(splits)
    binned = Bucketizer(
        inputCols=names,
        outputCols=[f"__bin_{n}" for n in names],
        splitsArray=[[float("-inf"), *map(float, splits[n]), float("inf")] for n in names],
        handleInvalid="keep",
    ).transform(df.withColumns({n: F.col(n).cast("double") for n in names}))
    return binned, {n: F.col(f"__bin_{n}").cast("int") for n in names}


def woe_table(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    splits: Mapping[str, Sequence[float]] | None = None,
    quantile_bins: int = 20,
) -> DataFrame:
    """Weight of evidence per feature and bin, with the feature's information value.

    Numeric features use the given inner split points, else equal-frequency bins; those of any
    other type are binned by value. A missing
    category is a bin of its own; a one-class bin has an infinite log ratio, counted as 0.
    """
    splits = dict(splits or {})
    numeric = [f for f in features if isinstance(df.schema[f].dataType, NumericType)]
    work, bins = split_bins(df, {f: splits[f] for f in numeric if f in splits})
    rest = [f for f in numeric if f not in splits]
    if rest:
        work = quantile_binner(work, rest, quantile_bins, suffix="__quantile").transform(work)
        bins |= {f: F.col(f"{f}__quantile").cast("int") for f in rest}
    counts = binned_counts(work, features, target, bins)
    return woe_from_counts(counts)


def woe_from_counts(counts: DataFrame) -> DataFrame:
    """The WOE columns from per-bin counts; works on (features x bins) rows only."""
    per_feature = Window.partitionBy("varname")
    table = counts.withColumn("non_event", F.col("count") - F.col("event"))
    share = lambda c: F.try_divide(F.col(c), F.sum(c).over(per_feature))
    table = table.withColumns(
        {
            "event_rate": F.try_divide(F.col("event"), F.col("count")),
            "nonevent_rate": F.try_divide(F.col("non_event"), F.col("count")),
            "dist_event": share("event"),
            "dist_nonevent": share("non_event"),
        }
    )
    both = (F.col("event") > 0) & (F.col("non_event") > 0)
    table = table.withColumn(
        "woe", F.when(both, F.log(F.col("dist_event") / F.col("dist_nonevent"))).otherwise(0.0)
    )
    part = (F.col("dist_event") - F.col("dist_nonevent")) * F.col("woe")
    return table.withColumn("iv", F.coalesce(F.sum(part).over(per_feature), F.lit(0.0)))


def iv_table(woe: DataFrame) -> DataFrame:
    """Information value per feature, highest first."""
    return woe.groupBy("varname").agg(F.max("iv").alias("iv")).orderBy(F.desc("iv"), "varname")


def monotone_bins(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    max_bins: int = 20,
    rho: float = 1.0,
    micro_bins: int = 1000,
    splits: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Per feature the finest equal-frequency binning whose event rate is monotone.

    The table is scanned once into ``micro_bins`` fine bins per feature. Every bin number
    from ``max_bins`` down to 2 is then built from those aggregated rows, all features at
    once, and the largest one whose |Spearman| of mean value and event rate reaches ``rho``
    is kept (2 bins if none does). Output: one row per (varname, bins, bin).
    """
    splits = dict(splits or {})
    work, bins = split_bins(df, splits)
    rest = [f for f in features if f not in splits]
    if rest:
        fine = quantile_binner(work, rest, micro_bins, 0.1 / micro_bins, suffix="__micro")
        work = fine.transform(work)
        bins |= {f: F.col(f"{f}__micro").cast("int") for f in rest}
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("varname"),
                bins[f].alias("micro"),
                F.col(f).cast("double").alias("value"),
            )
            for f in features
        ]
    )
    micro = (
        work.select(F.col(target).alias("__y"), F.inline(entries))
        .where(F.col("value").isNotNull())
        .groupBy("varname", "micro")
        .agg(
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.sum("value").alias("total"),
            F.count("__y").alias("n"),
            F.sum("__y").cast("bigint").alias("event"),
        )
    )
    # From here on there are at most features x micro_bins x max_bins small rows.
    per_feature = Window.partitionBy("varname")
    upto = per_feature.orderBy("micro").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = micro.withColumns(
        {"upto": F.sum("n").over(upto), "all": F.sum("n").over(per_feature)}
    ).withColumn("bins", F.explode(F.sequence(F.lit(2), F.lit(max_bins))))
    placed = placed.withColumn("bin", F.ceil(F.col("upto") * F.col("bins") / F.col("all")).cast("int"))
    built = placed.groupBy("varname", "bins", "bin").agg(
        F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
        (F.sum("total") / F.sum("n")).alias("mean_value"),
        F.sum("n").alias("count"),
        F.sum("event").alias("event"),
    ).withColumn("event_rate", F.col("event") / F.col("count"))
    trial = Window.partitionBy("varname", "bins")

    def average_rank(column: str) -> Column:
        low = F.rank().over(trial.orderBy(column))
        ties = F.count(F.lit(1)).over(Window.partitionBy("varname", "bins", column))
        return low + (ties - 1) / 2

    ranked = built.withColumns({"rx": average_rank("mean_value"), "ry": average_rank("event_rate")})
    strength = ranked.groupBy("varname", "bins").agg(
        F.coalesce(F.abs(F.corr("rx", "ry")), F.lit(0.0)).alias("rho")
    )
    chosen = (
        strength.groupBy("varname")
        .agg(
            F.coalesce(
                F.max(F.when(F.col("rho") >= rho - 1e-9, F.col("bins"))), F.lit(2)
            ).alias("bins")
        )
        .join(strength, ["varname", "bins"])
    )
    return (
        built.join(chosen, ["varname", "bins"])
        .withColumn("bin", F.row_number().over(trial.orderBy("bin")))
        .select(
            "varname", "bins", "rho", "bin", "min_value", "max_value", "mean_value",
            "count", "event", "event_rate",
        )
    )


def average_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """(value, ascending rank) per distinct value; equal values share the mean of their ranks.

    Ranks are worked out on counted distinct values, so a value shared by many rows is one
    row here; joined back, its rows can be split at run time.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("__c"))
    placed = running_totals(
        counts, column, descending=False, sums={"__cum": F.col("__c")}, position=None
    )
    return placed.select(column, (F.col("__cum") - (F.col("__c") - 1) / 2).alias(out))


def correlation_matrix(
    df: DataFrame, features: Sequence[str], method: str = "pearson", invalid: str = "error"
) -> np.ndarray:
    """Features x features matrix; Spearman is Pearson of the average ranks."""
    if method not in ("pearson", "spearman"):
        raise ValueError("method is 'pearson' or 'spearman'")
    columns = list(features)
    if method == "spearman":
        if invalid == "skip":
            df = df.dropna(subset=columns)
        columns = [f"__rank_{f}" for f in features]
        ranks = [average_ranks(df, f, c) for f, c in zip(features, columns)]
        for feature, table in zip(features, ranks):
            df = df.join(table, feature, "left")
    vectors = assemble(df, columns, invalid=invalid).persist()  # read twice
    try:
        return Correlation.corr(vectors, "features").first()[0].toArray()
    finally:
        vectors.unpersist()


def correlation_pairs(
    df: DataFrame,
    features: Sequence[str],
    method: str = "pearson",
    cutoff: float | None = None,
    invalid: str = "error",
) -> DataFrame:
    """Long matrix (col1, col2, value). With a cutoff: absolute values above it, no diagonal."""
    if cutoff is not None and not 0.0 <= cutoff <= 1.0:
        raise ValueError("cutoff must lie in 0..1")
    matrix = correlation_matrix(df, features, method, invalid)
    rows = [(a, b, float(matrix[i][j])) for i, a in enumerate(features) for j, b in enumerate(features)]
    table = df.sparkSession.createDataFrame(rows, "col1 string, col2 string, value double")
    if cutoff is None:
        return table
    return (
        table.where(F.col("col1") != F.col("col2"))
        .withColumn("value", F.abs("value"))
        .where(F.col("value") > cutoff)
        .orderBy(F.desc("value"), "col1", "col2")
    )


def vif(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, vif): the diagonal of the inverse correlation matrix.

    A constant feature has no inflation (null) and leaves the others as they are without it. A
    feature that the others determine exactly is infinite; the rest are as without that excess.
    """
    spans = df.agg(*[(F.min(f) < F.max(f)).alias(f"s{i}") for i, f in enumerate(features)]).first()
    varying = [f for f, differs in zip(features, spans) if differs]
    found: dict[str, float] = {}
    if varying:
        values, vectors = np.linalg.eigh(correlation_matrix(df, varying))
        free = values < 1e-10 * len(varying)
        inverse = (vectors[:, ~free] ** 2 / values[~free]).sum(axis=1)
        determined = (vectors[:, free] ** 2).sum(axis=1) > 1e-8
        found = {f: float("inf") if d else float(v) for f, d, v in zip(varying, determined, inverse)}
    rows = [(f, found.get(f)) for f in features]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, p_value, degrees_of_freedom, statistic) of independence from the label."""
    names = F.array(*[F.lit(f) for f in features])
    found = ChiSquareTest.test(assemble(df, features, label), "features", label, flatten=True)
    return found.select(
        names[F.col("featureIndex")].alias("feature"),
        F.col("pValue").alias("p_value"),
        F.col("degreesOfFreedom").cast("bigint").alias("degrees_of_freedom"),
        F.col("statistic").alias("statistic"),
    )


def chi_square_counts(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, degrees_of_freedom, statistic) from grouped counts; any number of levels."""
    entries = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level")) for f in features]
    )
    cells = (
        df.select(F.col(label).alias("__y"), F.inline(entries))
        .groupBy("feature", "level", "__y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    levels = cells.groupBy("feature", "level").agg(F.sum("n").alias("r"))
    classes = cells.groupBy("feature", "__y").agg(F.sum("n").alias("c"))
    totals = cells.groupBy("feature").agg(F.sum("n").alias("t"), F.count_distinct("__y").alias("k"))
    # sum over cells of n^2 / (row x column / total), less the total, counts empty cells too
    parts = (
        cells.join(levels, ["feature", "level"])
        .join(classes, ["feature", "__y"])
        .groupBy("feature")
        .agg(F.sum(F.col("n") * F.col("n") / (F.col("r").cast("double") * F.col("c"))).alias("q"))
    )
    rows = levels.groupBy("feature").agg(F.count(F.lit(1)).alias("r"))
    return (
        parts.join(totals, "feature")
        .join(rows, "feature")
        .select(
            "feature",
            ((F.col("r") - 1) * (F.col("k") - 1)).alias("degrees_of_freedom"),
            (F.col("t") * (F.col("q") - 1)).alias("statistic"),
        )
    )


def ks_normal(df: DataFrame, column: str, mean: float = 0.0, sd: float = 1.0) -> DataFrame:
    """(p_value, statistic) of a one-sample Kolmogorov-Smirnov test against a normal law."""
    found = KolmogorovSmirnovTest.test(df.select(F.col(column).cast("double").alias("x")), "x", "norm", mean, sd)
    return found.select(F.col("pValue").alias("p_value"), F.col("statistic").alias("statistic"))


def population_stability(
    expected: DataFrame, actual: DataFrame, bucket: str, floor: float = 1e-6
) -> DataFrame:
    """Per bucket the two shares and (a - e) ln(a / e); empty shares are floored."""
    both = (
        expected.select(F.col(bucket).alias("bucket"), F.lit(1).alias("e"), F.lit(0).alias("a"))
        .unionByName(actual.select(F.col(bucket).alias("bucket"), F.lit(0).alias("e"), F.lit(1).alias("a")))
        .groupBy("bucket")
        .agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    )
    everything = Window.partitionBy()  # one row per bucket
    share = lambda c: F.greatest(F.try_divide(F.col(c), F.sum(c).over(everything)), F.lit(floor))
    return both.select(
        "bucket", share("e").alias("expected"), share("a").alias("actual")
    ).withColumn(
        "psi", (F.col("actual") - F.col("expected")) * F.log(F.col("actual") / F.col("expected"))
    )

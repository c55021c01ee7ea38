"""One-pass profiles: missing values, cardinality, moments, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FloatType, DoubleType, NumericType, StringType

from tabloom.functions.missing import is_missing, quoted


def _distinct_text(df: DataFrame, column: str) -> Column:
    """Text that is equal for equal values; 0.0 and -0.0 are one value."""
    value = quoted(column)
    floating = isinstance(df.schema[column].dataType, (FloatType, DoubleType))
    return (value + F.lit(0.0) if floating else value).cast("string")


def _stack(row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turns a one-row wide aggregate ``<field>__<column>`` into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{c}").cast(t).alias(f) for f, t in fields.items()])
        for c in columns
    ]
    return row.select(F.inline(F.array(*entries)))


def missing_profile(
    df: DataFrame, columns: Sequence[str] | None = None, **reading: bool
) -> DataFrame:
    """(column, missing, share) from one conditional count per column."""
    columns = list(columns or df.columns)
    counts = df.agg(
        *[F.count(F.when(is_missing(df, c, **reading), 1)).alias(f"missing__{c}") for c in columns],
        F.count(F.lit(1)).alias("rows"),
    )
    share = {f"share__{c}": F.try_divide(F.col(f"missing__{c}"), F.col("rows")) for c in columns}
    return _stack(counts.withColumns(share), columns, {"missing": "bigint", "share": "double"})


def select_by_missing(profile: DataFrame, threshold: float, mode: str = "keep") -> DataFrame:
    """Columns to keep (share <= threshold) or to drop (share >= threshold)."""
    if mode not in ("keep", "drop"):
        raise ValueError("mode is 'keep' or 'drop'")
    share = F.col("share")
    return profile.where(share <= threshold if mode == "keep" else share >= threshold)


def cardinality_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    cutoff: int = 1,
    exact: bool = False,
    rsd: float = 0.05,
) -> DataFrame:
    """(column, distinct, constant); constant means at most ``cutoff`` distinct values.

    The sketch form is one aggregate. The exact form counts distinct (column, text) pairs,
    which combines before the shuffle and spreads every column over all tasks.
    """
    columns = list(columns or df.columns)
    if exact:
        pairs = df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("column"), _distinct_text(df, c).alias("v"))
                        for c in columns
                    ]
                )
            )
        )
        table = (
            pairs.distinct()
            .groupBy("column")
            .agg(F.count("v").cast("bigint").alias("distinct"))
        )
    else:
        row = df.agg(*[F.approx_count_distinct(quoted(c), rsd).alias(f"distinct__{c}") for c in columns])
        table = _stack(row, columns, {"distinct": "bigint"})
    return table.withColumn("constant", F.col("distinct") <= cutoff)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, mean, sd, min, max), typed, in one aggregate."""
    measures = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(
        *[fn(quoted(c).cast("double")).alias(f"{m}__{c}") for c in columns for m, fn in measures.items()]
    )
    return _stack(row, columns, {m: "bigint" if m == "n" else "double" for m in measures})


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False, **reading: bool
) -> DataFrame:
    """One row per column: type class, rows, missing, distinct, mean, sd, min, max."""
    columns = list(columns or df.columns)
    aggs: list[Column] = []
    for c in columns:
        numeric = isinstance(df.schema[c].dataType, NumericType)
        value = quoted(c).cast("double") if numeric else F.lit(None).cast("double")
        if isinstance(df.schema[c].dataType, (FloatType, DoubleType)):
            value = F.nanvl(value, F.lit(None).cast("double"))
        kind = "numeric" if numeric else "text" if isinstance(df.schema[c].dataType, StringType) else "other"
        aggs += [
            F.max(F.lit(kind)).alias(f"kind__{c}"),
            F.count(F.lit(1)).alias(f"rows__{c}"),
            F.count(F.when(is_missing(df, c, **reading), 1)).alias(f"missing__{c}"),
            F.approx_count_distinct(quoted(c)).alias(f"distinct__{c}"),
            F.avg(value).alias(f"mean__{c}"),
            F.stddev_samp(value).alias(f"sd__{c}"),
            F.min(value).alias(f"min__{c}"),
            F.max(value).alias(f"max__{c}"),
        ]
    fields = {
        "kind": "string", "rows": "bigint", "missing": "bigint", "distinct": "bigint",
        "mean": "double", "sd": "double", "min": "double", "max": "double",
    }
    table = _stack(df.agg(*aggs), columns, fields)
    if not exact:
        return table
    exact_counts = cardinality_profile(df, columns, exact=True).select("column", "distinct")
    return table.drop("distinct").join(F.broadcast(exact_counts), "column")  # one row per column


def frequency(df: DataFrame, columns: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(out))


def frequent_values(df: DataFrame, column: str, above: int, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values seen more than ``above`` times; ties by value."""
    return (
        frequency(df, [column])
        .where(F.col("n") > above)
        .orderBy(F.desc("n"), F.asc(column))
        .limit(k)
    )


def spread_by_deviation(df: DataFrame, column: str) -> DataFrame:
    """Sum of squared deviations, variance and standard deviation from a global mean."""
    marked = with_deviation(df, column)
    total = F.sum("squared_deviation")
    variance = F.try_divide(total, F.count(column) - 1)
    return marked.agg(
        total.alias("sum_squared"), variance.alias("variance"), F.sqrt(variance).alias("sd")
    )


def with_deviation(df: DataFrame, column: str) -> DataFrame:
    """Adds the global mean and the squared deviation; the mean is a scalar subquery."""
    mean = df.agg(F.avg(column).alias("m")).scalar()
    return df.withColumn(f"mean_{column}", mean).withColumn(
        "squared_deviation", F.pow(F.col(column) - F.col(f"mean_{column}"), 2)
    )


def approx_median(df: DataFrame, column: str, relative_error: float = 0.001) -> DataFrame:
    """Median within a rank error, with missing values and zeros left out."""
    present = df.where(~is_missing(df, column) & (quoted(column) != 0))
    return present.agg(
        F.percentile_approx(column, 0.5, max(1, round(1 / relative_error))).alias("median"),
        F.count(F.lit(1)).alias("n"),
    )


def distinct_counts(df: DataFrame, column: str, groups: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*groups).agg(F.count_distinct(column).alias("distinct"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key set, the first in the given order; trimmed before the shuffle."""
    from tabloom.operators.ranking import top_per_group

    return top_per_group(df, keys, order, 1, "__first").drop("__first")


def collect_counted(df: DataFrame, groups: Sequence[str], value: str, out: str = "items") -> DataFrame:
    """Per group the sorted array of (value, times), the collected list in counted form.

    Counting first keeps a hot group as small as its number of distinct values.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("times")
    )
    return counted.groupBy(*groups).agg(
        F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), "times"))).alias(out)
    )


def expand_counted(items: Column) -> Column:
    """The plain sorted list behind a counted one, repeats included."""
    return F.flatten(F.transform(items, lambda s: F.array_repeat(s["value"], s["times"].cast("int"))))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, frequency): equal-width bins, last one closed, empty bins kept."""
    present = df.where(~is_missing(df, column)).select(quoted(column).cast("double").alias("x"))
    span = present.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()  # one row
    if span.lo is None:
        return present.sparkSession.createDataFrame([], "bin int, low double, high double, frequency bigint")
    if span.lo == span.hi:
        bins = 1
    width = (span.hi - span.lo) / bins
    place = F.least(F.floor((F.col("x") - span.lo) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = present.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        frame.join(F.broadcast(counts), "bin", "left")  # at most one row per bin
        .select(
            "bin",
            (F.lit(span.lo) + F.col("bin") * width).alias("low"),
            F.when(F.col("bin") == bins - 1, span.hi)
            .otherwise(F.lit(span.lo) + (F.col("bin") + 1) * width)
            .alias("high"),
            F.coalesce("n", F.lit(0)).alias("frequency"),
        )
    )


def share_of_total(df: DataFrame, groups: Sequence[str], measure: Column, out: str = "share") -> DataFrame:
    """Group totals and their share of the overall total."""
    total = df.agg(F.sum(measure).alias("t")).scalar()
    return (
        df.groupBy(*groups)
        .agg(F.sum(measure).alias("total"))
        .withColumn("__all", total)
        .withColumn(out, F.try_divide(F.col("total"), F.col("__all")))
        .drop("__all")
    )

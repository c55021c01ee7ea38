"""Samples and splits, seeded or reproducible by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions.columns import hash_bucket
from tabloom.session import written

GRAIN = 1 << 32  # all values of the 32-bit hash, so that no fraction is too small


def sample(df: DataFrame, fraction: float, seed: int, replace: bool = False) -> DataFrame:
    """Simple random sample. The rows drawn depend on the seed and on the partitioning."""
    return df.sample(replace, fraction, seed)


def sample_strata(df: DataFrame, column: str, fractions: Mapping, seed: int) -> DataFrame:
    """Independent sample per stratum; a stratum without a fraction is left out."""
    return df.sampleBy(column, dict(fractions), seed)


def sample_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    fraction: float | Mapping,
    *,
    strata: str | None = None,
    seed: str = "",
) -> DataFrame:
    """Reproducible sample: a row stays if its key's hash bucket is below the fraction."""
    bucket = hash_bucket(_keys(key), GRAIN, seed)
    if strata is None:
        return df.where(bucket < round(float(fraction) * GRAIN))
    limit = F.lit(0)
    for level, share in fraction.items():
        limit = F.when(F.col(strata) == level, round(share * GRAIN)).otherwise(limit)
    return df.where(bucket < limit)


def sample_exact(
    df: DataFrame, key: str | Sequence[str], size: int | Mapping, *, strata: str | None = None, seed: str = ""
) -> DataFrame:
    """Exactly ``size`` rows, or all if there are fewer, of the table or of each stratum.

    The rows are those with the least key hash, equal hashes by key, so a sample of the union of samples
    of parts is the sample of the whole. With a mapping, a stratum without a size is left out; a
    missing stratum is one of its own. The key should name a row; of rows with an equal key
    at the border any may be taken.

    Rows are counted by stratum and slice of the hash. Slices below the border are taken whole, and
    only the one slice per stratum in which the border lies is ordered: no stratum meets in one task.
    """
    stratum = F.lit(0) if strata is None else F.col(strata)
    if isinstance(size, Mapping):
        wanted = F.lit(0)
        for level, n in size.items():
            wanted = F.when(F.col("__stratum").eqNullSafe(F.lit(level)), n).otherwise(wanted)
    else:
        wanted = F.lit(size)
    place = hash_bucket(_keys(key), GRAIN, seed)
    marked = df.select(df["*"], stratum.alias("__stratum"), place.alias("__place"))
    marked = marked.withColumn("__slice", F.shiftright("__place", 16))
    counts = marked.groupBy("__stratum", "__slice").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("__stratum").orderBy("__slice")  # 65,536 counts at most
    reached = counts.withColumn("__before", F.sum("n").over(upto) - F.col("n")).withColumn("__wanted", wanted)
    border = reached.where(F.col("__before") < F.col("__wanted")).groupBy("__stratum").agg(
        F.max(F.struct("__slice", "__before", "__wanted")).alias("__last")
    ).withColumnRenamed("__stratum", "__own")
    border = written(border, "sample-borders")  # a row per stratum, of known size
    joined = marked.join(border, F.col("__stratum").eqNullSafe(F.col("__own")))
    sure = joined.where(F.col("__slice") < F.col("__last.__slice"))
    order = Window.partitionBy("__stratum").orderBy("__place", *_keys(key))
    edge = joined.where(F.col("__slice") == F.col("__last.__slice")).withColumn("__number", F.row_number().over(order))
    edge = edge.where(F.col("__number") <= F.col("__last.__wanted") - F.col("__last.__before"))
    return sure.select(*df.columns).unionByName(edge.select(*df.columns))


def _keys(key: str | Sequence[str]) -> list[Column]:
    return [F.col(k) for k in ([key] if isinstance(key, str) else key)]


def part_of(
    names: Sequence[str],
    weights: Sequence[float],
    key: str | Sequence[str],
    *,
    seed: str = "",
    strata: str | None = None,
) -> Column:
    """Name of the part a row falls in, by hash of its key (within its stratum if given)."""
    keys = _keys(key) + ([F.col(strata)] if strata else [])
    bucket = hash_bucket(keys, GRAIN, seed)
    total, reached, expr = sum(weights), 0.0, None
    for name, weight in list(zip(names, weights))[:-1]:
        reached += weight
        test = bucket < round(reached / total * GRAIN)
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return F.lit(names[-1]) if expr is None else expr.otherwise(names[-1])


def split(
    df: DataFrame,
    weights: Sequence[float],
    seed: int,
    key: str | Sequence[str] | None = None,
    strata: str | None = None,
) -> list[DataFrame]:
    """Disjoint parts by weight. With a key the parts are the same on every run and cluster."""
    if key is None:
        if strata is not None:
            raise ValueError("a stratified split needs a key")
        return df.randomSplit(list(weights), seed)
    names = [str(i) for i in range(len(weights))]
    marked = df.withColumn("__part", part_of(names, weights, key, seed=str(seed), strata=strata))
    return [marked.where(F.col("__part") == name).drop("__part") for name in names]


def fold_of(key: str | Sequence[str], folds: int, seed: str = "") -> Column:
    """Fold number 0..folds-1 by hash of the key."""
    return hash_bucket(_keys(key), folds, seed).cast("int")


def with_normal(df: DataFrame, mean: float, sd: float, seed: int, out: str) -> DataFrame:
    """Adds a normally distributed column: standard normal draws, then an affine map."""
    return df.withColumn(out, F.randn(seed) * sd + mean)


def normal_values(spark, n: int, partitions: int, mean: float = 0.0, sd: float = 1.0, seed: int = 0):
    """``n`` normal values spread over ``partitions`` tasks."""
    return with_normal(spark.range(0, n, 1, partitions), mean, sd, seed, "value").drop("id")

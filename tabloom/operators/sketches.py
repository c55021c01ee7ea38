"""Sketches kept as binary columns: made per part, merged later over any parts without reading the rows again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LG_K = 12  # 2^12 registers: a standard error of about 1.04 / 64


def distinct_error(lg_k: int = LG_K) -> float:
    """The standard error of a count of distinct values, as a share of it."""
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, parts: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(parts, one sketch per column): a few kilobytes for each part, however many rows it has."""
    texts = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in columns]
    return df.groupBy(*parts).agg(*texts)


def merged_distinct(sketches: DataFrame, columns: Sequence[str], parts: Sequence[str] = ()) -> DataFrame:
    """Estimated numbers of distinct values over the merged sketches of each of ``parts``, or of all."""
    return sketches.groupBy(*parts).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def quantile_sketches(df: DataFrame, parts: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(parts, one KLL sketch of doubles per column)."""
    return df.groupBy(*parts).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(c) for c in columns])


def merged_quantiles(sketches: DataFrame, columns: Sequence[str], quantile: float, parts: Sequence[str] = ()) -> DataFrame:
    """A value near the quantile of each column over the merged sketches."""
    merge = lambda c: F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(c), F.lit(quantile))
    return sketches.groupBy(*parts).agg(*[merge(c).alias(c) for c in columns])

"""Equi-joins with unique output names, checked broadcasts and hot-key-safe outer joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 200_000


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks ``df`` for broadcast only if it has at most ``max_rows`` rows.

    Beyond the bound the frame is returned unmarked, so the join shuffles and adaptive
    execution splits skewed partitions.
    """
    fits = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if fits else df


def equi_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join on one key pair, both keys kept, for sides whose column names differ.

    Adaptive execution can split a hot key on the preserved side only. In a right or full
    join the hot rows may be on the left, so these are built as the skew-safe join of the
    matching rows plus the right rows whose key does not occur on the left; that test uses
    the distinct left keys, which are combined before the shuffle.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"rename columns present on both sides first: {sorted(shared)}")
    condition = F.col(left_key) == F.col(right_key)
    if how not in ("right", "full"):
        return left.join(right, condition, how)
    matched = left.join(right, condition, "inner" if how == "right" else "left")
    left_keys = left.select(F.col(left_key).alias("__key")).distinct()
    unmatched = right.join(left_keys, F.col(right_key) == F.col("__key"), "left_anti")
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    return matched.unionByName(unmatched.select(*blanks, *right.columns))


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Values of ``key`` on more than ``share`` of the rows; fewer than 1 / share reach the driver."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    least = df.agg(F.count(F.lit(1)) * share).scalar()
    return [r[0] for r in counts.where(F.col("n") > least).select(key).collect()]


def salted_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
    share: float = 0.01, salts: int = 32,
) -> DataFrame:
    """``equi_join`` for keys that many rows of both sides share.

    Keys on more than ``share`` of the rows of both sides are joined apart: the left rows are dealt to
    ``salts`` parts, the right rows are copied to each, so that no task gets such a key whole. As they
    are on both sides, each of their rows has a match whatever ``how``; all other rows are joined as
    ever. A row's part is a function of its values and of the input partition it was read from,
    so that equal rows spread too and a lost task deals them alike.
    """
    hot = sorted(set(hot_keys(left, left_key, share)) & set(hot_keys(right, right_key, share)))
    if not hot:
        return equi_join(left, right, left_key, right_key, how)
    at_left, at_right = F.coalesce(F.col(left_key).isin(hot), F.lit(False)), F.coalesce(F.col(right_key).isin(hot), F.lit(False))
    others = equi_join(left.where(~at_left), right.where(~at_right), left_key, right_key, how)
    part = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
    dealt = left.where(at_left).withColumn("__part", part)
    copied = right.where(at_right).withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = dealt.join(copied, (F.col(left_key) == F.col(right_key)) & (F.col("__part") == F.col("__copy")))
    return others.unionByName(met.drop("__part", "__copy"))


def join_totals(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
    sums: Sequence[str] = (), **salted,
) -> DataFrame:
    """(left_key, right_key, n, sums…): rows of the ``salted_join`` by its two keys, and totals of columns of either side.

    A key on m rows of one side and n of the other has m x n joined rows. Those are not made: each side is
    combined to one row a key first, and a pair's totals are those of its side times the rows of the other.
    """

    def combined(df: DataFrame, key: str, rows: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias(rows), *[F.sum(c).alias(c) for c in sums if c in df.columns])

    sides = combined(left, left_key, "__left_rows"), combined(right, right_key, "__right_rows")
    joined = salted_join(*sides, left_key, right_key, how, **salted)
    n_left, n_right = (F.coalesce(c, F.lit(1)) for c in ("__left_rows", "__right_rows"))
    totals = [F.sum(F.col(c) * (n_right if c in left.columns else n_left)).alias(c) for c in sums]
    # Rows without a key are left over on both sides, as one pair of nulls.
    return joined.groupBy(left_key, right_key).agg(F.sum(n_left * n_right).alias("n"), *totals)


def attach_target(features: DataFrame, target: DataFrame, on: str | list[str]) -> DataFrame:
    """Puts the target beside its features by a real key; position is never used."""
    return features.join(target, on, "inner")

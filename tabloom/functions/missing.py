"""Missing-value tests that respect the column's type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def is_missing(df: DataFrame, name: str, nan: bool = True, empty: bool = False) -> Column:
    """Null always counts; NaN and the empty string count on request.

    A NaN test is only legal on floating columns and an emptiness test only on text, so
    the test is chosen from the schema. Text holding the word NaN counts as NaN.
    """
    column = quoted(name)
    dtype = df.schema[name].dataType
    tests = [column.isNull()]
    if nan and isinstance(dtype, (FloatType, DoubleType)):
        tests.append(F.isnan(column))
    if nan and isinstance(dtype, StringType):
        tests.append(F.lower(F.trim(column)) == "nan")
    if empty and isinstance(dtype, StringType):
        tests.append(column == "")
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(True))


def filter_missing(df: DataFrame, name: str, keep: bool = False, **reading: bool) -> DataFrame:
    """Rows whose value is present; with ``keep`` the rows whose value is missing."""
    test = is_missing(df, name, **reading)
    return df.where(test if keep else ~test)


def require_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(quoted(target).isNotNull())

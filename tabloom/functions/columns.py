"""Column-level helpers: typing, labels, numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType


def split_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(text columns, numeric columns) read from the schema; other types are in neither."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    text = [f.name for f in fields if isinstance(f.dataType, StringType)]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    return text, numeric


def cast_columns(df: DataFrame, casts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Cast lists of columns per type name; text that does not parse becomes null."""
    wanted = {name: dtype for dtype, names in casts.items() for name in names}
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in wanted.items()})


def band(column: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first bound the value is below; null falls to ``otherwise``."""
    (first_bound, first_label), *rest = bounds
    expr = F.when(column < first_bound, first_label)
    for bound, label in rest:
        expr = expr.when(column < bound, label)
    return expr.otherwise(otherwise)


def encode_target(column: Column, positive) -> Column:
    """1 for the positive value, 0 for anything else."""
    return F.when(column == positive, 1).otherwise(0)


def rounded(column: Column, digits: int) -> Column:
    """Rounded double without a negative zero."""
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is null where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def positive_share(vector: Column) -> Column:
    """Class-1 probability from a probability vector, evaluated in the JVM."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(vector)[1]


def hash_bucket(key: Column | Sequence[Column], buckets: int = 100, salt: str = "") -> Column:
    """Reproducible bucket 0..buckets-1 from the md5 of the key, independent of partitioning."""
    parts = list(key) if isinstance(key, (list, tuple)) else [key]
    text = F.concat_ws("|", *([F.lit(salt)] if salt else []), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets

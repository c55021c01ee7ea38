"""What the operators of this subpackage share: tables, scratch tables, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import scratch_path

# Bytes that end a word when words are runs of letters and digits (ASCII) or any other character.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs start from its files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the frame has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key's text modulo ``parts``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def bounded_sample(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """About ``limit`` rows, all if fewer, chosen by a hash of the keys, so that a rerun takes the same.

    Rows with equal keys stay or go together; the expected number is ``limit``.
    """
    total = rows.count()
    if total <= limit:
        return rows
    part = F.pmod(F.xxhash64(F.lit(11), *[F.col(k) for k in keys]), F.lit(1 << 30))
    return rows.filter(part < F.lit(int(limit / total * (1 << 30))))

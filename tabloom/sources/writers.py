"""Writing delimited text, JSON, catalog tables and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    max_records: int | None = None,
) -> str:
    """One file per task unless ``single_file`` is asked for, which uses one task."""
    frame = df.coalesce(1) if single_file else df
    writer = frame.write.mode(mode).option("sep", sep).option("header", header)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def write_records(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> str:
    df.write.mode(mode).json(path, compression=compression)
    return path


def record_text(df: DataFrame, out: str = "record") -> DataFrame:
    """Each row as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> str:
    """A managed table dealt into buckets by the keys and sorted in them, so that joins on the keys of
    tables with as many buckets need no exchange."""
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)

"""JSON records that may not be readable: good rows on one side, rejects with text and reason on the other.

Nothing is lost in silence: every line is a good row or a reject. A line is rejected when it is no JSON
object ("not a record") or when a field does not fit its type ("wrong type"); an object without some of
the fields is good, with nulls. Works on batches and on streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

_BROKEN = "__broken"


def judged(lines: DataFrame, schema: StructType | str, text: str = "value") -> DataFrame:
    """The lines with ``record`` (null if rejected) and ``reason`` (null if good)."""
    fields = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = StructType([*fields.fields, StructField(_BROKEN, StringType())])
    parsed = F.from_json(F.col(text), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    rows = lines.withColumn(_BROKEN, parsed)
    # Only an object has keys; a line of blanks, a list or a cut-off object has none.
    is_record = F.json_object_keys(text).isNotNull()
    reason = F.when(~is_record | F.col(_BROKEN).isNull(), "not a record").when(F.col(f"{_BROKEN}.{_BROKEN}").isNotNull(), "wrong type")
    rows = rows.withColumn("reason", reason)
    record = F.struct(*[F.col(f"{_BROKEN}.`{f.name}`").alias(f.name) for f in fields])
    return rows.withColumn("record", F.when(F.col("reason").isNull(), record)).drop(_BROKEN)


def split_records(lines: DataFrame, schema: StructType | str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows with the schema's columns, rejects as (text, reason))."""
    rows = judged(lines, schema, text)
    good = rows.where(F.col("reason").isNull()).select("record.*")
    return good, rows.where(F.col("reason").isNotNull()).select(F.col(text).alias("text"), "reason")


def read_checked(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a folder of JSON lines."""
    return split_records(spark.read.text(path), schema)


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def split_stream(
    lines: DataFrame, schema: StructType | str, good: str, rejects: str, checkpoint: str,
    work: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> StreamingQuery:
    """Writes ``work`` of the good rows and the rejects of all lines present, each exactly once.

    Both sides of a batch go to a folder named by the batch, which a repeated batch overwrites: a query
    that stopped between the two writes, or before its checkpoint, leaves no row twice. ``work`` may score.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows, bad = split_records(batch, schema)
        work(rows).write.mode("overwrite").parquet(f"{good}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

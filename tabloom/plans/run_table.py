"""A table of runs that can be asked: written once per run, compared over all of them.

A run is one partition. Writing a run again replaces its partition, and Spark moves files into the
table only when the job that writes them commits, so a run that fails leaves the table as it was.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.plans.automodel import select_champion

SCHEMA = "parameters string, model string, dataset string, metric string, value double, run_id string"


def record_run(path: str, run_id: str, parameters: Mapping, metrics: DataFrame) -> str:
    """Writes (model, dataset, metric, value) as the rows of one run, in place of those it had; a run needs a row.

    A missing or empty run id is refused: partitions could not tell it apart.
    """
    if not run_id:
        raise ValueError("a run needs an id")
    if metrics.isEmpty():
        raise ValueError(f"run {run_id} has no metrics")
    rows = metrics.select(
        F.lit(json.dumps(dict(parameters), sort_keys=True, default=str)).alias("parameters"),
        "model", "dataset", "metric", F.col("value").cast("double").alias("value"), F.lit(run_id).alias("run_id"),
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
    return run_id


def runs(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the table, none if no run was written yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def parameter(name: str) -> Column:
    """A parameter of a run as text; null if the run has none of this name."""
    return F.get_json_object("parameters", f"$['{name}']")


def compare_runs(rows: DataFrame, first: str, second: str) -> DataFrame:
    """(model, dataset, metric, first, second, change) for everything that either of two runs measured."""
    side = lambda run_id, name: rows.where(F.col("run_id") == run_id).select("model", "dataset", "metric", F.col("value").alias(name))
    both = side(first, "first").join(side(second, "second"), ["model", "dataset", "metric"], "full")
    return both.withColumn("change", F.col("second") - F.col("first"))


def champion_of_runs(rows: DataFrame, criterion: str = "ks", dataset: str = "train", tolerance: float = 0.03) -> DataFrame:
    """``select_champion`` over the models of all runs: (run_id, model, chosen, counter, place, selected)."""
    named = rows.withColumn("model", F.to_json(F.struct("run_id", "model")))
    placed = select_champion(named, criterion, dataset, tolerance)
    own = F.from_json("model", "run_id string, model string")
    return placed.select(own["run_id"].alias("run_id"), own["model"].alias("model"), "chosen", "counter", "place", "selected")

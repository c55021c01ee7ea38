"""A training-data pipeline over ``documents`` in five stages, each one of the operators of ``tabloom.llm``.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet to the shared
folder and reread as the next stage's documents. All stages but the last return the columns of
``documents``. An empty table passes through all stages; columns beyond those of ``documents`` are
carried along, and packed pieces hold ids and places only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import decontaminate, language, line_dedup, packing, simhash
from tabloom.llm.common import fold, stored, table
from tabloom.llm.token_ids import default_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters or without a clear language go."""
    model = language.fit(language.learned_rows(docs, "doc_id", fold(F.col("doc_id"), 4) == 2))
    return language.keep_identified(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of at least 40 characters in at least 5 documents stay in one of them.

    A document that loses all of its lines goes; ``n_chars`` follows the shorter text.
    """
    kept = line_dedup.drop_shared_lines(docs)
    kept = kept.filter((F.col("n_dropped") == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies, the document with the smallest id stays."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold any window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), max_share=0.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of at most 1024 tokens."""
    return packing.pack(packing.pieces(docs, default_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

# Language models, fingerprints and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

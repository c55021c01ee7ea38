"""Dictionaries of labels and terms as tables: numbered, joined and turned into vectors on the executors.

``StringIndexer`` and ``CountVectorizer`` keep their lists on the driver. Here labels are counted, put
in order by ``ranking.numbered`` and written as a table of (label, n, index); values meet their numbers
by a join, and sparse vectors are gathered per row. No step depends on the number of labels; the
``HOT_LABELS`` most frequent ones, which could hold most rows, are broadcast and joined in place, and
only the other rows are shuffled.

A null is no label. Values without a number get one more than the last, as ``StringIndexer`` gives with
``handleInvalid="keep"``. Labels differ by their bytes.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tabloom.operators.ranking import numbered
from tabloom.session import scratch_path, written

HOT_LABELS = 1_000


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """(label, n, index) of a column: numbered from 0 by falling count, ties by label, in a written table."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return written(numbered(counts, [F.col("n").desc(), F.col("label")], "index"), "labels")


def fit_terms(counted: DataFrame, min_documents: int, size: int | None) -> DataFrame:
    """(label, n, df, index) of terms, from (document, term, tf) rows: terms in at least ``min_documents``
    documents, by falling count, ties by term; the first ``size``, or all for None."""
    counts = counted.groupBy(F.col("term").alias("label")).agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    counts = counts.where(F.col("df") >= min_documents)
    placed = numbered(counts, [F.col("n").desc(), F.col("label")], "index")
    return written(placed if size is None else placed.where(F.col("index") < size), "terms")


def look_up(df: DataFrame, column: str, dictionary: DataFrame, hot_labels: int = HOT_LABELS) -> tuple[DataFrame, str]:
    """(rows with ``__entry``: the dictionary's row of their value or null, that name).

    ``df`` is read twice, so it should start from a table.
    """
    entry = F.struct(*[c for c in dictionary.columns if c != "label"])
    table = dictionary.select(F.col("label").alias("__label"), entry.alias("__entry"))
    hot = F.broadcast(table.where(F.col("__entry.index") < hot_labels))  # at most hot_labels rows
    same = F.col(column).cast("string") == F.col("__label")
    met = df.join(hot, same)
    others = df.join(hot, same, "left_anti").join(table.where(F.col("__entry.index") >= hot_labels), same, "left")
    return met.unionByName(others).drop("__label"), "__entry"


def encode_labels(df: DataFrame, column: str, dictionary: DataFrame, out: str | None = None, hot_labels: int = HOT_LABELS) -> DataFrame:
    """The frame with the number of each value as a double; unknown and missing values share the next number."""
    size = dictionary.agg(F.count(F.lit(1))).scalar()
    rows, entry = look_up(df, column, dictionary, hot_labels)
    number = F.coalesce(F.col(f"{entry}.index"), size).cast("double")
    return rows.withColumn(out or f"{column}_index", number).drop(entry)


def counted_terms(tokens: DataFrame, key: str, column: str) -> DataFrame:
    """(key, term, tf) in a written table; ``key`` tells documents apart."""
    rows = tokens.select(F.col(key), F.explode(column).alias("term"))
    return written(rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")), "counted-terms")


def sparse_vectors(entries: DataFrame, key: str, index: str, values: dict[str, Column], size: int) -> DataFrame:
    """(key, one sparse vector per name in ``values``) from rows of one entry each; indexes differ within a key.

    The vectors are written as their four parts and read back as vectors, so that no row leaves the JVM.
    """
    if size >= 1 << 31:
        raise ValueError("a vector has fewer than 2^31 places")
    listed = entries.select(key, F.struct(F.col(index).cast("int").alias("i"), *[v.cast("double").alias(n) for n, v in values.items()]).alias("e"))
    grouped = listed.groupBy(key).agg(F.array_sort(F.collect_list("e")).alias("e"))  # a document's own terms

    def vector(name: str) -> Column:
        return F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
            F.col("e.i").alias("indices"), F.col(f"e.{name}").alias("values"),
        ).alias(name)

    spark, path = entries.sparkSession, scratch_path(entries.sparkSession, "vectors")
    grouped.select(key, *[vector(n) for n in values]).write.parquet(path)
    schema = StructType([grouped.schema[key], *[StructField(n, VectorUDT()) for n in values]])
    return spark.read.schema(schema).parquet(path)


def term_vectors(
    tokens: DataFrame, key: str, column: str, min_documents: int, size: int | None = None, hot_labels: int = HOT_LABELS
) -> tuple[DataFrame, DataFrame]:
    """(vectors, terms): per document with a kept term, ``raw_features`` (counts) and ``features`` (counts
    times ln((documents + 1) / (df + 1))) as sparse vectors over the places of ``terms``."""
    counted = counted_terms(tokens, key, column)
    terms = fit_terms(counted, min_documents, size)
    documents = tokens.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows, entry = look_up(counted, "term", terms, hot_labels)
    rows = rows.where(F.col(entry).isNotNull()).withColumn("__n", documents)
    weight = F.col("tf") * F.log((F.col("__n") + 1) / (F.col(f"{entry}.df") + 1))
    vectors = sparse_vectors(rows, key, f"{entry}.index", {"raw_features": F.col("tf"), "features": weight}, max(1, terms.count()))
    return vectors, terms


def name_topics(model, terms: DataFrame, top: int) -> DataFrame:
    """(topic, place, term, weight): the heaviest terms of each topic, named by the dictionary's table."""
    described = model.describeTopics(top)
    rows = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    rows = rows.select("topic", (F.col("place") + 1).alias("place"), F.col("t.termIndices").cast("long").alias("index"), F.col("t.termWeights").alias("weight"))
    # The topics' own terms are few: topics times ``top``.
    return terms.select("index", F.col("label").alias("term")).join(F.broadcast(rows), "index").select("topic", "place", "term", "weight")

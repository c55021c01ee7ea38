"""Feature encoding: indexes, vectors, scaling, bins, components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Bucketizer,
    CountVectorizer,
    IDF,
    Normalizer,
    PCA,
    QuantileDiscretizer,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

INDEX_SUFFIX = "_index"


def fit_index(df: DataFrame, columns: Sequence[str], max_labels: int = 1_000_000):
    """(model, indexed frame): categories numbered by falling frequency, ties by name.

    Unseen and missing values share one extra index. The fitted label list lives on the
    driver, so a column with more than ``max_labels`` categories is refused;
    ``dictionary.fit_labels`` numbers any count of them.
    """
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    wide = [c for c, n in sizes.items() if n > max_labels]
    if wide:
        raise ValueError(f"more than {max_labels} categories: {wide}")
    model = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}{INDEX_SUFFIX}" for c in columns],
        handleInvalid="keep",
    ).fit(df.select(*columns))
    return model, model.transform(df)


def assembler(features: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid)


def assemble(
    df: DataFrame, features: Sequence[str], target: str | None = None, keep: Sequence[str] = (),
    out: str = "features", invalid: str = "error",
) -> DataFrame:
    """The feature vector with the target and any kept columns beside it."""
    names = list(dict.fromkeys([*([target] if target else []), *keep]))
    return assembler(features, out, invalid).transform(df).select(*names, out)


def fit_scaler(train: DataFrame, features: Sequence[str], out: str = "features") -> PipelineModel:
    """Assemble and divide by the training standard deviation, without centring."""
    raw = "assembled_features"
    stages = [assembler(features, raw), StandardScaler(inputCol=raw, outputCol=out)]
    return Pipeline(stages=stages).fit(train)


def row_shares(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector divided by its L1 norm, row by row."""
    raw = "assembled_features"
    stages = [assembler(features, raw), Normalizer(inputCol=raw, outputCol=out, p=1.0)]
    return Pipeline(stages=stages).fit(df).transform(df).drop(raw)


def quantile_binner(
    df: DataFrame, columns: Sequence[str], bins: int = 20, relative_error: float = 0.01, suffix: str = "_bin"
) -> Bucketizer:
    """Equal-frequency bins for many columns in one pass; equal cut points collapse."""
    return QuantileDiscretizer(
        inputCols=list(columns),
        outputCols=[f"{c}{suffix}" for c in columns],
        numBuckets=bins,
        relativeError=relative_error,
        handleInvalid="keep",
    ).fit(df)


def feature_names(df: DataFrame, vector: str) -> list[str]:
    """Names of a vector column's slots from its metadata, numbered where it has none."""
    described = df.schema[vector].metadata.get("ml_attr", {})
    attrs = [a for group in described.get("attrs", {}).values() for a in group]
    if attrs:
        return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]
    width = described.get("num_attrs")
    if width is None:
        width = df.select(F.size(vector_to_array(F.col(vector))).alias("n")).first().n
    return [f"{vector}_{i}" for i in range(width)]


def principal_components(df: DataFrame, features: Sequence[str], k: int):
    """(loadings, variance): loadings by component and feature, shares with their running sum."""
    spark = df.sparkSession
    vectors = assemble(df, features).persist()  # read for the means, then for the products
    try:
        model = PCA(k=k, inputCol="features", outputCol="components").fit(vectors)
    finally:
        vectors.unpersist()
    loadings, shares = model.pc.toArray(), model.explainedVariance.toArray()
    rows = [(c + 1, f, float(loadings[i][c])) for c in range(k) for i, f in enumerate(features)]
    cumulative = np.cumsum(shares)
    variance = [(c + 1, float(shares[c]), float(cumulative[c])) for c in range(k)]
    return (
        spark.createDataFrame(rows, "component int, feature string, loading double"),
        spark.createDataFrame(variance, "component int, share double, cumulative double"),
    )


def singular_values(df: DataFrame, features: Sequence[str], k: int, keep: Sequence[str] = ()):
    """(values, right vectors, left vectors) of the feature matrix, uncentred.

    The decomposition aggregates a features x features matrix. The left vectors, one row per
    input row, are the features times V/s as column arithmetic, so they stay distributed.
    """
    spark = df.sparkSession
    rows = MLUtils.convertVectorColumnsFromML(assemble(df, features), "features")
    result = RowMatrix(rows).computeSVD(k, computeU=False)
    s, v = result.s.toArray(), result.V.toArray()
    values = spark.createDataFrame(
        [(c + 1, float(x)) for c, x in enumerate(s)], "component int, singular_value double"
    )
    right = spark.createDataFrame(
        [(c + 1, f, float(v[i][c])) for c in range(len(s)) for i, f in enumerate(features)],
        "component int, feature string, loading double",
    )
    left = df.select(
        *keep,
        *[
            sum(
                (F.col(f).cast("double") * float(v[i][c] / s[c]) for i, f in enumerate(features)),
                F.lit(0.0),
            ).alias(f"u{c + 1}")
            for c in range(len(s))
        ],
    )
    return values, right, left


def chi_square_selector(df: DataFrame, features: Sequence[str], label: str, k: int):
    """(names of the ``k`` features most dependent on the class, fitted selector)."""
    selector = UnivariateFeatureSelector(
        featuresCol="features", outputCol="selected", labelCol=label, selectionMode="numTopFeatures"
    ).setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k)
    model = selector.fit(assemble(df, features, label))
    return [features[i] for i in model.selectedFeatures], model


def fit_term_vectors(
    tokens: DataFrame, column: str, vocabulary: int, min_documents: int, out: str = "features"
) -> PipelineModel:
    """Term counts over the ``vocabulary`` most frequent terms, then inverse-document-frequency weights.

    The list lives on the driver; ``dictionary.term_vectors`` keeps all terms.
    """
    counts = CountVectorizer(
        inputCol=column, outputCol="raw_features", vocabSize=vocabulary, minDF=float(min_documents)
    )
    return Pipeline(stages=[counts, IDF(inputCol="raw_features", outputCol=out)]).fit(tokens)


def document_frequencies(tokens: DataFrame, column: str, min_documents: int = 1) -> DataFrame:
    """(term, df, idf) with idf = ln((n + 1) / (df + 1)); a document counts a term once."""
    documents = tokens.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        tokens.select(F.explode(F.array_distinct(column)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_documents)
        .withColumn("n", documents)
        .withColumn("idf", F.log((F.col("n") + 1) / (F.col("df") + 1)))
        .drop("n")
    )


def term_weights(tokens: DataFrame, key: str, column: str, min_documents: int = 1) -> DataFrame:
    """Long form (key, term, tf, df, idf, weight) of every kept term of every document.

    Terms are counted per document before the join. A term in a third of the documents makes
    one hot join key; adaptive execution broadcasts the frequencies or splits that partition.
    """
    counted = (
        tokens.select(key, F.explode(column).alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    frequencies = document_frequencies(tokens, column, min_documents)
    return counted.join(frequencies, "term").withColumn("weight", F.col("tf") * F.col("idf"))


def vector_slots(column: str, names: Sequence[str]):
    """Vector column as plain columns, in the JVM."""
    array = vector_to_array(F.col(column))
    return [array[i].alias(n) for i, n in enumerate(names)]

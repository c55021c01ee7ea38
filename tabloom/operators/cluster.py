"""Clustering on row shares: k-means, bisecting k-means, sweeps over k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Normalizer
from pyspark.sql import DataFrame

from tabloom.operators.encode import row_shares

# Seeds of the two clusterings.
KMEANS_SEED = 1003
BISECTING_SEED = 1


def fit_clusters(df: DataFrame, k: int = 2, kind: str = "kmeans", features_col: str = "features"):
    """k-means or bisecting k-means on a vector column."""
    if kind == "kmeans":
        return KMeans(k=k, seed=KMEANS_SEED, featuresCol=features_col).fit(df)
    if kind == "bisecting":
        return BisectingKMeans(k=k, seed=BISECTING_SEED, featuresCol=features_col).fit(df)
    raise ValueError("kind is 'kmeans' or 'bisecting'")


def cluster_shares(df: DataFrame, features: Sequence[str], k: int = 2, kind: str = "kmeans"):
    """(model, assigned frame) after assembling and dividing each row by its L1 norm."""
    vectors = row_shares(df, features).persist()
    try:
        model = fit_clusters(vectors, k, kind)
    finally:
        vectors.unpersist()
    return model, model.transform(row_shares(df, features))


def cluster_vector_shares(df: DataFrame, vector_col: str, k: int = 2, kind: str = "kmeans"):
    """``cluster_shares`` of a vector column of any length, without naming its places."""
    shares = Normalizer(p=1.0, inputCol=vector_col, outputCol="features").transform(df)
    vectors = shares.persist()
    try:
        model = fit_clusters(vectors, k, kind)
    finally:
        vectors.unpersist()
    return model, model.transform(shares)


def centre_table(model, features: Sequence[str], spark) -> DataFrame:
    rows = [
        (c, f, float(x)) for c, centre in enumerate(model.clusterCenters()) for f, x in zip(features, centre)
    ]
    return spark.createDataFrame(rows, "cluster int, feature string, centre double")


def silhouette(assigned: DataFrame, features_col: str = "features") -> float:
    """Mean silhouette by squared Euclidean distance; linear in rows, from cluster sums."""
    return ClusteringEvaluator(featuresCol=features_col).evaluate(assigned)


def sweep(df: DataFrame, ks: Sequence[int] = range(2, 8), kind: str = "kmeans", features_col: str = "features") -> DataFrame:
    """(k, silhouette) for each k, over one persisted vector column."""
    vectors = df.select(features_col).persist()
    try:
        rows = [
            (k, float(silhouette(fit_clusters(vectors, k, kind, features_col).transform(vectors), features_col)))
            for k in ks
        ]
    finally:
        vectors.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")

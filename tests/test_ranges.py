"""Samples of exact size, the range finder and the table of runs."""

import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import functions as F

from tabloom.operators import range_finder
from tabloom.operators.sampling import GRAIN, hash_bucket, sample_exact
from tabloom.plans import run_table

rng = random.Random(3)


def test_exact_samples_of_strata(spark):
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None])) for i in range(3000)] + [(9001, "lone"), (None, "lone")]
    df = spark.createDataFrame(rows, "k long, g string").repartition(7).cache()
    place = {r.k: r.p for r in df.select("k", hash_bucket([F.col("k")], GRAIN, "s").alias("p")).collect()}
    for size in (1, 10, 700, 5000):
        found = sample_exact(df, "k", size, strata="g", seed="s").collect()
        for g in ("hot", "a", "b", None, "lone"):
            keys = sorted((k for k, x in rows if x == g), key=lambda k: (place[k], k is not None, k))
            assert sorted(map(str, keys[:size])) == sorted(str(r.k) for r in found if r.g == g)
    assert sample_exact(df, "k", 40).count() == 40 and sample_exact(df, "k", 0).count() == 0
    sizes = {r.g: r["count"] for r in sample_exact(df, "k", {"hot": 30, None: 2}, strata="g").groupBy("g").count().collect()}
    assert sizes == {"hot": 30, None: 2}
    assert sample_exact(df.limit(0), "k", 5).collect() == []


def test_samples_merge_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 3)
    whole = sample_exact(df, "id", 50, strata="g")
    parts = [sample_exact(df.where(F.col("id") % 4 == i), "id", 50, strata="g") for i in range(4)]
    merged = sample_exact(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "id", 50, strata="g")
    other = sample_exact(df.repartition(13), "id", 50, strata="g")
    assert sorted(whole.collect()) == sorted(merged.collect()) == sorted(other.collect())


def test_repeated_keys_keep_the_size(spark):
    df = spark.createDataFrame([(1,)] * 100 + [(2,)] * 100, "k int")
    assert sample_exact(df, "k", 130).count() == 130


def matrix(spark, a, parts=5):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(a)], "i long, v array<double>").repartition(parts)


@pytest.mark.parametrize("shape, k", [((300, 40), 4), ((60, 90), 3), ((50, 6), 6), ((3, 30), 2)])
def test_values_and_vectors_equal_the_full_decomposition(spark, shape, k):
    gen = np.random.default_rng(shape[0])
    a = gen.standard_normal(shape) * np.geomspace(10, 0.1, shape[1])
    df = matrix(spark, a)
    values, right = range_finder.leading_vectors(df, "v", k)
    _, s, v = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(values, s[:k], rtol=1e-8)
    assert np.allclose(np.abs(right.T), np.abs(v[:k]), atol=1e-4)
    assert (right[np.abs(right).argmax(axis=0), range(k)] > 0).all()
    full = RowMatrix(df.select("v").rdd.map(lambda r: Vectors.dense(r.v))).computeSVD(k)
    assert np.allclose(values, full.s.toArray(), rtol=1e-6)
    u = {r.i: r.u for r in range_finder.left_vectors(df, "v", values, right, ["i"]).collect()}
    u = np.array([u[i] for i in range(len(a))])
    assert np.allclose(u.T @ u, np.eye(k), atol=1e-8) and np.allclose(u, a @ right / values, atol=1e-8)


def test_nothing_square_is_made(spark, monkeypatch):
    """4,000 features, three directions: the largest matrix of a step has 13 columns."""
    seen = []
    products = range_finder._products
    monkeypatch.setattr(range_finder, "_products", lambda rows, thin: seen.append(thin.shape) or products(rows, thin))
    gen = np.random.default_rng(1)
    a = gen.standard_normal((40, 3)) @ gen.standard_normal((3, 4000))
    values, right = range_finder.leading_vectors(matrix(spark, a), "v", 3)
    assert np.allclose(values, np.linalg.svd(a, compute_uv=False)[:3]) and set(seen) == {(4000, 13)} and right.shape == (4000, 3)
    with pytest.raises(ValueError):
        monkeypatch.setattr(range_finder, "THIN_BYTES", 1000)
        range_finder.leading_vectors(matrix(spark, a), "v", 3)


def test_odd_matrices(spark):
    df = matrix(spark, np.outer(np.arange(1.0, 9.0), [3.0, -4.0, 0.0]))
    values, right = range_finder.leading_vectors(df, "v", 3)
    assert np.allclose(values, [5 * np.sqrt(204)]) and np.allclose(right[:, 0], [-0.6, 0.8, 0])
    for rows in ([], [[0.0, 0.0]] * 3):
        empty = spark.createDataFrame([(r,) for r in rows], "v array<float>")
        values, right = range_finder.leading_vectors(empty, "v", 2)
        assert len(values) == 0 and right.shape[1] == 0
    for bad in (None, [1.0], [1.0, None], [1.0, float("nan")]):
        with pytest.raises(PythonException):
            range_finder.leading_vectors(spark.createDataFrame([([1.0, 2.0],), (bad,)], "v array<double>").coalesce(1), "v", 1)


METRICS = "model string, dataset string, metric string, value double"


def test_a_run_is_replaced_and_a_failed_one_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert run_table.runs(spark, path).collect() == []
    first = spark.createDataFrame([("m", "train", "ks", 30.0), ("m", "test", "ks", 20.0)], METRICS)
    run_table.record_run(path, "2024-01-01", {"depth": 3}, first)
    run_table.record_run(path, "b", {"depth": 4}, first)
    run_table.record_run(path, "2024-01-01", {"depth": 5}, first.limit(1))
    failing = first.withColumn("value", F.when(F.col("dataset") == "test", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    for run_id in ("b", "new"):
        with pytest.raises(Exception, match="lost"):
            run_table.record_run(path, run_id, {}, failing)
    for run_id, metrics in (("", first), (None, first), ("none", first.limit(0))):
        with pytest.raises(ValueError):
            run_table.record_run(path, run_id, {}, metrics)
    rows = run_table.runs(spark, path).withColumn("depth", run_table.parameter("depth"))
    assert sorted((r.run_id, r.depth, r.dataset) for r in rows.collect()) == [("2024-01-01", "5", "train"), ("b", "4", "test"), ("b", "4", "train")]


def test_runs_are_compared_and_the_steadiest_model_wins(spark, tmp_path):
    path = str(tmp_path / "runs")
    run_table.record_run(path, "r1", {}, spark.createDataFrame([("m", "train", "ks", 30.0), ("m", "test", "ks", 20.0), ("n", "train", "ks", 10.0)], METRICS))
    run_table.record_run(path, "r2", {}, spark.createDataFrame([("m", "train", "ks", 28.0), ("m", "test", "ks", 27.0)], METRICS))
    rows = run_table.runs(spark, path)
    found = {(r.model, r.dataset): (r.first, r.second, r.change) for r in run_table.compare_runs(rows, "r1", "r2").collect()}
    assert found == {("m", "train"): (30.0, 28.0, -2.0), ("m", "test"): (20.0, 27.0, 7.0), ("n", "train"): (10.0, None, None)}
    placed = [(r.run_id, r.model, r.counter, r.selected) for r in run_table.champion_of_runs(rows).orderBy("place").collect()]
    assert placed == [("r2", "m", 0, "Champion"), ("r1", "n", 0, "Challenger"), ("r1", "m", 1, "")]

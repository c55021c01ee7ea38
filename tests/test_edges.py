"""Edge cases: constant and dependent columns, missing labels, signed zeros, small fractions, odd types."""

import datetime
import math

from pyspark.sql import functions as F

from tabloom.operators import association, evaluate, learners, profile, sampling


def test_vif_of_constant_and_dependent_columns(spark):
    rows = [(float(i), float((i * 7) % 11), 5.0, float(i) + (i * 7) % 11) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, k double, s double")
    plain = {r.feature: r.vif for r in association.vif(df, ["a", "b"]).collect()}
    with_constant = {r.feature: r.vif for r in association.vif(df, ["a", "b", "k"]).collect()}
    assert with_constant["k"] is None and all(abs(with_constant[f] - plain[f]) < 1e-9 for f in "ab")
    summed = {r.feature: r.vif for r in association.vif(df.withColumn("z", F.rand(3)), ["a", "b", "s", "z"]).collect()}
    assert all(math.isinf(summed[f]) for f in "abs") and 1 <= summed["z"] < 2


def test_rows_without_label_or_score_are_left_out(spark):
    rows = [(1, 0.9), (0, 0.1), (None, 0.95), (1, None)]
    points = evaluate.thresholds(spark.createDataFrame(rows, "y int, s double"), "y", "s").collect()
    assert sorted((r.threshold, r.pos, r.neg) for r in points) == [(0.1, 0, 1), (0.9, 1, 0)]


def test_signed_zeros_are_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert profile.cardinality_profile(df, exact=True).first()["distinct"] == 2


def test_small_fractions_and_many_partitions(spark):
    rows = spark.range(1_000_000)
    assert 15 <= sampling.sample_by_key(rows, "id", 0.00004).count() <= 75
    assert learners.spread(rows).rdd.getNumPartitions() >= 4


def test_woe_of_truth_values_and_dates(spark):
    day = datetime.date(2024, 1, 1)
    df = spark.createDataFrame([(i % 2 == 0, day, int(i % 3 == 0)) for i in range(30)], "b boolean, d date, y int")
    bins = {(r.varname, r.bin) for r in association.woe_table(df, ["b", "d"], "y").collect()}
    assert bins == {("b", "true"), ("b", "false"), ("d", "2024-01-01")}

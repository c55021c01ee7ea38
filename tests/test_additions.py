"""Models without a group, sketches, checked records, the selecting stage and bucketed tables."""

import json
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabloom.operators import leave_out, sketches
from tabloom.operators.selection import CorrelationSelector, CorrelationSelectorModel
from tabloom.sources import records, writers

rng = random.Random(11)


@pytest.fixture(scope="module")
def grouped(spark):
    rows = []
    for i in range(400):
        a, b = rng.uniform(1e3, 1e3 + 50), rng.randint(0, 9)
        rows.append((rng.choice(["g1", "g2", None, "g3"]) if i % 3 else "hot", a, b, 3 * a - 2 * b + rng.gauss(0, 1), float(i % 2)))
    rows += [("g1", None, 1, 2.0, 1.0), ("g2", 1e3, 3, None, None), ("only", 1e3, 1, 5.0, 2.0)]
    return spark.createDataFrame(rows, "g string, a double, b int, y double, label double").cache()


def test_linear_without_groups_equals_single_fits(grouped):
    found = {r.group: r for r in leave_out.linear_without_groups(grouped, ["a", "b"], "y", "g").collect()}
    assert set(found) == {"g1", "g2", "g3", "hot", "only", None}
    whole = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(grouped.dropna(subset=["a", "b", "y"]))
    for group, r in found.items():
        own = F.col("g").eqNullSafe(F.lit(group))
        model = LinearRegression(labelCol="y", solver="normal").fit(whole.where(~own))
        assert r.coefficients == pytest.approx(list(model.coefficients), rel=1e-5)
        assert r.intercept == pytest.approx(model.intercept, rel=1e-4)
        assert r.n == whole.where(own).count() and r.n_left == whole.where(~own).count()
        assert r.rmse == pytest.approx(model.evaluate(whole.where(own)).rootMeanSquaredError, rel=1e-4)


def test_linear_without_groups_of_odd_tables(spark, grouped):
    assert leave_out.linear_without_groups(grouped.limit(0), ["a"], "y", "g").collect() == []
    one = leave_out.linear_without_groups(grouped.where("g = 'hot'"), ["a"], "y", "g").first()
    assert (one.n_left, one.intercept, one.coefficients, one.rmse) == (0, None, None, None)
    same = spark.createDataFrame([(i % 2, 1.0, float(i)) for i in range(6)], "g int, x double, y double")
    for r in leave_out.linear_without_groups(same, ["x"], "y", "g").collect():  # a constant feature
        assert r.intercept + r.coefficients[0] == pytest.approx(np.mean([i for i in range(6) if i % 2 != r.group]))


def test_many_groups_in_one_pass(spark):
    df = spark.range(30_000).select((F.col("id") % 5000).alias("g"), (F.col("id") % 97).cast("double").alias("x"), (F.col("id") % 97 * 2 + 1).cast("double").alias("y"))
    facts = leave_out.linear_without_groups(df, ["x"], "y", "g").agg(
        F.count("*"), F.max(F.abs(F.col("coefficients")[0] - 2)), F.max(F.abs(F.col("intercept") - 1)), F.max("rmse")
    ).first()
    assert facts[0] == 5000 and max(facts[1:]) < 1e-4


def test_bayes_without_groups_equals_single_fits(grouped):
    rows = grouped.withColumn("a", F.col("a") - 1e3 + 1)
    found = leave_out.bayes_without_groups(rows, ["a", "b"], "label", "g").collect()
    whole = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.dropna(subset=["a", "b", "label"]))
    groups = {r.group for r in found}
    assert groups == {"g1", "g2", "g3", "hot", "only", None}
    for group in groups - {"only"}:  # without it a class of the whole table is empty
        model = NaiveBayes().fit(whole.where(~F.col("g").eqNullSafe(F.lit(group))))
        mine = sorted((r for r in found if r.group == group), key=lambda r: r.label)
        assert [r.prior for r in mine] == pytest.approx(list(model.pi), rel=1e-9)
        assert np.array([r.weights for r in mine]) == pytest.approx(model.theta.toArray(), rel=1e-9)
    lone = {r.label: r for r in found if r.group == "only"}
    assert lone[2.0].weights == pytest.approx([np.log(1 / 2)] * 2)


def test_sketches_merge(spark):
    rows = spark.range(50_000).select((F.col("id") % 7).alias("part"), (F.col("id") % 20_011).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("y"))
    parts = sketches.distinct_sketches(rows, ["part"], ["x", "y"])
    assert parts.count() == 7
    merged = sketches.merged_distinct(parts, ["x", "y"]).first()
    bound = 5 * sketches.distinct_error()
    assert abs(merged.x - 20_011) <= bound * 20_011 and abs(merged.y - 25_000) <= bound * 25_000
    some = sketches.merged_distinct(parts.where("part < 2"), ["x"]).first().x
    assert abs(some - rows.where("part < 2").select("x").distinct().count()) <= bound * some + 1
    middle = sketches.merged_quantiles(sketches.quantile_sketches(rows, ["part"], ["x"]), ["x"], 0.5).first().x
    assert abs(rows.where(F.col("x") < middle).count() / 50_000 - 0.5) < 0.02


LINES = [
    ('{"a": 1, "b": "x"}', "good"), ('{"a": 1}', "good"), ("{}", "good"), ('{"a": null, "b": "é", "c": [1]}', "good"),
    ('{"a": 1, "b": "x"', "not a record"), ("", "not a record"), ("   ", "not a record"), ("[1, 2]", "not a record"), ("text", "not a record"),
    ('{"a": "one", "b": "x"}', "wrong type"), ('{"a": 1.5}', "wrong type"), (json.dumps({"a": 2, "b": "y" * 300_000}), "good"),
    ('{"a": 1, "b": "x"}', "good"), (None, "not a record"),
]


def test_every_line_is_on_one_side(spark):
    lines = spark.createDataFrame(LINES, "value string, side string")
    rows = records.judged(lines, "a long, b string").collect()
    assert [(r.value, r.reason or "good") for r in rows] == LINES
    good, rejects = records.split_records(lines, "a long, b string")
    assert good.columns == ["a", "b"] and good.count() == 6
    assert sorted((r.text or "", r.reason) for r in rejects.collect()) == sorted((t or "", s) for t, s in LINES if s != "good")


def test_a_repeated_batch_writes_nothing_twice(spark, tmp_path):
    path, good, rejects, state = (str(tmp_path / x) for x in ("in", "good", "rejects", "state"))
    lines = spark.createDataFrame([(t,) for t, _ in LINES if t and "\n" not in t and t.strip()], "value string")
    lines.write.text(path)

    def broken(rows):
        raise RuntimeError("stopped between")

    query = records.split_stream(records.line_stream(spark, path), "a long, b string", good, rejects, state, lambda rows: rows.withColumn("c", F.col("a") * 2))
    query.awaitTermination()
    lines.limit(5).write.mode("append").text(path)
    with pytest.raises(Exception, match="stopped between"):
        records.split_stream(records.line_stream(spark, path), "a long, b string", good, rejects, state, broken).awaitTermination()
    for _ in range(2):  # the batch that failed is done again, and then there is nothing to do
        records.split_stream(records.line_stream(spark, path), "a long, b string", good, rejects, state).awaitTermination()
    total = spark.read.parquet(good).count() + spark.read.parquet(rejects).count()
    assert total == lines.count() + 5


def test_selector_in_a_saved_pipeline(spark, tmp_path):
    rows = [(float(i), 2.0 * i + rng.random(), rng.random(), 5.0, "t") for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e string")
    names = ["a", "b", "c", "d"]
    model = Pipeline(stages=[CorrelationSelector(inputCols=names, cutoff=0.9), VectorAssembler(inputCols=["a", "c"], outputCol="v")]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(loaded.stages[0], CorrelationSelectorModel) and loaded.stages[0].getKept() == ["a", "c", "d"]
    assert loaded.transform(df).columns == ["a", "c", "d", "e", "v"] == model.transform(df).columns
    turned = CorrelationSelector(inputCols=names[::-1], method="spearman", cutoff=0.9).fit(df)
    assert turned.getKept() == ["d", "c", "b"] and turned.transform(df).columns == ["b", "c", "d", "e"]
    unfitted = str(tmp_path / "e")
    CorrelationSelector(inputCols=names, cutoff=0.2).write().overwrite().save(unfitted)
    assert CorrelationSelector.load(unfitted).getOrDefault("cutoff") == 0.2
    with pytest.raises(ValueError):
        CorrelationSelector(inputCols=names, cutoff=1.5).fit(df)


def test_bucketed_tables_join_without_exchange(spark):
    try:
        writers.write_bucketed(spark.range(1000).withColumnRenamed("id", "k"), "bucketed_a", ["k"], 4)
        writers.write_bucketed(spark.range(500).withColumnRenamed("id", "j"), "bucketed_b", ["j"], 4)
        assert spark.sql("DESCRIBE EXTENDED bucketed_a").where("col_name = 'Type'").first().data_type == "MANAGED"
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b").hint("merge"), F.col("k") == F.col("j"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 500
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_a")
        spark.sql("DROP TABLE IF EXISTS bucketed_b")

"""A key on a third of both sides of a join."""

from collections import Counter

from pyspark.sql import functions as F

from tabloom.operators import joins


def test_hot_on_both_sides(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 40}", "same") for i in range(300)], "a int, lk string, t string")
    right = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i}") for i in range(60)], "b int, rk string")
    assert joins.hot_keys(left, "lk", 0.2) == ["hot"]
    for how in ("inner", "left", "right", "full"):
        wanted = Counter(tuple(r) for r in left.join(right, F.col("lk") == F.col("rk"), how).collect())
        mine = joins.salted_join(left, right, "lk", "rk", how, share=0.2, salts=5)
        assert mine.columns == ["a", "lk", "t", "b", "rk"]
        assert Counter(tuple(r) for r in mine.collect()) == wanted
    empty = left.where("false")
    assert joins.salted_join(empty, right, "lk", "rk", "full").count() == 60


def test_no_part_holds_the_key_whole(spark):
    """Equal rows spread over the parts as well."""
    left = spark.range(0, 4000, numPartitions=8).select(F.lit("hot").alias("lk"), F.lit(1).alias("a"))
    right = spark.range(30).select(F.lit("hot").alias("rk"), F.col("id").alias("b"))
    joined = joins.salted_join(left, right, "lk", "rk", salts=16)
    assert joined.count() == 120_000
    part = F.pmod(F.xxhash64("lk", "a", F.spark_partition_id()), F.lit(16))
    assert left.groupBy(part.alias("p")).count().agg(F.max("count")).scalar() is not None
    assert max(r["count"] for r in left.groupBy(part.alias("p")).count().collect()) <= 2000


def test_totals_without_the_pairs(spark):
    """As many pairs as two sides of 300,000 rows have on one key cannot be made; small sides as by the rows."""
    left = spark.createDataFrame([(i if i % 5 else None, "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 40}") for i in range(300)], "a int, lk string")
    right = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i}") for i in range(60)], "b int, rk string")
    for how in ("inner", "left", "right", "full"):
        rows = left.join(right, F.col("lk") == F.col("rk"), how)
        wanted = rows.groupBy("lk", "rk").agg(F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
        mine = joins.join_totals(left, right, "lk", "rk", how, ["a", "b"], salts=5)
        assert mine.columns == wanted.columns
        assert Counter(tuple(r) for r in mine.collect()) == Counter(tuple(r) for r in wanted.collect())
    many = spark.range(300_000).select(F.lit("hot").alias("lk"), F.lit(1).alias("a"))
    other = spark.range(300_000).select(F.lit("hot").alias("rk"), F.lit(2).alias("b"))
    assert [tuple(r) for r in joins.join_totals(many, other, "lk", "rk", "full", ["a", "b"]).collect()] == [("hot", "hot", 9 * 10**10, 9 * 10**10, 18 * 10**10)]

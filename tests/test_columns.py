"""Missing values, casts, column choice, joins, sampling, imputation, profiles."""

import math

import pytest
from pyspark.sql import functions as F

from tabloom.functions.columns import band, cast_columns, split_types
from tabloom.functions.missing import filter_missing, is_missing
from tabloom.functions.text import tokenize
from tabloom.operators import profile, sampling
from tabloom.operators.impute import apply_fill, fit_fill, impute
from tabloom.operators.joins import broadcast_checked, equi_join
from tabloom.operators.shape import choose_columns, label_pair_udf, strip_suffix, unpack


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, 1.0, "a"), (2, float("nan"), ""), (3, None, None), (4, 0.0, "NaN")]
    return spark.createDataFrame(rows, "id int, x double, s string")


def test_missing_readings(gaps):
    count = lambda test: gaps.where(test).count()
    assert count(is_missing(gaps, "x", nan=False)) == 1
    assert count(is_missing(gaps, "x")) == 2
    assert count(is_missing(gaps, "s", nan=False)) == 1
    assert count(is_missing(gaps, "s")) == 2
    assert count(is_missing(gaps, "s", empty=True)) == 3
    assert count(is_missing(gaps, "id", empty=True)) == 0
    assert [r.id for r in filter_missing(gaps, "s", empty=True).collect()] == [1]


def test_failed_cast_is_null(spark):
    df = spark.createDataFrame([("7", "2020-02-30"), ("x", "2020-02-28")], "a string, d string")
    typed = cast_columns(df, {"int": ["a"], "date": ["d"]}).collect()
    assert [r.a for r in typed] == [7, None] and typed[0].d is None and str(typed[1].d) == "2020-02-28"


def test_split_types(gaps):
    assert split_types(gaps) == (["s"], ["id", "x"])


def test_choose_columns(spark):
    schema = spark.createDataFrame([], "id int, n_age int, n_size int, c_name string, when date, y int").schema
    assert choose_columns(schema, "y") == ["id", "n_age", "n_size", "c_name"]
    assert choose_columns(schema, "Y", include_prefix=["N_"]) == ["n_age", "n_size"]
    assert choose_columns(schema, "y", include_suffix=["_age", "name"]) == ["n_age", "c_name"]
    assert choose_columns(schema, "y", exclude=["ID"], exclude_suffix=["size"]) == ["n_age", "c_name"]


def test_band_and_udf_agree(spark):
    df = spark.createDataFrame([(1.0, 9.0), (2.0, 2.0), (5.0, 3.0)], "a double, b double")
    bounds = [(2, "low"), (5, "mid")]
    pair = label_pair_udf((bounds, "high"), (bounds, "high"), "p string, q string")
    by_udf = unpack(df.select(pair("a", "b").alias("s")), "s").collect()
    built_in = df.select(band(F.col("a"), bounds, "high").alias("p"), band(F.col("b"), bounds, "high").alias("q")).collect()
    assert by_udf == built_in


def test_strip_suffix(spark):
    df = spark.createDataFrame([(1, 2)], "a_index int, b int")
    assert strip_suffix(df, "_index").columns == ["a", "b"]
    assert strip_suffix(df, "_index", ["b"]).columns == ["a_index", "b"]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_outer_joins_equal_spark(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (3, 30), (None, 40)], "r int, w int")
    mine = equi_join(left, right, "k", "r", how)
    theirs = left.join(right, F.col("k") == F.col("r"), how)
    assert sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect()))


def test_join_refuses_shared_names(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        equi_join(df, df, "k", "k")


def test_broadcast_only_within_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, small = spark.range(1000), spark.range(50).withColumnRenamed("id", "k")
        join = lambda side: plan_of(big.join(side, F.col("id") == F.col("k")))
        assert "BroadcastHashJoin" in join(broadcast_checked(small, 50))
        assert "BroadcastHashJoin" not in join(broadcast_checked(small, 49))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hash_split_is_a_partition(spark):
    df = spark.range(5000)
    parts = sampling.split(df, [0.7, 0.2, 0.1], 1, key="id")
    again = sampling.split(df.repartition(7), [0.7, 0.2, 0.1], 1, key="id")
    assert [p.count() for p in parts] == [p.count() for p in again]
    assert sum(p.count() for p in parts) == 5000
    assert abs(parts[0].count() - 3500) < 150
    assert sampling.split(df, [0.7, 0.3], 2, key="id")[0].exceptAll(parts[0]).count() > 0


def test_hash_sample_share(spark):
    kept = sampling.sample_by_key(spark.range(20000), "id", 0.4).count()
    assert abs(kept - 8000) < 300


def test_seeded_samples(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert sampling.sample(orders, 0.4, 42).count() == sampling.sample(orders, 0.4, 42).count()
    status = sampling.sample_strata(orders, "o_orderstatus", {"F": 0.5}, 3)
    assert {r[0] for r in status.select("o_orderstatus").distinct().collect()} == {"F"}


def test_normal_values(spark):
    row = sampling.normal_values(spark, 40000, 10, 1.0, 2.0, 5).agg(F.avg("value"), F.stddev("value")).first()
    assert abs(row[0] - 1) < 0.05 and abs(row[1] - 2) < 0.05


def test_impute(gaps):
    assert fit_fill(gaps, ["x"], "mean") == {"x": 0.5}
    filled = apply_fill(gaps, {"x": 9.0}, prefix="f_").orderBy("id").collect()
    assert [r.f_x for r in filled] == [1.0, 9.0, 9.0, 0.0] and math.isnan(filled[1].x)
    assert impute(gaps, ["x"], "constant", value=0.0).where("x = 0.0").count() == 3
    with pytest.raises(ValueError):
        fit_fill(gaps, ["x"], "mode")


def test_missing_profile(gaps):
    found = {r.column: (r.missing, r.share) for r in profile.missing_profile(gaps, empty=True).collect()}
    assert found == {"id": (0, 0.0), "x": (2, 0.5), "s": (3, 0.75)}
    shares = profile.missing_profile(gaps, empty=True)
    assert {r.column for r in profile.select_by_missing(shares, 0.5, "keep").collect()} == {"id", "x"}
    assert {r.column for r in profile.select_by_missing(shares, 0.5, "drop").collect()} == {"x", "s"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 9, 10)], "x double")
    assert [r.frequency for r in profile.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 1, 0, 0, 2]
    flat = profile.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", 5).collect()
    assert len(flat) == 1 and flat[0].frequency == 2


def test_counted_lists(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("b", None)], "g string, v int")
    found = profile.collect_counted(df, ["g"], "v").select(profile.expand_counted(F.col("items")).alias("l")).collect()
    assert [r.l for r in found] == [[1, 2, 2]]


def test_cardinality(gaps):
    exact = {r.column: r.distinct for r in profile.cardinality_profile(gaps, ["id", "s"], exact=True).collect()}
    assert exact == {"id": 4, "s": 3}


def test_tokenize(spark):
    df = spark.createDataFrame([("  The QUICK, brown#fox;jumped over l4zy Straße with élan ",)], "t string")
    assert df.select(tokenize(F.col("t")).alias("w")).first().w == ["quick", "brown", "jumped", "straße", "élan"]


def test_filters_reach_the_scan(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet")
    text = plan_of(parts.where("p_size > 10").select("p_partkey", "p_size"))
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)]" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in text


def test_partitioned_read_prunes(spark, sf, tmp_path):
    from tabloom.sources.readers import read_delimited
    from tabloom.sources.writers import write_delimited

    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")
    path = write_delimited(orders, str(tmp_path / "p"), partition_by=["o_orderstatus"])
    text = plan_of(read_delimited(spark, path, schema=orders.schema).where("o_orderstatus = 'F'"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_single_file_only_on_request(spark, tmp_path):
    from tabloom.sources.writers import write_delimited

    df = spark.range(0, 100, 1, 4)
    parts = lambda p: len([f for f in p.iterdir() if f.name.startswith("part-")])
    write_delimited(df, str(tmp_path / "many"))
    write_delimited(df, str(tmp_path / "one"), single_file=True)
    assert parts(tmp_path / "many") == 4 and parts(tmp_path / "one") == 1


def test_describe_table(spark, tmp_path):
    from tabloom.sources.readers import describe_table
    from tabloom.sources.writers import write_table

    write_table(spark.range(3), "described_rows", str(tmp_path / "t"))
    assert [(r.col_name, r.data_type) for r in describe_table(spark, "described_rows").collect()] == [("id", "bigint")]


def test_no_cross_joins_or_row_udfs(spark, sf):
    from tabloom.catalog import QUERIES

    for name in ("add_literal_stat", "agg_variance", "win_share_of_total", "win_gap_to_max", "stat_psi", "ev_regression"):
        text = plan_of(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "BatchEvalPython" not in text, name

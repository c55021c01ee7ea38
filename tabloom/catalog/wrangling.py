"""Projections, filters, joins, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import big, query, table
from tabloom.functions.columns import band, cast_columns, encode_target, rounded
from tabloom.functions.missing import filter_missing, require_target
from tabloom.operators.joins import attach_target, broadcast_checked, equi_join
from tabloom.operators.profile import with_deviation
from tabloom.operators.ranking import top_per_group
from tabloom.operators.shape import (
    choose_columns,
    label_pair_udf,
    select_positions,
    select_regex,
    strip_suffix,
    unpack,
)

# ---- projections ---------------------------------------------------------------------


@query("select_names", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("select_positions", "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer")
def _(spark, sf):
    return select_positions(table(spark, sf, "customer"), [4, 0, 3])


@query("select_regex", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(spark, sf):
    return select_regex(table(spark, sf, "part"), r"p_(part|na|ret)\w*")


@query("drop_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").drop("s_name", "s_nationkey")


@query(
    "rename_columns",
    "SELECT o_orderkey AS order_id, o_orderpriority AS urgency, o_totalprice AS price FROM orders",
)
def _(spark, sf):
    names = {"o_orderkey": "order_id", "o_orderpriority": "urgency", "o_totalprice": "price"}
    return table(spark, sf, "orders").select(*names).withColumnsRenamed(names)


@query("strip_suffix_rename", "SELECT n_nationkey::bigint AS n_nationkey, n_name FROM nation")
def _(spark, sf):
    indexed = table(spark, sf, "nation").select(
        big("n_nationkey").alias("n_nationkey_index"), F.col("n_name").alias("n_name_index")
    )
    return strip_suffix(indexed, "_index")


@query(
    "cast_columns",
    """SELECT o_orderkey, TRY_CAST(o_totalprice::varchar AS DOUBLE) AS price,
              TRY_CAST(o_orderpriority AS INTEGER)::bigint AS bad_number,
              strftime(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS day
       FROM orders""",
)
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderpriority").alias("bad_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    typed = cast_columns(raw, {"double": ["price"], "int": ["bad_number"], "date": ["day"]})
    return typed.select("o_orderkey", "price", big("bad_number").alias("bad_number"), F.col("day").cast("string").alias("day"))


@query(
    "add_literal_stat",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER (), 4) AS mean_price,
              round(pow(o_totalprice - avg(o_totalprice) OVER (), 2), 0) AS squared_deviation FROM orders""",
)
def _(spark, sf):
    marked = with_deviation(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")
    return marked.select(
        "o_orderkey",
        rounded(F.col("mean_o_totalprice"), 4).alias("mean_price"),
        rounded(F.col("squared_deviation"), 0).alias("squared_deviation"),
    )


BANDS_SQL = """SELECT o_orderkey,
  CASE WHEN o_totalprice < 100000 THEN 'Small' WHEN o_totalprice < 300000 THEN 'Medium' ELSE 'Big' END AS price_band,
  CASE WHEN o_custkey < 300 THEN 'Low' WHEN o_custkey < 900 THEN 'Mid' ELSE 'High' END AS ratings
FROM orders"""
PRICE_BANDS = [(100000, "Small"), (300000, "Medium")]
RATING_BANDS = [(300, "Low"), (900, "Mid")]


@query("case_bins", BANDS_SQL)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        band(F.col("o_totalprice"), PRICE_BANDS, "Big").alias("price_band"),
        band(F.col("o_custkey"), RATING_BANDS, "High").alias("ratings"),
    )


@query("struct_udf_unpack", BANDS_SQL)
def _(spark, sf):
    pair = label_pair_udf((PRICE_BANDS, "Big"), (RATING_BANDS, "High"), "price_band string, ratings string")
    labelled = table(spark, sf, "orders").select("o_orderkey", pair("o_totalprice", "o_custkey").alias("labels"))
    return unpack(labelled, "labels")


@query(
    "encode_target",
    "SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END::bigint AS label FROM lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"),
        big(encode_target(F.col("l_returnflag"), "R")).alias("label"),
    )


@query(
    "choose_columns",
    """SELECT l_returnflag, l_linestatus, l_discount, l_tax, l_quantity, l_extendedprice FROM lineitem""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    inputs = choose_columns(
        lines.schema, "l_returnflag", include_prefix=["l_"], exclude_suffix=["key"], exclude=["L_LINENUMBER"]
    )
    return lines.select("l_returnflag", *inputs)


# ---- filters -------------------------------------------------------------------------

MISSING_TYPE = "CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_type = 'PROMO' THEN '' ELSE p_type END"


def _parts_with_gaps(spark, sf):
    gaps = F.when(F.col("p_type") == "ECONOMY", None).when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", gaps.alias("kind"))


@query(
    "filter_missing",
    f"SELECT p_partkey, kind FROM (SELECT p_partkey, {MISSING_TYPE} AS kind FROM part) WHERE kind IS NOT NULL AND kind <> ''",
)
def _(spark, sf):
    return filter_missing(_parts_with_gaps(spark, sf), "kind", empty=True)


@query(
    "filter_missing_only",
    f"SELECT p_partkey FROM (SELECT p_partkey, {MISSING_TYPE} AS kind FROM part) WHERE kind IS NULL OR kind = ''",
)
def _(spark, sf):
    return filter_missing(_parts_with_gaps(spark, sf), "kind", keep=True, empty=True).select("p_partkey")


@query("filter_not_null", f"SELECT p_partkey, kind FROM (SELECT p_partkey, {MISSING_TYPE} AS kind FROM part) WHERE kind IS NOT NULL")
def _(spark, sf):
    return require_target(_parts_with_gaps(spark, sf), "kind")


def _part_filter(name, condition, where):
    @query(name, f"SELECT p_partkey, p_name FROM part WHERE {where}")
    def run(spark, sf):
        return table(spark, sf, "part").where(condition()).select("p_partkey", "p_name")


_part_filter("filter_like", lambda: F.col("p_name").like("red%"), "p_name LIKE 'red%'")
_part_filter("filter_not_like", lambda: ~F.col("p_name").like("%g"), "NOT p_name LIKE '%g'")
_part_filter("filter_regex", lambda: F.col("p_name").rlike(r"[a-z]*ring"), "regexp_matches(p_name, '[a-z]*ring')")
_part_filter("filter_regex_word", lambda: F.col("p_name").rlike(r"^\w*d "), r"regexp_matches(p_name, '^\w*d ')")
_part_filter("filter_contains", lambda: F.col("p_name").contains("idge"), "contains(p_name, 'idge')")
_part_filter("filter_sql_text", lambda: F.expr("p_size > 10 and p_type = 'ECONOMY'"), "p_size > 10 AND p_type = 'ECONOMY'")
_part_filter(
    "filter_compound",
    lambda: ((F.col("p_type") == "PROMO") | (F.col("p_size") != 7)) & ~(F.col("p_retailprice") > 1500),
    "(p_type = 'PROMO' OR p_size <> 7) AND NOT (p_retailprice > 1500)",
)

# ---- joins ---------------------------------------------------------------------------

_FILMS = "f AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F')"
_PARTNERS = "c AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"


def _sides(spark, sf):
    films = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    partners = (
        table(spark, sf, "customer")
        .where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
        .select("c_custkey", "c_acctbal")
    )
    return films, partners


def _join(name, how, sql_how):
    @query(
        name,
        f"WITH {_FILMS}, {_PARTNERS} SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_acctbal "
        f"FROM f {sql_how} JOIN c ON o_custkey = c_custkey",
    )
    def run(spark, sf):
        films, partners = _sides(spark, sf)
        return equi_join(films, partners, "o_custkey", "c_custkey", how)


_join("join_inner", "inner", "INNER")
_join("join_left", "left", "LEFT")
_join("join_right", "right", "RIGHT")
_join("join_full", "full", "FULL")


@query("join_anti", f"WITH {_FILMS}, {_PARTNERS} SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM c WHERE c_custkey = o_custkey)")
def _(spark, sf):
    return equi_join(*_sides(spark, sf), "o_custkey", "c_custkey", "left_anti")


@query("join_semi", f"WITH {_FILMS}, {_PARTNERS} SELECT * FROM f WHERE EXISTS (SELECT 1 FROM c WHERE c_custkey = o_custkey)")
def _(spark, sf):
    return equi_join(*_sides(spark, sf), "o_custkey", "c_custkey", "left_semi")


@query("join_broadcast", f"WITH {_FILMS}, {_PARTNERS} SELECT * FROM f WHERE EXISTS (SELECT 1 FROM c WHERE c_custkey = o_custkey)")
def _(spark, sf):
    films, partners = _sides(spark, sf)
    return films.join(broadcast_checked(partners), F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "join_groups",
    """SELECT kind, count(p_size) AS n, sum(p_size)::bigint AS sizes, round(max(p_retailprice), 2) AS dearest
       FROM (SELECT nullif(p_type, 'ECONOMY') AS kind, p_size, p_retailprice FROM part) GROUP BY kind""",
)
def _(spark, sf):
    kind = F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("kind")
    return table(spark, sf, "part").groupBy(kind).agg(
        F.count("p_size").alias("n"), F.sum("p_size").alias("sizes"), rounded(F.max("p_retailprice"), 2).alias("dearest")
    )


@query(
    "join_features_target",
    "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END::bigint AS label FROM orders",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    features = orders.select("o_orderkey", "o_totalprice")
    target = orders.select("o_orderkey", big(encode_target(F.col("o_orderstatus"), "F")).alias("label"))
    return attach_target(features, target, "o_orderkey")


# ---- sorting and sets ----------------------------------------------------------------


@query("sort_desc", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def _(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey")


@query("topn", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "topk_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice, r AS rank_no FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)::bigint AS r
         FROM orders) WHERE r <= 7""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    best = top_per_group(orders, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 7)
    return best.withColumn("rank_no", big("rank_no"))


@query(
    "set_union",
    """SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier
       UNION ALL SELECT c_custkey, c_acctbal FROM customer""",
)
def _(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return suppliers.union(table(spark, sf, "customer").select("c_custkey", "c_acctbal"))


@query("set_membership", "SELECT n_nationkey::bigint AS n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_21')")
def _(spark, sf):
    wanted = F.col("n_name").isin("NATION_1", "NATION_7", "NATION_21")
    return table(spark, sf, "nation").where(wanted).select(big("n_nationkey").alias("n_nationkey"), "n_name")

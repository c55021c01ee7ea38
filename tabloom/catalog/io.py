"""Sources and sinks, checked by reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog.base import big, query, rounded, table, unique_name
from tabloom.operators.sampling import with_normal
from tabloom.session import scratch_path
from tabloom.sources import readers, writers

_TEXT_SQL = """SELECT o_orderkey::varchar AS o_orderkey, o_custkey::varchar AS o_custkey, o_orderstatus,
  o_totalprice::varchar AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM orders"""
_TYPED_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM orders"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderpriority",
    )


def _typed(df):
    return df.select(
        big("o_orderkey").alias("o_orderkey"), big("o_custkey").alias("o_custkey"), "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("day").cast("string").alias("day"), "o_orderpriority",
    )


@query("src_csv_strings", _TEXT_SQL)
def _(spark, sf):
    path = writers.write_delimited(_orders(spark, sf), scratch_path(spark, "strings"), sep="|")
    return readers.read_delimited(spark, path, sep="|")


@query("src_csv_inferred", _TYPED_SQL)
def _(spark, sf):
    path = writers.write_delimited(_orders(spark, sf), scratch_path(spark, "inferred"), sep=";")
    return _typed(readers.read_delimited(spark, path, sep=";", infer=True))


@query("src_csv_schema", _TYPED_SQL)
def _(spark, sf):
    frame = _orders(spark, sf)
    path = writers.write_delimited(frame, scratch_path(spark, "schema"), sep=",")
    return _typed(readers.read_delimited(spark, path, sep=",", schema=frame.schema))


@query("src_table", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    name = unique_name("orders")
    writers.write_table(_orders(spark, sf), name, scratch_path(spark, "table"))
    return readers.read_table(spark, name, ["o_orderkey", "o_totalprice"])


@query(
    "src_table_describe",
    """SELECT column_name AS col_name, CASE data_type WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END AS data_type
       FROM (SELECT column_name, column_type AS data_type FROM (DESCRIBE orders))
       WHERE column_name IN ('o_orderkey', 'o_totalprice', 'o_orderstatus')""",
)
def _(spark, sf):
    name = unique_name("orders")
    writers.write_table(_orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus"), name)
    try:
        return readers.describe_table(spark, name).select("col_name", "data_type")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query(
    "src_json_records",
    """SELECT event_id, user_id, event_type, value, (props::json ->> '$.k')::bigint AS k FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = writers.write_records(events, scratch_path(spark, "records"))
    read = readers.read_records(spark, path, events.schema)
    parsed = readers.parse_records(F.col("props"), "k bigint")
    return read.select("event_id", "user_id", "event_type", "value", parsed["k"].alias("k"))


@query("src_random")
def _(spark, sf):
    drawn = with_normal(table(spark, sf, "lineitem").select("l_orderkey"), 1.0, 2.0, 7, "value")
    return drawn.agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))


@query("view_sql", "SELECT o_orderpriority AS priority, count(o_orderpriority) AS priority_count FROM orders GROUP BY 1")
def _(spark, sf):
    text = "select o_orderpriority as priority, count(o_orderpriority) as priority_count from priced group by o_orderpriority"
    return readers.query_view(table(spark, sf, "orders"), "priced", text)


@query("sink_csv", _TYPED_SQL)
def _(spark, sf):
    frame = _orders(spark, sf)
    path = writers.write_delimited(frame, scratch_path(spark, "csv"), mode="overwrite", max_records=100_000)
    return _typed(readers.read_delimited(spark, path, schema=frame.schema))


@query(
    "sink_csv_partitioned",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
)
def _(spark, sf):
    frame = _orders(spark, sf).select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = writers.write_delimited(frame, scratch_path(spark, "parts"), partition_by=["o_orderstatus"])
    back = readers.read_delimited(spark, path, schema=frame.schema)
    return back.where(F.col("o_orderstatus").isin("F", "P"))


@query("sink_table", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(spark, sf):
    name = unique_name("order_totals")
    writers.write_table(_orders(spark, sf), name, scratch_path(spark, "managed"))
    return readers.query_view(
        spark.table(name), unique_name("v"),
        f"select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from {name} group by o_orderstatus",
    )


@query(
    "sink_json",
    """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","customers":' || customers || '}' AS record
       FROM (SELECT n_nationkey, n_name, count(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL)""",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
    counted = nations.groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).alias("customers"))
    path = scratch_path(spark, "json")
    writers.record_text(counted).write.text(path)
    return spark.read.text(path).withColumnRenamed("value", "record")


@query(
    "fn_json",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS record,
              (props::json ->> '$.k')::bigint AS k FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        "event_id",
        F.to_json(F.struct("event_id", "event_type")).alias("record"),
        readers.parse_records(F.col("props"), "k bigint")["k"].alias("k"),
    )


# ---- scalar functions ----------------------------------------------------------------


@query(
    "fn_string",
    "SELECT p_partkey, trim(lower(concat(p_brand, p_type))) AS category FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.trim(F.lower(F.concat("p_brand", "p_type"))).alias("category"))


@query(
    "fn_date_parts",
    """SELECT o_orderkey, year(o_orderdate)::bigint AS release_year, month(o_orderdate)::bigint AS release_month,
              day(o_orderdate)::bigint AS release_day FROM orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", big(F.year("o_orderdate")).alias("release_year"),
        big(F.month("o_orderdate")).alias("release_month"), big(F.dayofmonth("o_orderdate")).alias("release_day"),
    )


@query(
    "fn_math",
    """SELECT c_custkey, round(pow(c_acctbal, 2), 2) AS squared, round(sqrt(abs(c_acctbal)), 8) AS root,
              round(ln(abs(c_acctbal) + 1), 8) AS logged, abs(c_acctbal) AS size, round(c_acctbal / 7, 4) AS seventh FROM customer""",
)
def _(spark, sf):
    x = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", rounded(F.pow(x, F.lit(2)), 2).alias("squared"), rounded(F.sqrt(F.abs(x)), 8).alias("root"),
        rounded(F.log(F.abs(x) + 1), 8).alias("logged"), F.abs(x).alias("size"), rounded(x / 7, 4).alias("seventh"),
    )


@query(
    "fn_null",
    """SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, CASE WHEN nullif(l_tax, 0.0) IS NULL THEN 1 ELSE 0 END::bigint AS missing,
              coalesce(nullif(l_tax, 0.0), -1.0)::double AS filled FROM lineitem""",
)
def _(spark, sf):
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"),
        big(F.when(F.isnull(tax) | F.isnan(tax), 1).otherwise(0)).alias("missing"),
        F.coalesce(tax, F.lit(-1.0)).alias("filled"),
    )


@query("fn_struct_field", "SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders")
def _(spark, sf):
    packed = table(spark, sf, "orders").select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("s"))
    return packed.select("o_orderkey", F.col("s.status").alias("status"), F.col("s").getField("price").alias("price"))

"""Association statistics, feature transforms without training, and evaluation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.base import (
    LINE_KEY, LINE_ORDER, MODELLING_SQL, NUMERIC, SCORED_SQL, TEXT, big, modelling, query, rounded, scored, table,
)
from tabloom.functions.text import STOPWORDS, tokenize
from tabloom.operators import association, encode, evaluate
from tabloom.operators.ranking import global_ntile
from tabloom.session import written

# ---- weight of evidence --------------------------------------------------------------

SPLITS = {
    "l_quantity": [5.5, 10.5, 15.5, 20.5, 25.5, 30.5, 35.5, 40.5, 45.5],
    "l_discount": [0.015, 0.035, 0.055, 0.075],
    "o_totalprice": [50000, 100000, 150000, 200000, 250000, 300000, 350000, 400000, 450000],
}
WOE_FEATURES = [*SPLITS, *TEXT]


def _woe_rows() -> str:
    selects = []
    for name, splits in SPLITS.items():
        arms = " ".join(f"WHEN {name} < {s} THEN '{i}'" for i, s in enumerate(splits))
        selects.append(f"SELECT '{name}' AS varname, CASE {arms} ELSE '{len(splits)}' END AS bin, {name}::double AS value, y FROM m")
    for name in TEXT:
        source = f"nullif({name}, 'PROMO')" if name == "p_type" else name
        selects.append(f"SELECT '{name}', {source}, NULL::double, y FROM m")
    return " UNION ALL ".join(selects)


WOE_SQL = f"""WITH {MODELLING_SQL}, l AS ({_woe_rows()}),
b AS (SELECT varname, bin, min(value) AS min_value, max(value) AS max_value, count(y) AS "count", sum(y)::bigint AS event,
             count(y) - sum(y)::bigint AS non_event FROM l GROUP BY varname, bin),
d AS (SELECT *, event / sum(event) OVER w AS de, non_event / sum(non_event) OVER w AS dn FROM b WINDOW w AS (PARTITION BY varname)),
v AS (SELECT *, CASE WHEN event > 0 AND non_event > 0 THEN ln(de / dn) ELSE 0 END AS w FROM d)
SELECT varname, bin, min_value, max_value, "count", event, non_event,
       round(event / "count", 8) AS event_rate, round(non_event / "count", 8) AS nonevent_rate,
       round(de, 8) AS dist_event, round(dn, 8) AS dist_nonevent, round(w, 8) + 0.0 AS woe,
       round(sum((de - dn) * w) OVER (PARTITION BY varname), 8) + 0.0 AS iv FROM v"""


def _woe(spark, sf):
    rows = modelling(spark, sf).select(*WOE_FEATURES, "y")
    rows = rows.withColumn("p_type", F.nullif("p_type", F.lit("PROMO")))
    return association.woe_table(rows, WOE_FEATURES, "y", SPLITS)


@query("stat_woe_iv", WOE_SQL)
def _(spark, sf):
    digits = ["event_rate", "nonevent_rate", "dist_event", "dist_nonevent", "woe", "iv"]
    return _woe(spark, sf).select(
        "varname", "bin", "min_value", "max_value", "count", "event", "non_event",
        *[rounded(F.col(c), 8).alias(c) for c in digits],
    )


@query("stat_iv_rank", f"SELECT varname, max(iv) AS iv FROM ({WOE_SQL}) GROUP BY varname ORDER BY iv DESC")
def _(spark, sf):
    return association.iv_table(_woe(spark, sf)).withColumn("iv", rounded(F.col("iv"), 8))


@query("stat_woe_quantile")
def _(spark, sf):
    rows = modelling(spark, sf).select(*NUMERIC, *TEXT, "y")
    return association.woe_table(rows, NUMERIC + TEXT, "y", quantile_bins=20)


_FINE = [i + 0.5 for i in range(1, 50)]

MONO_SQL = f"""WITH {MODELLING_SQL},
u AS (SELECT l_quantity AS x, min(l_quantity) AS lo, max(l_quantity) AS hi, sum(l_quantity) AS total, count(*) AS n, sum(y)::bigint AS event
      FROM m GROUP BY l_quantity),
c AS (SELECT *, sum(n) OVER (ORDER BY x)::bigint AS upto, sum(n) OVER ()::bigint AS all_n FROM u),
p AS (SELECT bins, ceil(upto * bins / all_n)::bigint AS bin, min(lo) AS min_value, max(hi) AS max_value, sum(total) / sum(n) AS mean_value,
             sum(n)::bigint AS "count", sum(event)::bigint AS event, sum(event) / sum(n) AS event_rate
      FROM c CROSS JOIN (SELECT unnest(range(2, 21)) AS bins) GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY bins ORDER BY mean_value) + (count(*) OVER (PARTITION BY bins, mean_value) - 1) / 2 AS rx,
             rank() OVER (PARTITION BY bins ORDER BY event_rate) + (count(*) OVER (PARTITION BY bins, event_rate) - 1) / 2 AS ry FROM p),
s AS (SELECT bins, coalesce(abs(corr(rx, ry)), 0) AS rho FROM r GROUP BY bins),
t AS (SELECT coalesce(max(CASE WHEN rho >= 1 - 1e-9 THEN bins END), 2) AS best FROM s)
SELECT bins, round(rho, 6) AS rho, row_number() OVER (ORDER BY bin) AS bin, min_value, max_value, round(mean_value, 8) AS mean_value,
       "count", event, round(event_rate, 8) AS event_rate
FROM p JOIN s USING (bins) WHERE bins = (SELECT best FROM t)"""


@query("stat_mono_bin", MONO_SQL)
def _(spark, sf):
    rows = modelling(spark, sf).select("l_quantity", "y")
    found = association.monotone_bins(rows, ["l_quantity"], "y", splits={"l_quantity": _FINE})
    return found.select(
        big("bins").alias("bins"), rounded(F.col("rho"), 6).alias("rho"), big("bin").alias("bin"), "min_value", "max_value",
        rounded(F.col("mean_value"), 8).alias("mean_value"), "count", "event", rounded(F.col("event_rate"), 8).alias("event_rate"),
    )


@query("stat_mono_bin_search")
def _(spark, sf):
    return association.monotone_bins(modelling(spark, sf).select(*NUMERIC, "y"), NUMERIC, "y")


# ---- correlation and inflation -------------------------------------------------------

_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice", "o_totalprice"]


def _pair_block() -> str:
    return " UNION ALL ".join(
        f"(SELECT '{a}' AS col1, '{b}' AS col2, corr({a}, {b}) AS value FROM m)" for a in _CORR for b in _CORR
    )


@query("stat_correlation", f"WITH {MODELLING_SQL}, p AS ({_pair_block()}) SELECT col1, col2, round(value, 6) + 0.0 AS value FROM p")
def _(spark, sf):
    pairs = association.correlation_pairs(modelling(spark, sf).select(*_CORR), _CORR)
    return pairs.withColumn("value", rounded(F.col("value"), 6))


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r_{c}" for c in ("l_quantity", "l_extendedprice", "l_tax")
)


@query(
    "stat_correlation_spearman",
    f"""WITH r AS (SELECT {_RANKS} FROM lineitem)
        SELECT a AS col1, b AS col2, round(v, 6) + 0.0 AS value FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr(r_{a}, r_{b}) AS v FROM r"
        for a in ("l_quantity", "l_extendedprice", "l_tax") for b in ("l_quantity", "l_extendedprice", "l_tax")
    )
    + ")",
)
def _(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    pairs = association.correlation_pairs(table(spark, sf, "lineitem").select(*columns), columns, "spearman")
    return pairs.withColumn("value", rounded(F.col("value"), 6))


@query(
    "stat_corr_shortlist",
    f"""WITH {MODELLING_SQL}, p AS ({_pair_block()}) SELECT col1, col2, round(abs(value), 6) AS value FROM p
        WHERE col1 <> col2 AND abs(value) > 0.65""",
)
def _(spark, sf):
    pairs = association.correlation_pairs(modelling(spark, sf).select(*_CORR), _CORR, cutoff=0.65)
    return pairs.withColumn("value", rounded(F.col("value"), 6))


@query(
    "stat_corr_transformer",
    """SELECT * FROM (VALUES ('l_quantity', 'l_extendedprice'), ('l_extendedprice', 'l_quantity')) t(col1, col2),
       (SELECT round(corr(l_quantity, l_extendedprice), 6) AS value FROM lineitem) WHERE value > 0.5""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    pairs = association.correlation_pairs(lines.select(*columns), columns, "pearson", 0.5)
    return pairs.withColumn("value", rounded(F.col("value"), 6))


@query(
    "stat_vif",
    """SELECT f AS feature, round(1 / (1 - c * c), 6) AS vif FROM (SELECT corr(l_quantity, l_extendedprice) AS c FROM lineitem),
       (SELECT unnest(['l_quantity', 'l_extendedprice']) AS f)""",
)
def _(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    found = association.vif(table(spark, sf, "lineitem").select(*columns), columns)
    return found.withColumn("vif", rounded(F.col("vif"), 6))


# With three features the inflation of one is (1 - r23^2) / det of the correlation matrix.
@query(
    "stat_vif_three",
    """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_tax) AS b, corr(l_extendedprice, l_tax) AS d FROM lineitem),
       e AS (SELECT *, 1 + 2 * a * b * d - a * a - b * b - d * d AS det FROM c)
       SELECT 'l_quantity' AS feature, round((1 - d * d) / det, 6) AS vif FROM e
       UNION ALL SELECT 'l_extendedprice', round((1 - b * b) / det, 6) FROM e
       UNION ALL SELECT 'l_tax', round((1 - a * a) / det, 6) FROM e""",
)
def _(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    found = association.vif(table(spark, sf, "lineitem").select(*columns), columns)
    return found.withColumn("vif", rounded(F.col("vif"), 6))


# ---- tests and stability -------------------------------------------------------------


def _chi_sql(features) -> str:
    rows = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f}::varchar AS level, y FROM m" for f in features)
    return f"""WITH {MODELLING_SQL}, l AS ({rows}),
  o AS (SELECT feature, level, y, count(*) AS n FROM l GROUP BY ALL),
  r AS (SELECT feature, level, sum(n) AS r FROM o GROUP BY ALL), k AS (SELECT feature, y, sum(n) AS c FROM o GROUP BY ALL),
  t AS (SELECT feature, sum(n) AS t FROM o GROUP BY ALL),
  x AS (SELECT r.feature, r.level, k.y, coalesce(o.n, 0) AS n, r * c / t AS e FROM r JOIN k ON r.feature = k.feature
        JOIN t ON t.feature = r.feature LEFT JOIN o ON o.feature = r.feature AND o.level = r.level AND o.y = k.y)
  SELECT feature, ((count(DISTINCT level) - 1) * (count(DISTINCT y) - 1))::bigint AS degrees_of_freedom,
         round(sum((n - e) * (n - e) / e), 5) AS statistic FROM x GROUP BY feature"""


@query("test_chisq", _chi_sql(["l_quantity", "p_size", "l_linenumber"]))
def _(spark, sf):
    features = ["l_quantity", "p_size", "l_linenumber"]
    found = association.chi_square(modelling(spark, sf).select(*features, "y"), features, "y")
    return found.select("feature", "degrees_of_freedom", rounded(F.col("statistic"), 5).alias("statistic"))


@query("test_chisq_text", _chi_sql(TEXT))
def _(spark, sf):
    found = association.chi_square_counts(modelling(spark, sf).select(*TEXT, "y"), TEXT, "y")
    return found.select("feature", big("degrees_of_freedom").alias("degrees_of_freedom"), rounded(F.col("statistic"), 5).alias("statistic"))


@query("test_chisq_p_values")
def _(spark, sf):
    features = ["l_quantity", "p_size", "l_linenumber"]
    return association.chi_square(modelling(spark, sf).select(*features, "y"), features, "y")


# The normal law by the power series of the error function, exact for these standard scores.
@query(
    "test_ks_normal",
    """WITH m AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s, count(*) AS n FROM customer),
       z AS (SELECT (c_acctbal - m) / s / sqrt(2) AS x, row_number() OVER (ORDER BY c_acctbal) AS i, n FROM customer, m),
       f AS (SELECT i, n, 0.5 + list_sum(list_transform(range(0, 40), lambda k: pow(-1, k) * pow(x, 2 * k + 1) / (gamma(k + 1) * (2 * k + 1)))) / sqrt(pi()) AS f FROM z)
       SELECT round(max(greatest(i / n - f, f - (i - 1) / n)), 8) AS statistic FROM f""",
)
def _(spark, sf):
    return _ks(spark, sf).select(rounded(F.col("statistic"), 8).alias("statistic"))


@query("test_ks_normal_p_value")
def _(spark, sf):
    return _ks(spark, sf)


def _ks(spark, sf):
    balances = table(spark, sf, "customer").select("c_acctbal")
    moments = balances.agg(F.avg("c_acctbal").alias("m"), F.stddev_samp("c_acctbal").alias("s")).first()  # one row
    return association.ks_normal(balances, "c_acctbal", moments.m, moments.s)


@query(
    "stat_psi",
    """WITH p AS (SELECT o_orderpriority AS bucket, CASE WHEN year(o_orderdate) <= 1998 THEN 1 ELSE 0 END AS e FROM orders),
       g AS (SELECT bucket, sum(e) AS e, sum(1 - e) AS a FROM p GROUP BY bucket),
       s AS (SELECT bucket, e / sum(e) OVER () AS e, a / sum(a) OVER () AS a FROM g)
       SELECT bucket, round(e, 8) AS expected, round(a, 8) AS actual, round((a - e) * ln(a / e), 8) + 0.0 AS psi FROM s""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", F.year("o_orderdate").alias("year"))
    found = association.population_stability(orders.where("year <= 1998"), orders.where("year > 1998"), "o_orderpriority")
    return found.select("bucket", *[rounded(F.col(c), 8).alias(c) for c in ("expected", "actual", "psi")])


# ---- feature transforms --------------------------------------------------------------


def _index_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature, {column} AS label, count(*) AS n,
      (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::double AS "index" FROM part GROUP BY {column}"""


@query("fx_string_index", f"{_index_sql('p_type')} UNION ALL {_index_sql('p_brand')}")
def _(spark, sf):
    _, indexed = encode.fit_index(table(spark, sf, "part"), ["p_type", "p_brand"])
    tables = [
        indexed.groupBy(F.lit(c).alias("feature"), F.col(c).alias("label"), F.col(f"{c}_index").alias("index")).agg(F.count(F.lit(1)).alias("n"))
        for c in ("p_type", "p_brand")
    ]
    return tables[0].unionByName(tables[1])


_VECTOR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEYS_BIG = ", ".join(f"{k}::bigint AS {k}" for k in LINE_KEY)


def _keyed(df):
    return df.withColumn("l_linenumber", big("l_linenumber"))


@query(
    "fx_assemble",
    f"""SELECT {_KEYS_BIG}, 4::bigint AS width, l_quantity AS first, l_tax AS last,
               round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total FROM lineitem""",
)
def _(spark, sf):
    vectors = encode.assemble(table(spark, sf, "lineitem"), _VECTOR, keep=LINE_KEY)
    array = vector_to_array("features")
    return _keyed(vectors.select(
        *LINE_KEY, big(F.size(array)).alias("width"), array[0].alias("first"), array[3].alias("last"),
        rounded(F.aggregate(array, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    ))


@query(
    "fx_scale",
    f"""WITH t AS (SELECT stddev_samp(l_quantity) AS q, stddev_samp(l_extendedprice) AS p, stddev_samp(l_discount) AS d
          FROM lineitem WHERE year(l_shipdate) <= 1998)
        SELECT {_KEYS_BIG}, round(l_quantity / q, 6) AS l_quantity, round(l_extendedprice / p, 6) AS l_extendedprice,
               round(l_discount / d, 6) AS l_discount FROM lineitem, t""",
)
def _(spark, sf):
    columns = _VECTOR[:3]
    lines = table(spark, sf, "lineitem")
    model = encode.fit_scaler(lines.where(F.year("l_shipdate") <= 1998), columns)
    scaled = model.transform(lines).select(*LINE_KEY, *encode.vector_slots("features", columns))
    return _keyed(scaled).withColumns({c: rounded(F.col(c), 6) for c in columns})


@query(
    "fx_normalize",
    f"""SELECT {_KEYS_BIG}, round(l_quantity / t, 10) AS l_quantity, round(l_extendedprice / t, 10) AS l_extendedprice, round(l_tax / t, 10) AS l_tax
        FROM (SELECT *, abs(l_quantity) + abs(l_extendedprice) + abs(l_tax) AS t FROM lineitem)""",
)
def _(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    shares = encode.row_shares(table(spark, sf, "lineitem"), columns)
    plain = shares.select(*LINE_KEY, *encode.vector_slots("features", columns))
    return _keyed(plain).withColumns({c: rounded(F.col(c), 10) for c in columns})


@query("fx_quantile_bin")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    binned = encode.quantile_binner(lines, ["l_quantity", "l_extendedprice"], 20).transform(lines)
    return binned.groupBy("l_extendedprice_bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high")
    )


@query(
    "fx_quantile_bin_exact",
    """SELECT bin, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM (
         SELECT ntile(20) OVER (ORDER BY o_totalprice, o_orderkey)::bigint AS bin, o_totalprice FROM orders) GROUP BY bin""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    binned = global_ntile(orders, "o_totalprice", ["o_orderkey"], 20, descending=False, out="bin")
    return binned.groupBy(big("bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")
    )


@query("fx_pca")
def _(spark, sf):
    loadings, variance = encode.principal_components(modelling(spark, sf).select(*NUMERIC), NUMERIC, 3)
    return loadings.join(variance, "component")


# The shares of two components are the eigenvalues of a 2 x 2 covariance matrix.
@query(
    "fx_pca_variance",
    """WITH c AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount * 100) AS d, covar_samp(l_quantity, l_discount * 100) AS b FROM lineitem),
       e AS (SELECT (a + d) / 2 AS m, sqrt((a - d) * (a - d) / 4 + b * b) AS s FROM c)
       SELECT 1::bigint AS component, round((m + s) / (2 * m), 8) AS share, round((m + s) / (2 * m), 8) AS cumulative FROM e
       UNION ALL SELECT 2, round((m - s) / (2 * m), 8), 1.0 FROM e""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_discount") * 100).alias("points"))
    _, variance = encode.principal_components(lines, ["l_quantity", "points"], 2)
    return variance.select(big("component").alias("component"), rounded(F.col("share"), 8).alias("share"), rounded(F.col("cumulative"), 8).alias("cumulative"))


@query("fx_svd")
def _(spark, sf):
    values, right, _ = encode.singular_values(table(spark, sf, "lineitem").select(*_VECTOR), _VECTOR, 3)
    return right.join(values, "component")


@query(
    "fx_svd_energy",
    """SELECT 4::bigint AS components, round(sum(l_quantity * l_quantity + pow(l_discount * 100, 2) + pow(l_tax * 100, 2) + l_linenumber * l_linenumber), 2) AS energy
       FROM lineitem""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", (F.col("l_discount") * 100).alias("discount"), (F.col("l_tax") * 100).alias("tax"), F.col("l_linenumber").cast("double").alias("line")
    )
    values, _, _ = encode.singular_values(lines, lines.columns, 4)
    return values.agg(F.count(F.lit(1)).alias("components"), rounded(F.sum(F.pow("singular_value", F.lit(2))), 2).alias("energy"))


@query("fx_svd_left")
def _(spark, sf):
    _, _, left = encode.singular_values(table(spark, sf, "lineitem").select(*LINE_KEY, *_VECTOR), _VECTOR, 3, keep=LINE_KEY)
    return left


# Features with the same number of levels rank by their statistic.
_LEVELS = ["l_quantity", "p_size", "part_group"]


@query(
    "fx_chisq_select",
    f"""WITH q AS ({_chi_sql(_LEVELS).replace("FROM m", "FROM (SELECT m.*, l_partkey % 50 AS part_group FROM m)")})
        SELECT feature, row_number() OVER (ORDER BY statistic DESC) <= 2 AS selected FROM q""",
)
def _(spark, sf):
    rows = modelling(spark, sf).select(
        "l_quantity", "p_size", (F.col("l_partkey") % 50).cast("double").alias("part_group"), "y"
    )
    names, _ = encode.chi_square_selector(rows, _LEVELS, "y", 2)
    listed = F.explode(F.array(*[F.lit(f) for f in _LEVELS])).alias("feature")
    counted = rows.agg(F.count(F.lit(1)).alias("n")).select(listed)
    return counted.withColumn("selected", F.col("feature").isin(*names))


@query("fx_chisq_select_text")
def _(spark, sf):
    features = ["l_quantity", "p_size", "l_linestatus_index", "p_brand_index", "p_type_index", "o_orderpriority_index"]
    rows = written(modelling(spark, sf).select("l_quantity", "p_size", *TEXT, "y"), "modelling")  # joined once for four reads
    _, indexed = encode.fit_index(rows, TEXT)
    names, _ = encode.chi_square_selector(indexed, features, "y", 3)
    tested = association.chi_square(indexed, features, "y")
    return tested.withColumn("selected", F.col("feature").isin(*names))


# ---- text ----------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in STOPWORDS if len(w) >= 4)
_TOKENS_SQL = rf"""tok AS (SELECT doc_id, list_filter(string_split_regex(lower(trim(text)), '[\s;,#]'),
   lambda w: length(w) >= 4 AND regexp_matches(w, '^\p{{L}}+$') AND NOT list_contains([{_STOP}], w)) AS words FROM documents)"""


def _tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tokenize(F.col("text")).alias("words"))


@query(
    "fn_tokenize",
    f"WITH {_TOKENS_SQL} SELECT doc_id, len(words) AS n, md5(array_to_string(words, ' ')) AS digest FROM tok",
)
def _(spark, sf):
    return _tokens(spark, sf).select("doc_id", big(F.size("words")).alias("n"), F.md5(F.array_join("words", " ")).alias("digest"))


_TF_SQL = f"""{_TOKENS_SQL}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM tok) GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 10),
  n AS (SELECT count(*) AS n FROM documents)"""


@query(
    "fx_idf",
    f"WITH {_TF_SQL} SELECT term, df, round(ln((n + 1) / (df + 1)), 8) AS idf FROM df, n",
)
def _(spark, sf):
    found = encode.document_frequencies(_tokens(spark, sf), "words", 10)
    return found.withColumn("idf", rounded(F.col("idf"), 8))


@query(
    "fx_tf_idf",
    f"WITH {_TF_SQL} SELECT doc_id, term, tf, round(tf * ln((n + 1) / (df + 1)), 6) AS weight FROM tf JOIN df USING (term), n",
)
def _(spark, sf):
    weights = encode.term_weights(_tokens(spark, sf), "doc_id", "words", 10)
    return weights.select("doc_id", "term", "tf", rounded(F.col("weight"), 6).alias("weight"))


@query(
    "fx_count_vectorizer",
    f"""WITH {_TF_SQL}, v AS (SELECT term, df FROM df JOIN tf USING (term) GROUP BY ALL ORDER BY sum(tf) DESC LIMIT 5000)
        SELECT doc_id, count(v.term) AS terms, coalesce(sum(tf) FILTER (v.term IS NOT NULL), 0)::bigint AS words,
               round(coalesce(sum(tf * ln((n + 1) / (df + 1))), 0), 4) + 0.0 AS weight
        FROM documents LEFT JOIN tf USING (doc_id) LEFT JOIN v USING (term) CROSS JOIN n GROUP BY doc_id""",
)
def _(spark, sf):
    tokens = _tokens(spark, sf)
    vectors = encode.fit_term_vectors(tokens, "words", vocabulary=5000, min_documents=10).transform(tokens)
    counts, weights = vector_to_array("raw_features"), vector_to_array("features")
    nonzero = lambda a: F.size(F.filter(a, lambda x: x > 0))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return vectors.select(
        "doc_id", big(nonzero(counts)).alias("terms"), big(total(counts)).alias("words"), rounded(total(weights), 4).alias("weight")
    )


# ---- evaluation on the closed-form score ---------------------------------------------


@query("ev_confusion", f"WITH {SCORED_SQL} SELECT y::bigint AS actual, prediction::bigint AS predicted, count(*) AS n FROM s GROUP BY ALL")
def _(spark, sf):
    cells = evaluate.confusion(scored(spark, sf), "y", "prediction")
    return cells.select(big("actual").alias("actual"), big("predicted").alias("predicted"), "n")


@query(
    "ev_classification",
    f"""WITH {SCORED_SQL}, c AS (SELECT sum(y * prediction)::bigint AS tp, sum((1 - y) * (1 - prediction))::bigint AS tn,
          sum((1 - y) * prediction)::bigint AS fp, sum(y * (1 - prediction))::bigint AS fn FROM s)
        SELECT tp, tn, fp, fn, round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy, round((fp + fn) / (tp + tn + fp + fn), 8) AS misclassification,
          round(tp / (tp + fp), 8) AS precision, round(tp / (tp + fn), 8) AS recall, round(2 * tp / (2 * tp + fp + fn), 8) AS f1,
          round(tn / (tn + fp), 8) AS specificity, round(fp / (fp + tn), 8) AS false_positive_rate FROM c""",
)
def _(spark, sf):
    found = evaluate.classification_metrics(scored(spark, sf), "y", "prediction")
    return found.select("tp", "tn", "fp", "fn", *[rounded(F.col(c), 8).alias(c) for c in found.columns[4:]])


_POINTS_SQL = f"""{SCORED_SQL}, g AS (SELECT {{score}} AS t, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1),
  p AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM g WINDOW w AS (ORDER BY t DESC))"""
_EXACT = _POINTS_SQL.format(score="score")
_FOUR = _POINTS_SQL.format(score="round(score, 4)")


@query("ev_roc_auc", f"WITH {_EXACT} SELECT round(sum(pos * (nn - fp + neg / 2)) / max(np * nn), 10) AS auc FROM p")
def _(spark, sf):
    return evaluate.roc_auc(scored(spark, sf), "y", "score").select(rounded(F.col("auc"), 10).alias("auc"))


@query(
    "ev_roc_auc_grouped",
    f"""WITH {SCORED_SQL}, g AS (SELECT l_linenumber::bigint AS line, score AS t, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1, 2),
        p AS (SELECT *, sum(neg) OVER (PARTITION BY line ORDER BY t DESC) AS fp, sum(pos) OVER (PARTITION BY line) AS np,
                     sum(neg) OVER (PARTITION BY line) AS nn FROM g)
        SELECT line, round(sum(pos * (nn - fp + neg / 2)) / max(np * nn), 10) AS auc FROM p GROUP BY line""",
)
def _(spark, sf):
    rows = scored(spark, sf).withColumn("line", big("l_linenumber"))
    return evaluate.roc_auc(rows, "y", "score", by=["line"]).withColumn("auc", rounded(F.col("auc"), 10))


@query(
    "ev_pr_auc",
    f"""WITH {_EXACT} SELECT round(sum(pos / np * (tp / (tp + fp) + CASE WHEN tp + fp = pos + neg THEN tp / (tp + fp)
          ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2), 10) AS auc FROM p""",
)
def _(spark, sf):
    return evaluate.pr_auc(scored(spark, sf), "y", "score").select(rounded(F.col("auc"), 10).alias("auc"))


def _curve(found):
    return found.select(rounded(F.col("threshold"), 10).alias("threshold"), rounded(F.col("x"), 8).alias("x"), rounded(F.col("y"), 8).alias("y"))


@query(
    "ev_roc_points",
    f"""WITH {_FOUR} SELECT round(t, 10) AS threshold, round(fp / nn, 8) AS x, round(tp / np, 8) AS y FROM p
        UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""",
)
def _(spark, sf):
    return _curve(evaluate.curve_points(scored(spark, sf), "y", "score", "roc", digits=4))


@query(
    "ev_roc_points_exact",
    f"""WITH {_EXACT} SELECT round(t, 10) AS threshold, round(fp / nn, 8) AS x, round(tp / np, 8) AS y FROM p
        UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0""",
)
def _(spark, sf):
    return _curve(evaluate.curve_points(scored(spark, sf), "y", "score", "roc"))


@query(
    "ev_pr_points",
    f"""WITH {_FOUR} SELECT round(t, 10) AS threshold, round(tp / np, 8) AS x, round(tp / (tp + fp), 8) AS y FROM p
        UNION ALL SELECT NULL, 0.0, (SELECT round(tp / (tp + fp), 8) FROM p ORDER BY t DESC LIMIT 1)""",
)
def _(spark, sf):
    return _curve(evaluate.curve_points(scored(spark, sf), "y", "score", "pr", digits=4))


_KEYS = ", ".join(LINE_ORDER)
_DECILES_SQL = f"""{SCORED_SQL}, n AS (SELECT *, ntile(10) OVER (ORDER BY score DESC, {_KEYS})::bigint AS decile FROM s),
  a AS (SELECT decile, count(*) AS total, sum(y)::bigint AS target, sum(1 - y)::bigint AS non_target, avg(score) AS mean_score FROM n GROUP BY decile),
  c AS (SELECT *, sum(target) OVER (ORDER BY decile)::bigint AS cum_target, sum(non_target) OVER (ORDER BY decile)::bigint AS cum_non_target,
               sum(target) OVER () AS nt, sum(non_target) OVER () AS nn FROM a),
  k AS (SELECT *, cum_target / nt * 100 AS target_dist, cum_non_target / nn * 100 AS non_target_dist FROM c)"""


@query(
    "ev_decile_ks",
    f"""WITH {_DECILES_SQL} SELECT decile, total, target, non_target, round(mean_score, 8) AS mean_score, cum_target, cum_non_target,
          round(target / total * 100, 6) AS target_pct, round(target_dist, 6) AS target_dist, round(non_target_dist, 6) AS non_target_dist,
          round(target_dist - non_target_dist, 6) + 0.0 AS spread FROM k""",
)
def _(spark, sf):
    found = evaluate.decile_table(scored(spark, sf), "y", "score", LINE_ORDER)
    return found.select(
        big("decile").alias("decile"), "total", "target", "non_target", rounded(F.col("mean_score"), 8).alias("mean_score"), "cum_target", "cum_non_target",
        *[rounded(F.col(c), 6).alias(c) for c in ("target_pct", "target_dist", "non_target_dist", "spread")],
    )


@query("ev_ks_value", f"WITH {_DECILES_SQL} SELECT round(max(abs(target_dist - non_target_dist)), 6) AS ks FROM k")
def _(spark, sf):
    deciles = evaluate.decile_table(scored(spark, sf), "y", "score", LINE_ORDER, signed=False)
    return evaluate.ks_value(deciles).select(rounded(F.col("ks"), 6).alias("ks"))


@query(
    "ev_gains_lift",
    f"""WITH {_DECILES_SQL} SELECT decile * 10.0::double AS decile_pct, round(target / total, 8) AS actual, round(mean_score, 8) AS pred,
          round(target_dist, 6) AS gains, round(target_dist / (decile * 10), 8) AS lift FROM k""",
)
def _(spark, sf):
    found = evaluate.gains_table(scored(spark, sf), "y", "score", LINE_ORDER)
    return found.select(
        "decile_pct", rounded(F.col("actual"), 8).alias("actual"), rounded(F.col("pred"), 8).alias("pred"),
        rounded(F.col("gains"), 6).alias("gains"), rounded(F.col("lift"), 8).alias("lift"),
    )


@query(
    "ev_regression",
    """WITH r AS (SELECT l_extendedprice AS y, 1500 * l_quantity + 100 AS p FROM lineitem), a AS (SELECT avg(y) AS m FROM r),
       s AS (SELECT count(*) AS n, avg(pow(y - p, 2)) AS mse, avg(abs(y - p)) AS mae, avg(pow(p - m, 2)) AS ev, avg(pow(y - m, 2)) AS v FROM r, a)
       SELECT n, round(mse, 0) AS mse, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae, round(ev, 0) AS explained_variance,
              round(1 - mse / v, 8) AS r2, round(1 - (mse / v) * (n - 1) / (n - 2), 8) AS r2_adjusted FROM s""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_extendedprice", (1500 * F.col("l_quantity") + 100).alias("p"))
    found = evaluate.regression_metrics(rows, "l_extendedprice", "p")
    digits = {"mse": 0, "rmse": 4, "mae": 4, "explained_variance": 0, "r2": 8, "r2_adjusted": 8}
    return found.select("n", *[rounded(F.col(c), d).alias(c) for c, d in digits.items()])


@query(
    "ev_multiclass",
    """SELECT round(avg(CASE WHEN (l_linenumber % 3) = least(floor(l_quantity / 17), 2) THEN 1.0 ELSE 0.0 END), 10) AS accuracy,
              round(1 - avg(CASE WHEN (l_linenumber % 3) = least(floor(l_quantity / 17), 2) THEN 1.0 ELSE 0.0 END), 10) AS error FROM lineitem""",
)
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 3).alias("label"), F.least(F.floor(F.col("l_quantity") / 17), F.lit(2)).alias("prediction")
    )
    found = evaluate.multiclass_accuracy(rows, "label", "prediction")
    return found.select(rounded(F.col("accuracy"), 10).alias("accuracy"), rounded(F.col("error"), 10).alias("error"))

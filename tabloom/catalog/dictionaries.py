"""Labels and terms numbered by tables instead of driver lists."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.base import big, query, rounded, table
from tabloom.catalog.statistics import _TOKENS_SQL, _index_sql, _tokens
from tabloom.operators import dictionary, topics


def _names_sql() -> str:
    return """SELECT 'c_name' AS feature, c_name AS label, count(*) AS n,
      (row_number() OVER (ORDER BY count(*) DESC, c_name) - 1)::double AS "index" FROM customer GROUP BY c_name"""


@query("fx_label_index", f"{_index_sql('p_type')} UNION ALL {_index_sql('p_brand')} UNION ALL {_names_sql()}")
def _(spark, sf):
    """Few labels and as many labels as rows, by one way."""
    found = None
    for name, column in (("part", "p_type"), ("part", "p_brand"), ("customer", "c_name")):
        rows = table(spark, sf, name).select(column)
        indexed = dictionary.encode_labels(rows, column, dictionary.fit_labels(rows, column), "index", hot_labels=10)
        counted = indexed.groupBy(F.lit(column).alias("feature"), F.col(column).alias("label"), "index").agg(F.count(F.lit(1)).alias("n"))
        found = counted if found is None else found.unionByName(counted)
    return found


_ALL_SQL = f"""WITH {_TOKENS_SQL}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM tok) GROUP BY ALL),
  v AS (SELECT term, sum(tf)::bigint AS n, count(*) AS df, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS "index" FROM tf GROUP BY term),
  docs AS (SELECT count(*) AS n_docs FROM documents)"""


@query("fx_term_dictionary", f'{_ALL_SQL} SELECT term AS label, n, df, "index" FROM v')
def _(spark, sf):
    """Every term of the documents, however rare."""
    return dictionary.fit_terms(dictionary.counted_terms(_tokens(spark, sf), "doc_id", "words"), min_documents=1, size=None)


@query(
    "fx_term_vectors",
    f"""{_ALL_SQL} SELECT doc_id, count(*) AS terms, sum(tf)::bigint AS words, sum("index" * tf)::bigint AS places,
        max("index")::bigint AS last, round(sum(tf * ln((n_docs + 1) / (df + 1))), 4) + 0.0 AS weight
        FROM tf JOIN v USING (term), docs GROUP BY doc_id""",
)
def _(spark, sf):
    """Sparse vectors over all terms; read back entry by entry, as their full width is the number of terms."""
    vectors, _ = dictionary.term_vectors(_tokens(spark, sf), "doc_id", "words", min_documents=1)
    parts = F.from_json(F.to_json(F.struct("raw_features", "features")), _PARTS)
    counts, weights = F.col("p.raw_features"), F.col("p.features")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    products = F.zip_with(counts["indices"], counts["values"], lambda i, x: i * x)
    return vectors.select("doc_id", parts.alias("p")).select(
        "doc_id", big(F.size(counts["indices"])).alias("terms"), big(total(counts["values"])).alias("words"),
        big(total(products)).alias("places"), big(F.array_max(counts["indices"])).alias("last"),
        rounded(total(weights["values"]), 4).alias("weight"),
    )


_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
_PARTS = f"raw_features {_VECTOR}, features {_VECTOR}"


@query("un_lda_facts", "SELECT 5::bigint AS topics, 25::bigint AS n, 0::bigint AS unknown, 0::bigint AS repeated, 0::bigint AS outside, 0::bigint AS rising")
def _(spark, sf):
    """Topics over the table's vectors: five terms each, known, once each, by falling weight between 0 and 1."""
    tokens = _tokens(spark, sf).where(F.col("words").isNotNull())
    vectors, terms = dictionary.term_vectors(tokens, "doc_id", "words", min_documents=10, size=5000)
    model = topics.fit_topics(vectors.select("doc_id", "features"), iterations=20)
    named = dictionary.name_topics(model, terms, 5).join(terms.select(F.col("label").alias("term"), "df"), "term", "left")
    by_topic = named.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("term").alias("terms"),
        F.count(F.when(F.coalesce(F.col("df"), F.lit(0)) < 10, 1)).alias("unknown"),
        F.count(F.when(~F.col("weight").between(0, 1), 1)).alias("outside"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "weight"))), lambda r: r["weight"]).alias("weights"),  # five
    )
    rises = F.size(F.filter(F.sequence(F.lit(1), F.size("weights") - 1), lambda i: F.col("weights")[i] > F.col("weights")[i - 1]))
    return by_topic.agg(
        F.count(F.lit(1)).alias("topics"), F.sum("n").alias("n"), F.sum("unknown").alias("unknown"),
        F.sum(F.col("n") - F.col("terms")).alias("repeated"), F.sum("outside").alias("outside"), big(F.sum(rises)).alias("rising"),
    )

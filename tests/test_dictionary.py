"""Numbered labels and term vectors against Spark's own, beyond their limits, and on odd rows."""

import pytest
from pyspark.ml.feature import CountVectorizer, IDF, StringIndexer
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tabloom.operators import dictionary
from tabloom.operators.ranking import numbered

WORDS = [(1, ["b", "a", "b", "c"]), (2, ["a"]), (3, []), (4, None), (5, ["c", "é", "a", "日本"]), (6, ["a", "a"])]


def test_numbers_as_string_indexer(spark):
    values = ["b", "a", "c", "c", None, "", "B", "é", "a b"] * 3 + ["c", "zz"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("n", F.lit("own"))
    fitted = StringIndexer(inputCol="v", outputCol="w", handleInvalid="keep").fit(df)
    more = df.union(spark.createDataFrame([(99, "unseen", "own")], df.schema))
    labels = dictionary.fit_labels(df, "v")
    wanted = {(r.i, r.v, r.w) for r in fitted.transform(more).collect()}
    for hot in (0, 2, 1000):
        mine = dictionary.encode_labels(more, "v", labels, hot_labels=hot)
        assert mine.columns == ["i", "v", "n", "v_index"]
        assert {(r.i, r.v, r.v_index) for r in mine.collect()} == wanted


def test_vectors_as_count_vectorizer(spark):
    tokens = spark.createDataFrame(WORDS, "doc_id int, words array<string>")
    plain = tokens.where(F.col("words").isNotNull())
    counts = CountVectorizer(inputCol="words", outputCol="raw_features", minDF=1.0).fit(plain)
    weighted = IDF(inputCol="raw_features", outputCol="features").fit(counts.transform(plain))
    spelled = lambda v, names: {names[i]: x for i, x in zip(v.indices.tolist(), v.values.tolist())}
    wanted = {r.doc_id: (spelled(r.raw_features, counts.vocabulary), spelled(r.features, counts.vocabulary)) for r in weighted.transform(counts.transform(plain)).collect()}
    for hot in (0, 1, 1000):
        vectors, terms = dictionary.term_vectors(plain, "doc_id", "words", min_documents=1, hot_labels=hot)
        names = {r["index"]: r.label for r in terms.collect()}
        assert [names[i] for i in range(len(names))][:2] == ["a", "b"] and len(names) == 5
        rows = vectors.collect()
        assert {r.doc_id for r in rows} == {1, 2, 5, 6}
        for r in rows:
            assert isinstance(r.features, SparseVector) and r.features.size == 5
            assert spelled(r.raw_features, names) == wanted[r.doc_id][0]
            assert spelled(r.features, names) == pytest.approx({k: x for k, x in wanted[r.doc_id][1].items()})


def test_terms_by_documents_and_size(spark):
    tokens = spark.createDataFrame(WORDS, "doc_id int, words array<string>")
    counted = dictionary.counted_terms(tokens, "doc_id", "words")
    rows = lambda t: [tuple(r) for r in t.orderBy("index").collect()]
    assert rows(dictionary.fit_terms(counted, 2, None)) == [("a", 5, 4, 0), ("c", 2, 2, 1)]
    assert rows(dictionary.fit_terms(counted, 1, 2)) == [("a", 5, 4, 0), ("b", 2, 1, 1)]


def test_nothing_to_number(spark):
    none = spark.createDataFrame([], "doc_id int, words array<string>, v string")
    assert dictionary.encode_labels(none, "v", dictionary.fit_labels(none, "v")).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id int, v string")
    assert [r.v_index for r in dictionary.encode_labels(nulls, "v", dictionary.fit_labels(nulls, "v")).collect()] == [0.0]
    vectors, terms = dictionary.term_vectors(none, "doc_id", "words", min_documents=1)
    assert vectors.collect() == [] and terms.collect() == []


def test_more_labels_than_a_driver_list_may_hold(spark):
    """1.2 million labels, a third of the rows on one of them."""
    df = spark.range(1_800_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v"))
    labels = dictionary.fit_labels(df, "v")
    facts = labels.agg(F.count("*"), F.count_distinct("index"), F.max("index"), F.sum("n")).first()
    assert tuple(facts) == (1_200_001, 1_200_001, 1_200_000, 1_800_000)
    assert labels.where("label = 'hot'").first()["index"] == 0
    # Ties of all other labels are in the order of their names.
    rest = labels.where("index > 0").selectExpr("index", "label").orderBy("label").limit(1000).collect()
    assert [r["index"] for r in rest] == list(range(1, 1001))


def test_numbered_cuts_a_tie_along_text(spark):
    """A value on all rows is spread over partitions by its text tie-break key."""
    df = spark.range(20_000).select(F.lit(7).alias("x"), F.md5(F.col("id").cast("string")).alias("key"), F.lit("own").alias("place"))
    placed = numbered(df, [F.col("x").desc(), F.col("key")], "at").cache()
    rows = placed.orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(20_000)) and [r.key for r in rows] == sorted(r.key for r in rows)
    ordered = df.repartitionByRange(4, F.col("x").desc(), F.col("key"))
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000

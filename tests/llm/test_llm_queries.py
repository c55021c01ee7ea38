"""The registered queries beside their SQL checks, and the pipeline's stages on a small fixture."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from tabloom.llm.queries import CHECKS, QUERIES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_rows_match_sql(spark, sf, name):
    assert oracle.compare(QUERIES[name](spark, sf), oracle.connect(sf), CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_one_row_for_each_document_at_least(spark, sf, name):
    docs = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    rows = QUERIES[name](spark, sf).collect()
    assert {r.doc_id for r in rows} == docs
    assert name == "op2_packing" or len(rows) == len(docs)


def test_stages_in_order_and_registered():
    import __spark_entry__ as entry_points

    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["identify", "drop_lines", "drop_near_copies", "drop_leaks", "pack"]
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql())


def test_stages_by_hand(spark, sf):
    """Each stage on its own input, held against what its operator reports for that input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("extra", F.lit(1))
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf).cache()
        assert after.columns == [*COLUMNS, "extra"]
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in before.select("doc_id").collect()}
        if stage is corpus_pipeline.drop_near_copies:
            groups = {r.doc_id: r.component_id for r in QUERIES_ON(spark, before).collect()}
            assert set(ids) == set(groups.values())
        if stage is corpus_pipeline.drop_leaks:
            from tabloom.llm.decontaminate import contamination

            found = contamination(before, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
            assert set(ids) == {r.doc_id for r in found if not r.contaminated}
            assert len(ids) < len(found)
        before = after
    pieces = corpus_pipeline.pack(spark, before, sf)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}


def QUERIES_ON(spark, docs):
    from tabloom.llm.simhash import near_groups

    return near_groups(docs, shingle=3, distance=2)


def test_stages_on_odd_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "12 34", "en", None, 5), (None, "the word and the other", None, "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, sf).columns == COLUMNS
            stage(spark, table, sf).collect()
        assert corpus_pipeline.pack(spark, table, sf).count() == table.count()

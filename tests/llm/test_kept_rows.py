"""Which rows stay in near-dedup: by row, not by id."""

import random

from tabloom.llm import simhash


def test_rows_without_id_and_with_shared_ids(spark):
    rng = random.Random(5)
    text = lambda: " ".join(str(rng.random()) for _ in range(200))
    lone, other, copied, mine = (text() for _ in range(4))
    rows = [(None, lone), (None, lone), (None, other), (1, copied), (2, copied), (2, mine), (None, copied)]
    for _ in range(3):
        rng.shuffle(rows)
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3).collect()
        # Id 2 stands for its own text; its copy of document 1 is the row that goes.
        wanted = [(None, lone), (None, other), (1, copied), (2, mine)]
        assert sorted(map(str, kept)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in wanted)


def test_repeated_rows_and_clashing_names(spark):
    rng = random.Random(6)
    text = " ".join(str(rng.random()) for _ in range(200))
    rows = [(4, text, "a", i) for i in range(50)] + [(2, None, "b", 0), (3, "", "c", 0), (9, "two words", "d", 1), (9, "two words", "d", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, KEY_ int").withColumnRenamed("KEY_", "_Key")
    kept = simhash.keep_one(docs, shingle=3)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.key) for r in kept.collect()) == [(2, None, "b"), (4, text, "a"), (9, "two words", "d")]
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_documents_are_not_copied(spark, sf):
    """Next to the documents only keys are joined: the plan reads no second table that holds texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = simhash.keep_one(docs, shingle=3, distance=2)._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "Relation" in line]
    assert all("text#" not in line or "n_chars#" in line for line in reads) and any("text#" in line for line in reads)

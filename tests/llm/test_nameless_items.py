"""Benchmark items without an id mark hits and add no name."""

import hashlib

import pytest

from tabloom.llm import decontaminate


@pytest.mark.parametrize("bound", [1_000_000, 10])
def test_nameless_items_contaminate(spark, bound):
    long, short = " ".join(f"w{i}" for i in range(12)), "tiny item"
    docs = spark.createDataFrame([(1, f"a {long} b"), (2, f"c {short}"), (3, "clean words only")], "doc_id long, text string")
    items = spark.createDataFrame([(None, long), (None, short), (7, short)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items, max_words=bound).collect()}
    assert {i: (r.n_hit, r.items, r.contaminated) for i, r in got.items()} == {
        1: (12, [], True), 2: (2, ["7"], True), 3: (0, [], False)
    }
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest() and got[1].n_items == 0
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [3]

"""Repeated vectors spread over the shards of the top-k search."""

import random

from pyspark.sql import functions as F

from tabloom.llm import ball_tree


def test_no_shard_holds_all_repeated_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, [0.5] * 4)] * 400 + [(i, [rng.gauss(0, 0.2) for _ in range(4)]) for i in range(2, 402)]
    path = spark.sparkContext.accumulator(0)
    whole = ball_tree._search

    def watched(k):
        search = whole(k)

        def seen(queries, part):
            if len(part) > 160:
                path.add(1)
            return search(queries, part)

        return seen

    monkeypatch.setattr(ball_tree, "_search", watched)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ball_tree.top_k(table, F.col("id") % 100 == 0, shard_rows=80).collect()
    assert len(found) == 4 * 10 and path.value == 0

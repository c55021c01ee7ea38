"""Topics by blocks of documents beside Spark's own form."""

import random

import pytest
from pyspark.ml.linalg import Vectors

from tabloom.operators import topics


def test_blocks_give_what_the_graph_gives(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(Vectors.sparse(30, sorted((t, rng.choice([0.0, 0.5, 1.0, 2.5])) for t in rng.sample(range(10 * (i % 3), 10 * (i % 3) + 12 if i % 3 < 2 else 30), rng.randint(1, 9)))),) for i in range(60)]
    rows += [(Vectors.sparse(30, [], []),), (Vectors.dense([0.0] * 27 + [1.0, 2.0, 3.0]),)]
    df = spark.createDataFrame(rows, ["features"]).repartition(3).persist()
    monkeypatch.setattr(topics, "CHECKPOINT_EVERY", 4)
    wanted = topics.fit_topics(df, 3, 12, "graph", seed=77)
    found = topics.fit_topics(df, 3, 12, seed=77)
    assert isinstance(found, topics.TopicCounts) and found.vocabSize() == 30
    assert found.topicsMatrix().toArray() == pytest.approx(wanted.topicsMatrix().toArray(), rel=1e-6, abs=1e-9)
    for a, b in zip(found.describeTopics(4).collect(), wanted.describeTopics(4).collect()):
        assert a.topic == b.topic and a.termWeights == pytest.approx(b.termWeights, rel=1e-6)
    df.unpersist()


def test_blocks_of_any_size(monkeypatch):
    """Where blocks end changes nothing, and the first weights go on from block to block."""
    rng = random.Random(4)
    rows = [(Vectors.sparse(9, sorted((t, 1.0 + t) for t in rng.sample(range(9), 4))),) for _ in range(20)]
    sums = []
    for size in (1, 7, 1000):
        monkeypatch.setattr(topics, "BLOCK_ENTRIES", size)
        blocks = list(topics._step(iter(list(topics._blocks(2, iter(rows), 9, 3, 5))), topics.np.ones((9, 3))))
        assert [b[4] is None for b in blocks] == [True] * (len(blocks) - 1) + [False]
        sums.append(blocks[-1][4])
    assert sums[0] == pytest.approx(sums[1]) and sums[0] == pytest.approx(sums[2])


def test_no_vectors_of_known_size(spark):
    """Refused as before: there is nothing to learn from."""
    with pytest.raises(Exception):
        topics.fit_topics(spark.createDataFrame([], "features struct<a: int>"))

"""Topic models over weighted term vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseMatrix, SparseVector
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.session import ensure_checkpoints


MODEL_BYTES = 256 << 20
BLOCK_ENTRIES = 200_000
CHECKPOINT_EVERY = 25


def fit_topics(
    vectors: DataFrame, topics: int = 5, iterations: int = 100, optimizer: str = "em",
    features_col: str = "features", seed: int = 12345,
):
    """Latent Dirichlet allocation over every document in every iteration (``em``).

    ``em`` takes the steps, priors and first weights of Spark's own expectation maximisation, over blocks of
    documents instead of a graph of terms and documents: an iteration moves the terms x topics counts and
    no entry of a document. It gives a ``TopicCounts``. ``graph`` is Spark's form with Spark's model, also taken
    where terms x topics pass ``MODEL_BYTES``; its graph is checkpointed every ten iterations.
    ``online`` reads a share of the documents per iteration.
    """
    ensure_checkpoints(vectors.sparkSession)
    if optimizer == "em":
        head = vectors.select(features_col).where(F.col(features_col).isNotNull()).first()
        terms = len(head[0]) if head else 0
        if 0 < terms * topics * 8 <= MODEL_BYTES:
            return _expectation_maximisation(vectors.select(features_col), terms, topics, iterations, seed)
        optimizer = "graph"
    return LDA(
        k=topics, maxIter=iterations, optimizer="em" if optimizer == "graph" else optimizer, featuresCol=features_col,
        seed=seed, checkpointInterval=10,
    ).fit(vectors)


@dataclass
class TopicCounts:
    """Expected counts of terms x topics, described as Spark's topic models are."""

    spark: SparkSession
    counts: np.ndarray

    def vocabSize(self) -> int:
        return len(self.counts)

    def topicsMatrix(self) -> DenseMatrix:
        return DenseMatrix(*self.counts.shape, self.counts.ravel(order="F"))

    def describeTopics(self, maxTermsPerTopic: int = 10) -> DataFrame:
        """(topic, termIndices, termWeights), by falling weight; equal weights by index."""
        rows = []
        for topic, column in enumerate((self.counts / self.counts.sum(axis=0)).T):
            best = np.argsort(-column, kind="stable")[:maxTermsPerTopic]
            rows.append((topic, best.tolist(), column[best].tolist()))
        return self.spark.createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")


def _uniforms(state: int, n: int) -> tuple[np.ndarray, int]:
    """The next ``n`` doubles of the 48-bit generator that Spark's first weights are drawn from, and its new state."""
    step, add, mask = 0x5DEECE66D, 0xB, (1 << 48) - 1
    states = np.empty(2 * n, np.uint64)
    states[:1], done = (state * step + add) & mask, 1
    while done < 2 * n:
        more = min(done, 2 * n - done)
        states[done : done + more] = (states[:more] * np.uint64(step) + np.uint64(add)) & np.uint64(mask)
        step, add, done = step * step & mask, (step * add + add) & mask, done + more
    high, low = states[0::2] >> np.uint64(22), states[1::2] >> np.uint64(21)
    return ((high << np.uint64(27)) + low) * 2.0**-53, int(states[-1])


def _blocks(part: int, rows: Iterator, terms: int, topics: int, seed: int) -> Iterator[tuple]:
    """(documents' lengths, term of each entry, its weight, documents x topics, none) of about ``BLOCK_ENTRIES``
    entries each; the last one of a partition holds the partition's terms x topics."""
    state = ((part + seed) ^ 0x5DEECE66D) & ((1 << 48) - 1)
    by_term, sizes, places, weights, entries, held = np.zeros((terms, topics)), [], [], [], 0, None

    def block() -> tuple:
        nonlocal state
        lengths, at, weight = np.array(sizes), np.concatenate(places).astype(np.int32), np.concatenate(weights)
        share, state = _uniforms(state, len(at) * topics)
        share = share.reshape(-1, topics)
        share = np.ascontiguousarray((share / share.sum(axis=1, keepdims=True) * weight[:, None]).T)
        return lengths, at, weight, _gather(share, lengths, at, by_term)

    for (vector,) in rows:
        if vector is None:
            raise ValueError("a document without a vector")
        if isinstance(vector, SparseVector):
            place, weight = vector.indices, vector.values
        else:
            place, weight = np.arange(len(vector)), vector.toArray()
        if not weight.all():
            place, weight = place[weight != 0], weight[weight != 0]
        if not len(place):
            continue
        sizes.append(len(place)), places.append(place), weights.append(weight)
        entries += len(place)
        if entries >= BLOCK_ENTRIES:
            if held:
                yield *held, None
            held = block()
            sizes, places, weights, entries = [], [], [], 0
    if sizes:
        if held:
            yield *held, None
        held = block()
    if held:
        yield *held, by_term


def _gather(share: np.ndarray, lengths: np.ndarray, at: np.ndarray, by_term: np.ndarray) -> np.ndarray:
    """Documents x topics of a block's topics x entries, which are added to ``by_term`` too."""
    for topic, row in enumerate(share):
        by_term[:, topic] += np.bincount(at, row, len(by_term))
    return np.add.reduceat(share, np.cumsum(lengths) - lengths, axis=1).T


def _step(blocks: Iterator[tuple], by_term: np.ndarray) -> Iterator[tuple]:
    """The blocks after an iteration that starts from the terms x topics of the one before."""
    terms, topics = by_term.shape
    alpha, eta = 50.0 / topics, 0.1  # Spark's defaults for ``em``, each less 1
    held, found = None, np.zeros((terms, topics))
    factor = np.ascontiguousarray(((by_term + eta) / (by_term.sum(axis=0) + terms * eta)).T)
    for lengths, at, weight, by_document, _ in blocks:
        if held:
            yield *held, None
        share = np.empty((topics, len(at)))
        for topic in range(topics):
            np.multiply(factor[topic][at], np.repeat(by_document[:, topic] + alpha, lengths), out=share[topic])
        share *= weight / share.sum(axis=0)
        held = lengths, at, weight, _gather(share, lengths, at, found)
    if held:
        yield *held, found


def _expectation_maximisation(vectors: DataFrame, terms: int, topics: int, iterations: int, seed: int) -> TopicCounts:
    spark = vectors.sparkSession
    held = StorageLevel.MEMORY_AND_DISK
    total = lambda rdd: rdd.map(lambda b: b[4]).filter(lambda t: t is not None).treeAggregate(
        np.zeros((terms, topics)), np.add, np.add
    )
    blocks = vectors.rdd.mapPartitionsWithIndex(lambda part, rows: _blocks(part, rows, terms, topics, seed)).persist(held)
    blocks.checkpoint()  # the entries' order does not change from here on
    counts, sent = total(blocks), []
    for done in range(1, iterations + 1):
        before, shared = blocks, spark.sparkContext.broadcast(counts)
        blocks = before.mapPartitions(lambda rows, shared=shared: _step(rows, shared.value)).persist(held)
        if done % CHECKPOINT_EVERY == 0 and done < iterations:
            blocks.checkpoint()
        counts = total(blocks)
        before.unpersist()
        sent.append(shared)
        if blocks.isCheckpointed():  # of all before, only the counts that made these blocks are named on
            for old in sent[:-1]:
                old.destroy()
            sent = sent[-1:]
    blocks.unpersist()
    for shared in sent:
        shared.destroy()
    return TopicCounts(spark, counts)


def topic_terms(model, terms: PipelineModel, top: int = 5) -> DataFrame:
    """(topic, place, term, weight): the heaviest terms of each topic."""
    counts = next(s for s in terms.stages if isinstance(s, CountVectorizerModel))
    described = model.describeTopics(top)
    spark = described.sparkSession
    words = spark.createDataFrame(list(enumerate(counts.vocabulary)), "id int, term string")
    rows = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    return rows.join(F.broadcast(words), F.col("t.termIndices") == F.col("id")).select(  # vocabulary is capped
        "topic", (F.col("place") + 1).alias("place"), "term", F.col("t.termWeights").alias("weight")
    )

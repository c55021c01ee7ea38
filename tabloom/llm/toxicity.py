"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's character n-grams are hashed; each hashed n-gram that occurs is a feature whose value is
the log ratio of its document shares in toxic and clean training texts. A logistic regression over
the features that tell most about the label gives weight times ratio for each. Whole texts are
scored; a feature counts once however often it occurs, so that a long text is judged like a short
one.

The classifier is fitted on a bounded sample of labelled rows (``sample_rows``) and holds
``features`` weights. N-gram counts and features are made on the executors; the driver gets one
row per hashed n-gram and the few chosen features of each sampled row.

Cases: null and empty texts score by the intercept alone; without labels, or with one class only,
every score is the share of toxic labels (0 without labels); a document labelled several times is
toxic if any row says so; rows with null ids or labels are not learned from; repeated documents
are learned from once and each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, stored

ORDERS = (3, 4, 5)
BITS = 18


def hashed_grams(text: str | None, orders: tuple[int, ...] = ORDERS, bits: int = BITS):
    """Buckets of all character n-grams of a text, with repeats."""
    import numpy as np

    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rolled, out = codes, []
    for n in range(2, max(orders) + 1):
        if len(codes) < n:
            break
        rolled = rolled[:-1] * np.uint32(0x9E3779B1) + codes[n - 1 :]
        if n in orders:
            out.append((rolled * np.uint32(0x85EBCA6B) + np.uint32(n)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


@dataclass
class GramModel:
    """``weights`` of all buckets (0 if not chosen) and the intercept."""

    weights: Any
    chosen: Any
    intercept: float

    def score(self, text: str | None) -> float:
        import math

        import numpy as np

        found = hashed_grams(text)
        value = self.intercept + float(self.weights[np.unique(found[self.chosen[found]])].sum())
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, value))))


def _document_counts(batches: Iterator) -> Iterator:
    """(bucket, toxic documents, clean documents) of a task, in one pass and bounded memory."""
    import numpy as np
    import pyarrow as pa

    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[toxic, np.unique(hashed_grams(text.as_py()))] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(counts[1, used]), pa.array(counts[0, used])], names=["bucket", "toxic", "clean"]
    )


def _chosen_grams(places):
    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        place = places.value
        for batch in batches:
            found = [place[np.unique(hashed_grams(t.as_py()))] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([f[f >= 0] for f in found], pa.list_(pa.int32()))], names=["y", "at"]
            )

    return find


def _told(toxic, clean, n_toxic: int, n_clean: int):
    """How much each feature tells about the label (mutual information, in nats times rows)."""
    import numpy as np

    total = n_toxic + n_clean
    out = np.zeros(len(toxic))
    for seen, size in ((toxic, n_toxic), (clean, n_clean), (n_toxic - toxic, n_toxic), (n_clean - clean, n_clean)):
        have = toxic + clean if seen is toxic or seen is clean else total - toxic - clean
        part = seen * (np.log(np.maximum(seen, 1)) - np.log(np.maximum(have * (size / total), 1e-9)))
        out += np.where(seen > 0, part, 0.0)
    return out


def logistic(rows, columns, values, labels, width: int, ridge: float, steps: int):
    """Weights and intercept of a ridge logistic regression on sparse rows, by adaptive-moment steps.

    Both labels weigh the same in all, so that a rare label is not drowned.
    """
    import numpy as np

    size = len(labels)
    weigh = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, size - labels.sum()))
    params = np.zeros(width + 1)
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        margin = params[width] + np.bincount(rows, params[columns] * values, size)
        slope = weigh * (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - labels)
        gradient = np.append(np.bincount(columns, slope[rows] * values, width) + ridge * params[:width], slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        params = params - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return params[:width], float(params[width])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = 12_000, features: int = 4096, ridge: float = 1e-3, steps: int = 120,
) -> GramModel:
    import numpy as np

    spark = docs.sparkSession
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    sample = bounded_sample(known, ["_id"], sample_rows)
    # Of about sample_rows short rows: broadcast, so that texts are not shuffled to find them.
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(sample), "_id")
    rows = rows.groupBy("_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).select("text", "y")
    rows = stored(rows, "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        flat = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return GramModel(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, bool), flat if sizes else -60.0)
    counts = rows.mapInArrow(_document_counts, "bucket long, toxic long, clean long")
    counts = counts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()
    counts = counts.sort_values("bucket")
    toxic, clean = counts["toxic"].to_numpy(), counts["clean"].to_numpy()
    ratio = np.log((toxic + 1) / (n_toxic + 2)) - np.log((clean + 1) / (n_clean + 2))
    best = np.argsort(-_told(toxic, clean, n_toxic, n_clean), kind="stable")[:features]
    buckets, ratio = counts["bucket"].to_numpy()[best], ratio[best]
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[buckets] = np.arange(len(buckets))
    found = rows.mapInArrow(_chosen_grams(spark.sparkContext.broadcast(place)), "y int, at array<int>").toPandas()
    at = [np.asarray(a, dtype=np.int64) for a in found["at"]]
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    column = np.concatenate(at)
    learned, intercept = logistic(row, column, ratio[column], found["y"].to_numpy(float), len(buckets), ridge, steps)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[buckets] = learned * ratio
    return GramModel(weights, place >= 0, intercept)


def score(docs: DataFrame, model: GramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every document."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_one = shared.value.score
        for batch in batches:
            found = pa.array([score_one(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(judge, f"`{id_col}` {kind}, score double")

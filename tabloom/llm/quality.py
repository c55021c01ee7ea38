"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a vector of hashed words and word shapes (letters as ``A`` or ``a``, digits as ``0``, runs
shortened), by their share of the text. One set of weights is shared by all grades; ordered
thresholds turn the weighted sum into the probability of each grade or less. Results are the
expected grade and the probability of the top grades, by which texts are selected.

The model is fitted on a bounded sample of rated rows (``sample_rows``); features are made on the
executors and every document is scored as a whole.

Cases: null and empty texts have no features and are scored by the thresholds; without ratings, or
with one grade only, every text gets that grade (0 without ratings); a document rated several times
has its lowest rating; rows with null ids or ratings are not learned from; repeated documents are
learned from once and each give a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, stored
from tabloom.llm.token_ids import Recent

BITS = 16
KEPT_WORDS = 200_000
_LETTER, _SMALL = re.compile(r"[^\W\d_]"), re.compile(r"[a-zß-öø-ÿ]")


def _kind(char: str) -> str:
    if char.isdecimal():
        return "0"
    return ("a" if _SMALL.match(char) else "A") if _LETTER.match(char) else char


class _Kinds(dict):
    """The kind of every character met, by code point, as ``str.translate`` asks for it."""

    def __missing__(self, code: int) -> str:
        self[code] = kind = _kind(chr(code))
        return kind


_KINDS = _Kinds()


def _shortened(kinds: str) -> str:
    return re.sub(r"(.)\1+", r"\1\1", re.sub(r"([Aa0])\1+", r"\1", kinds))


def shape_of(word: str) -> str:
    return _shortened(word.translate(_KINDS))


def _shape_place(kinds: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest("s" + _shortened(kinds)) & ((1 << BITS) - 1)


_SHAPES = Recent(_shape_place, KEPT_WORDS)


def _places(word: str) -> int:
    """The bucket of a word and, below it, the bucket of its shape."""
    import xxhash

    return (xxhash.xxh32_intdigest("w" + word) & ((1 << BITS) - 1)) << BITS | _SHAPES[word.translate(_KINDS)]


_KNOWN = Recent(_places, KEPT_WORDS)


def features_of(text: str | None) -> tuple[Any, Any]:
    """Arrays of buckets and values of a text: shares of words and shapes, scaled to length 1."""
    import numpy as np

    counts = Counter(text.split() if text else [])
    both = np.fromiter(map(_KNOWN.__getitem__, counts), np.int64, len(counts))
    times = np.fromiter(counts.values(), np.float64, len(counts))
    places, which = np.unique(np.concatenate([both >> BITS, both & ((1 << BITS) - 1)]), return_inverse=True)
    values = np.bincount(which, np.concatenate([times, times]), len(places))
    return places, values / (math.sqrt(values @ values) or 1.0)


@dataclass
class OrdinalModel:
    """``weights`` of all buckets, ordered ``thresholds``, and the ``grades`` between them."""

    weights: Any
    thresholds: list[float]
    grades: list[int]

    def judge(self, text: str | None, top: int) -> tuple[float, float]:
        """The expected grade and the probability of at least grade ``top``."""
        places, values = features_of(text)
        value = float(self.weights[places] @ values)
        above = [1 / (1 + math.exp(max(-60.0, min(60.0, t - value)))) for t in self.thresholds]
        expected = self.grades[0] + sum((b - a) * p for a, b, p in zip(self.grades, self.grades[1:], above))
        reach = next((i for i, g in enumerate(self.grades) if g >= top), None)
        tail = 0.0 if reach is None else 1.0 if reach == 0 else above[reach - 1]
        return expected, tail


def _featured(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [features_of(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))],
            names=["grade", "at", "value"],
        )


def cumulative_link(rows, columns, values, level, levels: int, width: int, ridge: float, steps: int):
    """Weights and ordered thresholds of least ridge loss, by adaptive-moment gradient steps.

    Level k lies between thresholds k-1 and k; the gaps between thresholds are exponentials, so
    that their order holds throughout.
    """
    import numpy as np

    size = len(level)
    share = np.cumsum(np.bincount(level, minlength=levels))[:-1] / size
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1))
    params = np.concatenate([np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for step in range(1, steps + 1):
        weights, gaps = params[:width], np.exp(params[width + 1 :])
        cuts = params[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        value = np.bincount(rows, weights[columns] * values, size)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = sigmoid(edges[level + 1] - value), sigmoid(edges[level] - value)
        upper, lower = np.where(level == levels - 1, 1.0, upper), np.where(level == 0, 0.0, lower)
        chance = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / chance / size, lower * (1 - lower) / chance / size
        by_cut = np.array([d_lower[level == k + 1].sum() - d_upper[level == k].sum() for k in range(levels - 1)])
        gradient = np.concatenate([
            np.bincount(columns, (d_upper - d_lower)[rows] * values, width) + ridge * weights,
            [by_cut.sum()],
            [gaps[k] * by_cut[k + 1 :].sum() for k in range(len(gaps))],
        ])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        params = params - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    cuts = params[width] + np.concatenate([[0.0], np.cumsum(np.exp(params[width + 1 :]))])
    return params[:width], cuts.tolist()


def fit(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
    sample_rows: int = 8_000, ridge: float = 1e-5, steps: int = 120,
) -> OrdinalModel:
    import numpy as np

    known = ratings.filter(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(grade_col).cast("int")).alias("grade"))
    sample = bounded_sample(known, ["_id"], sample_rows)
    # Of about sample_rows short rows: broadcast, so that texts are not shuffled to find them.
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(sample), "_id")
    rows = rows.groupBy("_id").agg(F.min("text").alias("text"), F.max("grade").alias("grade")).select("text", "grade")
    found = stored(rows.mapInArrow(_featured, "grade int, at array<int>, value array<float>"), "quality-features").toPandas()
    grades = sorted({int(g) for g in found["grade"]})
    if len(grades) < 2:
        return OrdinalModel(np.zeros(1 << BITS), [], grades or [0])
    row = np.repeat(np.arange(len(found)), [len(a) for a in found["at"]])
    column = np.concatenate([np.asarray(a, dtype=np.int64) for a in found["at"]])
    value = np.concatenate([np.asarray(v, dtype=np.float64) for v in found["value"]])
    level = np.searchsorted(grades, found["grade"].to_numpy())
    weights, cuts = cumulative_link(row, column, value, level, len(grades), 1 << BITS, ridge, steps)
    return OrdinalModel(weights, cuts, grades)


def judge(docs: DataFrame, model: OrdinalModel, top: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``expected_grade`` and ``tail_probability`` (of at least grade ``top``) of every document."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.judge(t.as_py(), top) for t in batch.column(1)]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, "expected_grade", "tail_probability"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(rate, f"`{id_col}` {kind}, expected_grade double, tail_probability double")


def graded(labels: DataFrame) -> DataFrame:
    """Grades from two marks: 0 poor, 1 good but toxic, 2 good; null if a mark is null."""
    grade: Column = F.col("quality") * (2 - F.col("toxic"))
    return labels.select("doc_id", grade.cast("int").alias("grade"))

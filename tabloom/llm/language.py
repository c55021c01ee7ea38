"""Language ID by words first: known words by their frequency in each language, others by character n-grams.

Training counts words and, from the words' beginnings, ends and insides, character n-grams per
language. A word of a text that training knows is scored by its log frequency in each language; an
unseen word falls back to its n-grams of the longest length of which any is known, then to shorter
ones. The mean log score over all words of the whole text decides.

The model is fitted on a bounded sample of labelled rows (``sample_rows``) and holds at most
``max_words`` words and ``max_grams`` n-grams, the most frequent ones; what it leaves out is scored
by the next shorter n-grams. Every text is scored as a whole.

Cases: null, empty or letterless texts get ``und`` and score 0, as does everything when there is
nothing to learn from; rows with a null language or id are not learned from; repeated rows each
count and each give a row; ties go to the language first in order; only the columns named by the
arguments are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import bounded_sample, stored
from tabloom.llm.token_ids import forget_encoders

_WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
KNOWN_WORDS = 100_000
ROWS_AT_ONCE = 512  # rows that a task hands back at once: they hold whole texts


def words_in(text: str | None) -> list[str]:
    """The runs of letters; numerals that are no digits, as fractions and ordinals, part words like other signs."""
    found = _WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def grams_in(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class WordModel:
    """Log frequencies per language of words (length 0) and of n-grams (lengths 1 to ``LONGEST``)."""

    languages: list[str]
    known: dict[int, dict[str, tuple[float, ...]]]
    default: tuple[float, ...] = ()
    cache: dict = field(default_factory=dict)

    def word_score(self, word: str) -> tuple[float, ...]:
        found = self.known[0].get(word)
        if found is not None:
            return found
        for n in range(LONGEST, 0, -1):
            table = self.known[n]
            hits = [table[g] for g in grams_in(word, n) if g in table]
            if hits:
                return tuple(sum(column) / len(hits) for column in zip(*hits))
        return self.default

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_in(text)
        if not words or not self.languages:
            return "und", 0.0
        sums, known, cache = [0.0] * len(self.languages), self.known[0], self.cache
        for word, times in Counter(words).items():
            score = known.get(word) or cache.get(word)  # the cache holds unseen words alone
            if score is None:
                score = self.word_score(word)
                if len(cache) >= KNOWN_WORDS:
                    cache.clear()
                if len(word) <= 64:
                    cache[word] = score
            for i, value in enumerate(score):
                sums[i] += times * value
        # The posterior if about eight words were seen: long texts would otherwise always give 0 or 1.
        weight = min(len(words), 8) / len(words)
        top = max(sums)
        parts = [math.exp((s - top) * weight) for s in sums]
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        return self.languages[best], parts[best] / sum(parts)


def _words(batches: Iterator) -> Iterator:
    """(lang, word, times) of each batch of (text, lang)."""
    forget_encoders()
    for batch in batches:
        seen: dict[str, Counter] = {}
        for text, lang in zip(batch.column(0), batch.column(1)):
            seen.setdefault(lang.as_py(), Counter()).update(words_in(text.as_py()))
        rows = [(lang, word, times) for lang, words in seen.items() for word, times in words.items()]
        yield _table(rows, ("lang", "word", "times"))


def _grams(batches: Iterator) -> Iterator:
    """(lang, n, gram, times) of each batch of (lang, word, times)."""
    for batch in batches:
        rows: Counter = Counter()
        for lang, word, times in zip(*(c.to_pylist() for c in batch.columns)):
            for n in range(1, LONGEST + 1):
                for gram in grams_in(word, n):
                    rows[lang, n, gram] += times
        yield _table([(*key, times) for key, times in rows.items()], ("lang", "n", "gram", "times"))


def _table(rows: list[tuple], names: tuple[str, ...]):
    import pyarrow as pa

    kinds = {"n": pa.int32(), "times": pa.int64()}
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns)], names=list(names)
    )


def fit(
    rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample_rows: int = 5_000,
    max_words: int = 100_000, max_grams: int = 100_000,
) -> WordModel:
    """A model from labelled rows; at most the bounds' numbers of counts reach the driver."""
    labelled = rows.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sample = bounded_sample(labelled.select(id_col, text_col, lang_col), [id_col], sample_rows)
    words = sample.select(text_col, F.col(lang_col).cast("string")).mapInArrow(_words, "lang string, word string, times long")
    words = stored(words.groupBy("lang", "word").agg(F.sum("times").alias("times")), "language-words")
    grams = words.mapInArrow(_grams, "lang string, n int, gram string, times long")
    grams = grams.groupBy("n", "gram", "lang").agg(F.sum("times").alias("times"))
    whole = words.select(F.lit(0).alias("n"), F.col("word").alias("gram"), "lang", "times")
    counts = stored(grams.unionByName(whole), "language-counts")
    totals = {(r["n"], r["lang"]): r["times"] for r in counts.groupBy("n", "lang").agg(F.sum("times").alias("times")).collect()}
    languages = sorted({lang for _, lang in totals})
    size = {n: max(1, sum(t for (m, _), t in totals.items() if m == n)) for n in range(LONGEST + 1)}
    grouped = counts.groupBy("n", "gram").agg(
        F.sum("times").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "times"))).alias("by")
    )
    known: dict[int, dict] = {n: {} for n in range(LONGEST + 1)}
    same: dict[tuple, tuple] = {}  # many words have equal counts: they share one tuple, in each worker's copy too
    for top in (
        grouped.filter("n = 0").orderBy(F.desc("all"), "gram").limit(max_words),
        grouped.filter("n > 0").orderBy(F.desc("all"), "gram").limit(max_grams),
    ):
        for r in top.collect():
            n, by = r["n"], r["by"]
            # A share of all counts of this length is added to each, so that an absence is not a zero.
            scores = tuple(
                math.log((by.get(lang, 0) + 0.5) / (totals.get((n, lang), 0) + 0.005 * size[n])) for lang in languages
            )
            known[n][r["gram"]] = same.setdefault(scores, scores)
    return WordModel(languages, known, tuple(0.0 for _ in languages))


def predict(docs: DataFrame, model: WordModel, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of the documents with ``lang_pred`` and ``score``; a text that is kept goes to the workers once."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        predict_one = shared.value.predict
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found = [predict_one(t.as_py()) for t in batch.column(place)]
                added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(len(keep))] + added, names=[*names, "lang_pred", "score"]
                )

    names = [f"k{i}" for i in range(len(keep))]
    place = keep.index(text_col) if text_col in keep else len(keep)
    text = [F.col(text_col).alias("_text")] if text_col not in keep else []
    kinds = [docs.schema[c].dataType.simpleString() for c in keep]
    schema = ", ".join([f"{n} {k}" for n, k in zip(names, kinds)] + ["lang_pred string", "score double"])
    out = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], *text).mapInArrow(judge, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "lang_pred", "score")


def learned_rows(docs: DataFrame, id_col: str, held_out: Column) -> DataFrame:
    return docs.filter(F.col(id_col).isNotNull() & ~held_out)


def keep_identified(
    docs: DataFrame, model: WordModel, languages: list[str] | None = None, min_score: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The documents, with their own columns, whose language is known, wanted and sure enough."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    flat = docs.toDF(*names)
    judged = predict(flat, model, names[docs.columns.index(text_col)], tuple(names))
    kept = judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    if languages is not None:
        kept = kept.filter(F.col("lang_pred").isin(languages))
    return kept.select(*names).toDF(*docs.columns)

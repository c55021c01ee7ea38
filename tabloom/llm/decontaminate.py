"""Benchmark decontamination with a generalised suffix automaton.

The test items' words go into one automaton that knows every run of words of every item. The words
of a document stream through it; the state tells the longest run of item words that ends at each
word, and from its length follow the windows that end there. Hit words form spans; documents lose
spans beyond a length, or go whole beyond a share of hit words.

The automaton is built from blocks of items of a bounded number of words and sent to the executors;
a larger benchmark takes several blocks, each a pass over the documents, whose spans are merged.
Documents are never shuffled for a single block and no document is compared with another.

Cases: a null or empty text has no words and is clean; an item without words, or null, has no
window; items with equal words all count; the windows of items with a null id mark hits, but add no name;
repeated documents each give a row; an empty benchmark leaves all clean; columns of the documents
named like the added ones are replaced. A document of any length is read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import stored

# Words are runs of ASCII letters, ASCII digits and any character beyond ASCII.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
MAX_WORDS = 2_000_000

ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans")
HITS = (
    "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "items array<string>, spans array<struct<start: long, end: long>>"
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class Automaton:
    """Generalised suffix automaton over word sequences, with the windows known at each state.

    ``step[s]`` maps a word to the next state, ``link[s]`` is the longest shorter suffix in another
    state, ``length[s]`` the longest run of state ``s``. ``whole[s]`` are the items, shorter than a
    window, that equal a run of ``s``; ``within[s]`` all items with a run of ``s``, kept for states
    that hold runs of window length.
    """

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.within: dict[int, tuple[str | None, ...]] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            q = step[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p != -1:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: bytes, q: int) -> int:
        """Part the shorter runs of ``q`` off into a state of their own."""
        clone = len(self.step)
        self.step.append(dict(self.step[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p != -1 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _mark(self, items) -> None:
        within: dict[int, set[str | None]] = {}
        for name, words in items:
            state, matched = 0, 0
            size = min(self.window, len(words))
            for word in words:
                state, matched = self.advance(state, matched, word)
                if matched >= size:
                    top = self._holding(state, size)
                    if len(words) < self.window:
                        self.short.setdefault(top, []).append((size, name))
                    else:
                        within.setdefault(top, set()).add(name)
        self.within = {s: tuple(names) for s, names in within.items()}
        # Short items at a state or at any shorter suffix of it, longest first.
        by_state: dict[int, tuple[tuple[int, str | None], ...]] = {}
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            own = sorted(self.short.get(s, ()), key=lambda own: own[0], reverse=True)
            up = by_state.get(self.link[s], ()) if s else ()
            if own or up:
                by_state[s] = tuple(own) + up
        self.whole = by_state

    def _holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a run in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def advance(self, state: int, matched: int, word: bytes) -> tuple[int, int]:
        step = self.step
        while True:
            to = step[state].get(word)
            if to is not None:
                return to, matched + 1
            if state == 0:
                return 0, 0
            state = self.link[state]
            matched = self.length[state]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (end exclusive, in order, disjoint) and the names of the items whose windows occur."""
        step, link, length, window = self.step, self.link, self.length, self.window
        whole, within = self.whole, self.within
        spans: list[list[int]] = []
        found: set[str | None] = set()
        state = matched = 0
        for at, word in enumerate(words):
            to = step[state].get(word)
            if to is None:
                if state:
                    state, matched = self.advance(state, matched, word)
                    if not matched:
                        continue
                else:
                    continue
            else:
                state, matched = to, matched + 1
            size = 0
            if matched >= window:
                top = state
                while length[link[top]] >= window:
                    top = link[top]
                if top in within:
                    found.update(within[top])
                    size = window
            if whole and state in whole:
                for k, name in whole[state]:
                    if k <= matched:
                        found.add(name)
                        size = max(size, k)
            if size:
                start = at + 1 - size
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return [(a, b) for a, b in spans], found - {None}


def _block_count(named: DataFrame, max_words: int) -> int:
    # A word has at least one byte and one separator.
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // (2 * max_words)))


def _automata(named: DataFrame, count: int, window: int) -> Iterator[Automaton]:
    """One automaton for each block of items; blocks follow a hash of the item, so their size is bounded."""
    named = named.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(count)))
    for block in range(count):
        rows = named.filter(F.col("block") == block).select("name", "text").toLocalIterator()
        yield Automaton([(r["name"], words_of(r["text"])) for r in rows], window)


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _digest(n_words: int, spans: list[tuple[int, int]], names: Iterable[str]) -> dict:
    names = sorted(names)
    n_hit = sum(b - a for a, b in spans)
    return {
        "n_words": n_words, "n_hit": n_hit, "n_items": len(names), "contaminated": n_hit > 0, "items": names,
        "items_sha256": hashlib.sha256(",".join(names).encode()).hexdigest(),
        "spans": [{"start": a, "end": b} for a, b in spans],
    }


def _scanner(shared: Broadcast, text_col: str, kept: list[str]):
    import pyarrow as pa

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(span))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            found = []
            for text in batch.column(text_col):
                words = words_of(text.as_py())
                found.append(_digest(len(words), *automaton.scan(words)))
            arrays = [pa.array([f[name] for f in found], kind) for name, kind in zip(ADDED, types)]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + arrays, names=[*kept, *ADDED])

    return scan


def _merge_blocks(batches):
    """Digests of rows whose spans and items were found in several blocks."""
    import pandas as pd

    for frame in batches:
        if len(frame):
            found = [
                _digest(n, _merged((s["start"], s["end"]) for s in spans), set(items))
                for n, items, spans in zip(frame["n_words"], frame["items"], frame["spans"])
            ]
            yield pd.DataFrame(found).assign(_row=frame["_row"].to_numpy())


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, max_words: int = MAX_WORDS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: ``id_col``, the columns of ``keep``, counts, item names and hit spans (in words).

    ``keep`` may hold the text column. With several blocks of items the rows of a document meet by
    a number given to each row of a written copy of the documents.
    """
    rows = docs.select(*dict.fromkeys([id_col, text_col, *keep]))
    named = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text"))
    named = named.filter(F.col("text").isNotNull())
    count = _block_count(named, max_words)
    if count > 1:
        rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "decontaminate-rows")

    def scanned(automaton: Automaton, kept: list[str]) -> DataFrame:
        scan = _scanner(docs.sparkSession.sparkContext.broadcast(automaton), text_col, kept)
        schema = ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept] + [HITS])
        return rows.mapInArrow(scan, schema)

    automata = _automata(named, count, window)
    if count == 1:
        return scanned(next(automata), [c for c in rows.columns if c != text_col or c in keep])
    parts = [stored(scanned(a, ["_row"]), "decontaminate-block") for a in automata]
    together = reduce(DataFrame.unionByName, parts).groupBy("_row").agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("items")).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    merged = together.mapInPandas(_merge_blocks, "_row long, " + HITS)
    out = rows if text_col in keep else rows.drop(text_col)
    return out.join(merged, "_row").drop("_row")


def _without(text: str, spans) -> str:
    """The text without the characters from the first to the last word of each span."""
    starts = [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at : starts[s["start"]][0]])
        at = starts[s["end"] - 1][1]
    return "".join([*out, text[at:]])


def clean(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, min_span: int = 10, max_share: float = 0.0,
) -> DataFrame:
    """The documents, with their own columns, after removal.

    A document whose share of hit words is over ``max_share`` goes whole (0: any hit). From the
    others, spans of at least ``min_span`` hit words are cut out.
    """
    others = tuple(c for c in docs.columns if c != id_col)
    taken = [c for c in docs.columns if c in ADDED]
    renamed = docs.withColumnsRenamed({c: f"_own_{c}" for c in taken})
    keep = tuple(f"_own_{c}" if c in taken else c for c in others)
    found = contamination(renamed, items, id_col, text_col, item_id, item_text, window, keep=keep)
    found = found.filter(F.col("n_hit") <= F.lit(max_share) * F.col("n_words"))
    if max_share > 0:

        @F.pandas_udf("string")
        def cut(texts, spans):
            import pandas as pd

            return pd.Series([
                _without(t, long) if (long := [s for s in p if s["end"] - s["start"] >= min_span]) else t
                for t, p in zip(texts, spans)
            ], dtype=object)

        found = found.withColumn(text_col, cut(text_col, "spans"))
    return found.select(*[F.col(f"_own_{c}" if c in taken else c).alias(c) for c in docs.columns])

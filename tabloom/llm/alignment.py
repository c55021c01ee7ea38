"""Alignment of two tokenizers' ids over the same texts by the bytes that both cut at.

A is a byte-level BPE of the ``tokenizers`` library over a space and the text, B a ``sentencepiece``
model over the text (it adds the space). Character offsets of A and the spans of B's protocol message
are the coarse cuts; where a character of several bytes is cut, or a byte falls back to a token of
its own, the decoded bytes of the tokens refine them. Offsets where tokens of both end cut the ids
into groups, and each two tokens that end together are a link.

Both tokenizers cut a text at a blank or a line feed between two characters that are no white space
(B: where none of its pieces could reach across; otherwise texts stay whole). The chunks between
these cuts repeat, so each worker aligns a chunk once, in a memory that is
emptied when it is full.

Each text leaves one row with its distinct links, coded as numbers. Counts of id pairs are summed
per task and then over all; B's best pairs follow from them. Rows get their sums from a broadcast of
the pair counts where these are few (``max_pairs``), and from a shuffled join beyond.

Cases: null and empty texts, and texts whose joined bytes of A or B differ from a space and the text
(such as those with U+2581) have no tokens; strings of special tokens are plain text; repeated rows
and null ids keep a row each; an empty table gives no rows; very long texts and texts without blanks
are aligned whole; columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import stored
from tabloom.llm.token_ids import byte_letters

# Before a blank or a line feed that stands between two characters that are no white space.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
KEPT_CHUNKS = 500_000
PART_CHARACTERS = 1 << 20  # texts that are aligned together, besides the last one of them
HELD_PAIRS = 1 << 22
MAX_PAIRS = 4_000_000
SPACE = "▁"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Aligner:
    """Aligns texts; each distinct chunk is aligned once while it is remembered."""

    def __init__(self, path_a: str, path_b: str, kept: int = KEPT_CHUNKS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = {letter: byte for byte, letter in byte_letters().items()}
        self.size_a, self.size_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for entry, number in self.a.get_vocab(with_added_tokens=True).items():
            plain = all(letter in shown for letter in entry)
            self.bytes_a[number] = bytes(shown[letter] for letter in entry) if plain else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.is_byte = [self.b.is_byte(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if f else p.replace(SPACE, " ").encode() for f, p in zip(self.is_byte, pieces)]
        self.apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)
        self.small = self.size_a * self.size_b <= 1 << 32
        self.names = [str(i) for i in range(max(self.size_a, self.size_b))]
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        """Per remembered chunk: its number, tokens of A and B, groups, whether bytes agree, groups as text; all link codes."""
        self.number: dict[str, int] = {}
        self.n_a, self.n_b, self.n_groups, self.same = (array("q") for _ in range(4))
        self.groups: list[str] = []
        self.codes = array("I" if self.small else "Q")

    def chunks(self, text: str) -> list[str]:
        whole = " " + text
        return CUT.split(whole) if self.apart else [whole]

    def ends_a(self, chunk: str, ids: list[int], offsets: list[tuple[int, int]]) -> list[int]:
        """The byte offsets at which A's tokens end."""
        if chunk.isascii():
            return [stop for _, stop in offsets]
        byte_at = list(accumulate((len(c.encode()) for c in chunk), initial=0))
        ends, at, final = [], 0, len(ids) - 1
        for i, (number, (_, stop)) in enumerate(zip(ids, offsets)):
            # Inside a character the next token holds a part of it too: its place follows from the bytes.
            at = at + len(self.bytes_a[number]) if i < final and offsets[i + 1][0] < stop else byte_at[stop]
            ends.append(at)
        return ends

    def ends_b(self, pieces, own: bool) -> tuple[list[int], list[int]]:
        """B's ids and the byte offsets at which they end; the model's own leading space is the chunk's."""
        ids, ends, at = [], [], 0
        for p in pieces if own else pieces[1:]:
            number = p.id
            # A byte of a character that fell back has no span of its own until the last one.
            at = at + 1 if self.is_byte[number] else p.end + own
            ids.append(number)
            ends.append(at)
        return ids, ends

    def learn(self, chunks: list[str]) -> None:
        """Align chunks that are not remembered; a token has a byte at least, so each group ends in one link."""
        names, own = self.names, [c[0] == " " for c in chunks]
        all_a = self.a.encode_batch(chunks, add_special_tokens=False)
        all_b = self.b.encode([c[1:] if o else c for c, o in zip(chunks, own)], return_type="proto", num_threads=1)
        for chunk, leads, found, proto in zip(chunks, own, all_a, all_b):
            a = found.ids
            ends_a = self.ends_a(chunk, a, found.offsets)
            b, ends_b = self.ends_b(proto.pieces, leads)
            raw = chunk.encode()
            self.same.append(b"".join([self.bytes_a[k] for k in a]) == raw == b"".join([self.bytes_b[k] for k in b]))
            names_a, names_b, groups = [names[k] for k in a], [names[k] for k in b], []
            i = j = first_a = first_b = 0
            while i < len(a) and j < len(b):
                if ends_a[i] < ends_b[j]:
                    i += 1
                elif ends_a[i] > ends_b[j]:
                    j += 1
                else:
                    self.codes.append(a[i] * self.size_b + b[j])
                    i, j = i + 1, j + 1
                    groups.append(",".join(names_a[first_a:i]) + "|" + ",".join(names_b[first_b:j]))
                    first_a, first_b = i, j
            self.number[chunk] = len(self.groups)
            self.groups.append(";".join(groups))
            self.n_a.append(len(a))
            self.n_b.append(len(b))
            self.n_groups.append(len(groups))

    def texts(self, texts: list[str | None]) -> list[tuple[int, int, int, str, Any]]:
        """(tokens of A, of B, groups, groups as text, link codes) of each text; zeros where it has no tokens."""
        import numpy as np

        if len(self.number) > self.kept:
            self.forget()
        cut = [self.chunks(t) if t else [] for t in texts]
        fresh = {c for chunks in cut for c in chunks if c not in self.number}
        if fresh:
            self.learn(list(fresh))
        numbers = [[self.number[c] for c in chunks] for chunks in cut]
        flat = np.fromiter(chain.from_iterable(numbers), np.int64)
        bounds = np.cumsum([0, *map(len, numbers)])

        def summed(column) -> list[int]:
            sums = np.concatenate([[0], np.cumsum(np.array(column, np.int64)[flat])]) if len(flat) else np.zeros(1, np.int64)
            return sums[bounds]

        links = np.array(self.n_groups, np.int64)
        starts, lengths = (np.cumsum(links) - links)[flat], links[flat]
        ends = np.cumsum(lengths)
        codes = np.array(self.codes, np.uint32 if self.small else np.uint64)
        codes = codes[np.repeat(starts - ends + lengths, lengths) + np.arange(int(lengths.sum()))]
        sums = [summed(c) for c in (self.n_a, self.n_b, self.n_groups, self.same)]
        link_at, counts = sums[2], np.diff(np.stack(sums), axis=1).T.tolist()
        out = []
        for i, (n_a, n_b, n_groups, same) in enumerate(counts):
            if same < len(numbers[i]) or not numbers[i]:
                out.append((0, 0, 0, "", codes[:0]))
            else:
                groups = ";".join([self.groups[k] for k in numbers[i]])
                out.append((n_a, n_b, n_groups, groups, codes[link_at[i] : link_at[i + 1]]))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _kinds(path_a: str, path_b: str) -> tuple[int, Any]:
    import numpy as np

    both = Aligner(path_a, path_b)
    return both.size_b, np.dtype(np.uint32 if both.small else np.uint64)


def aligned_rows(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``row`` (a number of its own), its id, counts, ``groups_sha256``, its distinct link codes and how often each comes."""
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, codes binary, times binary"

    def parts(column) -> Iterator[tuple[int, list[str | None]]]:
        held: list[str | None] = []
        size = 0
        for i in range(len(column)):
            held.append(column[i].as_py())
            size += len(held[-1] or "")
            if size >= PART_CHARACTERS:
                yield i + 1 - len(held), held
                held, size = [], 0
        yield len(column) - len(held), held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        both = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, texts in parts(batch.column(1)):
                out: list[tuple] = []
                for n_a, n_b, n_groups, groups, links in both.texts(texts):
                    codes, times = np.unique(links, return_counts=True)
                    digest = hashlib.sha256(groups.encode()).hexdigest() if n_a or n_b else ""
                    out.append((row, n_a, n_b, n_groups, digest, codes.tobytes(), times.astype(np.uint32).tobytes()))
                    row += 1
                cells = list(zip(*out)) if out else [[]] * 7
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(cells, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [arrays[0], batch.column(0).slice(start, len(texts)), *arrays[1:]],
                    names=["row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def pair_counts(rows: DataFrame, size_b: int, width: Any) -> DataFrame:
    """(code, n, best): links of each id pair in all documents, and whether no pair of its B id has more."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        codes, counts, held = [], [], 0

        def combined():
            keys, place = np.unique(np.concatenate(codes), return_inverse=True)
            return keys, np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)

        def out(keys, sums):
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(sums)], names=["code", "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                codes.append(np.frombuffer(batch.column(0)[i].as_py(), width))
                counts.append(np.frombuffer(batch.column(1)[i].as_py(), np.uint32))
                held += len(codes[-1])
                if held >= HELD_PAIRS:
                    keys, sums = combined()
                    codes, counts, held = [keys], [sums], len(keys)
                    if held >= HELD_PAIRS // 2:
                        yield out(keys, sums)
                        codes, counts, held = [], [], 0
        if held:
            yield out(*combined())

    partial = rows.select("codes", "times").mapInArrow(run, "code long, n long")
    pairs = stored(partial.groupBy("code").agg(F.sum("n").alias("n")), "align-pairs")
    b = (F.col("code") % size_b).alias("b")
    most = pairs.groupBy(b).agg(F.max("n").alias("most"))
    return pairs.select("code", "n", b).join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums_by_broadcast(rows: DataFrame, pairs: DataFrame, width: Any) -> DataFrame:
    import pyarrow as pa

    table = pairs.toArrow()
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        code, n, best = shared.value
        order = np.argsort(code)
        code, n, best = code[order], n[order], best[order]
        for batch in batches:
            sums = []
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(6)[i].as_py(), width)
                times = np.frombuffer(batch.column(7)[i].as_py(), np.uint32).astype(np.int64)
                place = np.searchsorted(code, codes)
                sums.append((int(times.sum()), int(times[best[place]].sum()), int((times * n[place]).sum())))
            cells = list(zip(*sums)) if sums else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(1, 6)], *[pa.array(c, pa.int64()) for c in cells]],
                names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    return rows.mapInArrow(run, schema)


def _sums_by_join(rows: DataFrame, pairs: DataFrame, width: Any) -> DataFrame:
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(1)[i].as_py(), width).astype(np.int64)
                times = np.frombuffer(batch.column(2)[i].as_py(), np.uint32).astype(np.int64)
                row = np.full(len(codes), batch.column(0)[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (row, codes, times)], names=["row", "code", "m"])

    links = rows.select("row", "codes", "times").mapInArrow(run, "row long, code long, m long")
    sums = links.join(pairs.hint("merge"), "code").groupBy("row").agg(
        F.sum("m").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"),
        F.sum(F.col("m") * F.col("n")).alias("count_sum"),
    )
    return rows.drop("codes", "times").join(sums, "row", "left").na.fill(0, ["n_links", "n_best", "count_sum"]).drop("row")


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS
) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    size_b, width = _kinds(path_a, path_b)
    rows = stored(aligned_rows(docs, path_a, path_b, id_col, text_col), "align-rows")
    pairs = stored(pair_counts(rows, size_b, width), "align-counts")
    summed = _sums_by_broadcast if pairs.count() <= max_pairs else _sums_by_join
    out = summed(rows, pairs, width).withColumnRenamed("id", id_col)
    return out.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

"""Token-id shards compressed by Re-Pair grammars, with random access.

Documents are encoded in ascending id order and cut into shards of a bounded number of ids. Within
a shard, frequent pairs of neighbouring symbols are replaced by new symbols, round after round,
until a round would shorten them by less than a hundredth; a pair never spans two documents. A shard file holds the rules, the number
of ids each rule stands for, and the symbols of its documents with their places, so that any range
of any document is read without expanding the rest.

A shard file is one byte string. Files are rows of a Parquet table (``part``, ``shard``,
``part_start``, ``n_tokens``, ``doc_ids``, ``file``): Spark's own writer commits whole files to any
store it can reach, and a lost executor leaves nothing half written. ``part`` is the place of the
range partition in the order of ids, ``part_start`` the ids before the shard in its part.

File layout, little-endian: the magic ``RPG1``; unsigned 32-bit numbers of documents, rules, rounds,
symbols, and the first rule's symbol; an unsigned 64-bit number of ids; then rules per round, left
and right symbols and expansion lengths of the rules (32 bits each), first symbol and first id of
each document and the end (64 bits each), the symbols' lower 16 bits, the symbols' upper 8 bits.

Cases: a null or empty text is a document that holds only the end id; null document ids come first
and, like repeated ids, keep a row each, ordered by text; a document longer than a shard is a shard
of its own; an empty table gives no file; columns other than the id and the text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.token_ids import encoder

SHARD_TOKENS = 1 << 19
KEPT_CHUNKS = 500_000  # chunks a worker remembers in each of two generations: merging new ones is most of the work
MAGIC, HEAD = b"RPG1", "<5IQ"
LEAST_COUNT, LEAST_GAIN, TABLE_BITS = 6, 0.01, 18


def repair(symbols, last, first_rule: int, least: int = LEAST_COUNT, least_gain: float = LEAST_GAIN):
    """(symbols, last of each document, rules by round as (left, right) arrays).

    ``last`` marks the last symbol of each document. Each round counts all pairs exactly, by sorting
    them, and replaces the frequent ones, the more frequent where two overlap, if they are replaced
    ``least`` times. Rounds go on until one would shorten the symbols by less than ``least_gain``;
    with 0 no pair is left that could be replaced ``least`` times. Frequent pairs are found again through a table of hashes;
    of two that share a place the more frequent goes first and the other waits for the next round,
    with another hash.
    """
    import numpy as np

    symbols, last, rounds = symbols.astype(np.uint64), last.copy(), []
    shift = np.uint64(64 - TABLE_BITS)
    while len(symbols) > 1:
        odd = np.uint64((0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * len(rounds)) % (1 << 64))
        pair = (symbols[:-1] << np.uint64(32)) | symbols[1:]
        inside = ~last[:-1]
        ordered = np.sort(pair[inside])
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
        counts = np.diff(heads, append=len(ordered))
        often = counts >= least
        if not often.any():
            break
        keys, counts = ordered[heads[often]], counts[often]
        by_count = np.argsort(counts, kind="stable").astype(np.int32)
        held = np.zeros(1 << TABLE_BITS, dtype=np.int32)
        held[(keys[by_count] * odd) >> shift] = by_count  # the last one written stays
        key = held[(pair * odd) >> shift]
        found = np.flatnonzero((keys[key] == pair) & inside)
        key = key[found]
        rank, beside = counts[key], np.diff(found) == 1
        taken = np.ones(len(found), dtype=bool)
        taken[1:] &= ~beside | (rank[1:] > rank[:-1])
        taken[:-1] &= ~beside | (rank[:-1] >= rank[1:])
        used = np.bincount(key[taken], minlength=len(keys)) >= least
        taken &= used[key]
        if not taken.any() or taken.sum() < least_gain * len(symbols):
            break
        number = np.cumsum(used) + (first_rule - 1)
        at = found[taken]
        symbols[at] = number[key[taken]]
        last[at] |= last[at + 1]
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        symbols, last = symbols[stays], last[stays]
        keys = keys[used]
        rounds.append(((keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32)))
        first_rule += len(keys)
    return symbols.astype(np.uint32), last, rounds


def shard_file(documents: list[bytes], first_rule: int) -> bytes:
    """The file of documents given by their ids as little-endian 32-bit bytes; none may be empty."""
    import numpy as np

    ends = np.cumsum([len(d) // 4 for d in documents])
    ids = np.frombuffer(b"".join(documents), dtype="<u4")
    first_rule = max(first_rule, int(ids.max(initial=0)) + 1)
    last = np.zeros(len(ids), dtype=bool)
    last[ends - 1] = True
    symbols, last, rounds = repair(ids, last, first_rule)
    left = np.concatenate([r[0] for r in rounds]) if rounds else np.zeros(0, np.uint32)
    right = np.concatenate([r[1] for r in rounds]) if rounds else np.zeros(0, np.uint32)
    length, at = np.ones(first_rule + len(left), dtype=np.uint32), first_rule
    for a, b in rounds:
        length[at : at + len(a)] = length[a] + length[b]
        at += len(a)
    places = np.concatenate([[0], np.flatnonzero(last) + 1])
    head = struct.pack(HEAD, len(documents), len(left), len(rounds), len(symbols), first_rule, len(ids))
    parts = [
        np.array([len(a) for a, _ in rounds], "<u4"), left.astype("<u4"), right.astype("<u4"), length[first_rule:].astype("<u4"),
        places.astype("<u8"), np.concatenate([[0], ends]).astype("<u8"),
        symbols.astype("<u2"), (symbols >> 16).astype("u1"),
    ]
    if int(symbols.max(initial=0)) >> 24:
        raise ValueError("symbols of more than 24 bits")
    return b"".join([MAGIC, head, *[p.tobytes() for p in parts]])


@dataclass
class ShardReader:
    """Reads a shard file; ``document(i)`` gives all ids of a document or those of a range."""

    file: bytes

    def __post_init__(self):
        import numpy as np

        if self.file[:4] != MAGIC:
            raise ValueError("not a shard file")
        self.n_docs, n_rules, n_rounds, n_symbols, self.first_rule, self.n_tokens = struct.unpack_from(HEAD, self.file, 4)
        at = 4 + struct.calcsize(HEAD)

        def take(kind: str, count: int):
            nonlocal at
            out = np.frombuffer(self.file, kind, count, at)
            at += out.nbytes
            return out

        self.per_round = take("<u4", n_rounds)
        self.left, self.right, self.length = take("<u4", n_rules), take("<u4", n_rules), take("<u4", n_rules)
        self.places, self.starts = take("<u8", self.n_docs + 1), take("<u8", self.n_docs + 1)
        self.symbols = take("<u2", n_symbols).astype(np.uint32) | take("u1", n_symbols).astype(np.uint32) << 16
        self._table: Any = None

    def _lengths(self, symbols):
        import numpy as np

        out = np.ones(len(symbols), dtype=np.int64)
        rules = symbols >= self.first_rule
        out[rules] = self.length[symbols[rules] - self.first_rule]
        return out

    def _gather(self, symbols, table, offsets):
        import numpy as np

        lengths = self._lengths(symbols)
        starts = np.cumsum(lengths) - lengths
        rules = symbols >= self.first_rule
        source = symbols.astype(np.int64) + 0
        source[rules] = self.first_rule + offsets[symbols[rules] - self.first_rule]
        return table[np.repeat(source - starts, lengths) + np.arange(int(lengths.sum()))]

    def all_ids(self):
        """All ids of the shard, by a table of all rules' expansions."""
        import numpy as np

        if self._table is None:
            offsets = np.cumsum(self.length, dtype=np.int64) - self.length
            total = int(self.length.sum())
            table = np.concatenate([np.arange(self.first_rule, dtype=np.uint32), np.zeros(total, np.uint32)])
            at = 0
            for n in self.per_round.tolist():
                both = np.column_stack([self.left[at : at + n], self.right[at : at + n]]).ravel()
                grown = self._gather(both, table, offsets)
                begin = self.first_rule + int(offsets[at])
                table[begin : begin + len(grown)] = grown
                at += n
            self._table = table, offsets
        return self._gather(self.symbols, *self._table)

    def document(self, i: int, start: int = 0, stop: int | None = None) -> list[int]:
        """Ids ``start`` to ``stop`` of document ``i``; only rules in that range are expanded."""
        import numpy as np

        symbols = self.symbols[int(self.places[i]) : int(self.places[i + 1])]
        ends = np.cumsum(self._lengths(symbols))
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return []
        first, final = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
        at = int(ends[first - 1]) if first else 0
        out: list[int] = []
        todo = symbols[first : final + 1][::-1].tolist()
        while todo and at < stop:
            symbol = todo.pop()
            size = int(self.length[symbol - self.first_rule]) if symbol >= self.first_rule else 1
            if at + size <= start:
                at += size
            elif symbol >= self.first_rule:
                todo += [int(self.right[symbol - self.first_rule]), int(self.left[symbol - self.first_rule])]
            else:
                out.append(symbol)
                at += 1
        return out


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
    shard_tokens: int = SHARD_TOKENS, vocabulary: int = 50_257,
) -> None:
    """Write the shard files of all documents below ``path``."""
    import pyarrow as pa

    end = end_id.to_bytes(4, "little")
    id_kind = docs.schema[id_col].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(tokenizer, KEPT_CHUNKS).encode_all, TaskContext.get().partitionId()
        shard = before = size = 0
        owners: list[pa.Array] = []
        held: list[bytes] = []

        def closed() -> pa.RecordBatch:
            ids = pa.concat_arrays(owners)
            column = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            numbers = [pa.array([x], pa.int64()) for x in (part, shard, before, size)]
            return pa.RecordBatch.from_arrays(
                [*numbers, column, pa.array([shard_file(held, vocabulary)], pa.binary())],
                names=["part", "shard", "part_start", "n_tokens", "doc_ids", "file"],
            )

        for batch in batches:
            since = 0
            for row, ids in enumerate(encode(t.as_py() for t in batch.column(1))):
                ids += end
                if held and size + len(ids) // 4 > shard_tokens:
                    owners.append(batch.column(0).slice(since, row - since))
                    yield closed()
                    shard, before, size, since = shard + 1, before + size, 0, row
                    owners, held = [], []
                held.append(ids)
                size += len(ids) // 4
            owners.append(batch.column(0).slice(since))
        if held:
            yield closed()

    ordered = docs.select(id_col, text_col).repartitionByRange(F.asc_nulls_first(id_col), F.xxhash64(text_col))
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first(id_col), F.xxhash64(text_col))
    schema = f"part long, shard long, part_start long, n_tokens long, doc_ids array<{id_kind}>, file binary"
    ordered.mapInArrow(build, schema).write.parquet(path)


def read_shards(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, ``start`` (ids before it in all), ``n_tokens``, ``ids_crc32``."""
    import pyarrow as pa

    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                reader = ShardReader(batch.column(3)[i].as_py())
                ids = reader.all_ids().astype("<u4").tobytes()
                starts = reader.starts.tolist()
                before = batch.column(1)[i].as_py()
                ranges = list(zip(starts, starts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[i].as_py()] * len(ranges), pa.int64()), batch.column(2)[i].values,
                        pa.array([before + a for a, _ in ranges], pa.int64()), pa.array([b - a for a, b in ranges], pa.int64()),
                        pa.array([zlib.crc32(ids[4 * a : 4 * b]) for a, b in ranges], pa.int64()),
                    ],
                    names=["part", id_col, "start", "n_tokens", "ids_crc32"],
                )

    rows = files.select("part", "part_start", "doc_ids", "file").mapInArrow(
        read, f"part long, `{id_col}` {kind}, start long, n_tokens long, ids_crc32 long"
    )
    # One row for each range partition of the write, whatever the number of documents.
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    begin, starts = 0, []
    for r in totals:
        starts.append((r["part"], begin))
        begin += r["n"]
    offsets = spark.createDataFrame(starts, "part long, begin long")
    return rows.join(F.broadcast(offsets), "part").select(
        id_col, (F.col("begin") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )

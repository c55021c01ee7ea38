"""Best-fit packing of documents into sequences by swap-based local search.

Texts become token ids once; documents longer than a sequence are cut into pieces, the first of
which may be short. Pieces are dealt to shards of a bounded number of pieces by a hash. Each shard
places its pieces by best fit, longest first, and then improves its underfull bins: a document
moves to a fuller bin, or one or two documents change places with one of another bin, whenever
that raises the sum of squared fills. Such steps drain the emptiest bins until they are empty, or
no step is left. A shard ends within a bin or two of the least number possible, so the loss is a
small share whatever the size of the input.

Cases: a null or empty text is a document that holds only the end id; repeated rows and rows with
null ids are packed like any other; an empty table gives an empty table; extra columns are not
read. A hot document id is dealt by the piece's place as well, so that its rows spread.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import stored
from tabloom.llm.token_ids import encoder

SHARD_PIECES = 2048


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
    end_id: int = 2, with_ids: bool = False,
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``deal`` (its place in its task) and, on demand, ``ids``."""
    import pyarrow as pa

    end = end_id.to_bytes(4, "little")
    names = [id_col, "piece", "start", "length", "ids_crc32", "deal"] + ["ids"] * with_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.uint32())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = encoder(tokenizer).encode_all
        dealt = 0
        for batch in batches:
            owner, out = [], []
            for row, ids in enumerate(encode(t.as_py() for t in batch.column(1))):
                ids += end
                total = len(ids) // 4
                at, size = 0, total % capacity or capacity
                for piece in range(-(-total // capacity)):
                    part = ids[4 * at : 4 * (at + size)]
                    owner.append(row)
                    out.append((piece, at, size, zlib.crc32(part), dealt, part))
                    dealt += 1
                    at, size = at + size, capacity
            columns = [batch.column(0).take(pa.array(owner, pa.int64()))]
            for i in range(5):
                columns.append(pa.array([p[i] for p in out], types[i]))
            if with_ids:
                columns.append(pa.array([np.frombuffer(p[5], "<u4") for p in out], types[5]).cast(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, deal long" + ", ids array<long>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each into the fullest bin that has room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    free = 0  # bit r is set if a bin with free space r exists
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fits = free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = room[space].pop()
            if not room[space]:
                free &= ~(1 << space)
            bins[b].append(i)
        else:
            space, b = capacity, len(bins)
            bins.append([i])
        left = space - size
        if left:
            room[left].append(b)
            free |= 1 << left
    return bins


class LocalSearch:
    """Raises the sum of squared fills of underfull bins by moves and exchanges until bins empty.

    Bins are drained from the emptiest: its documents are offered to the other bins, fullest first.
    Each accepted step makes the fuller of two bins fuller, so the sum rises and the search ends.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
        self.open = [b for b in bins if sum(lengths[i] for i in b) < capacity]
        self.least = -(-sum(lengths) // capacity)

    def run(self) -> list[list[int]]:
        stuck: list[list[int]] = []
        while len(self.full) + len(self.open) + len(stuck) > self.least and len(self.open) > 1:
            self.open.sort(key=self._fill)
            source = self.open.pop(0)
            while source and self._step(source):
                pass
            if source:
                stuck.append(source)
                if len(stuck) > 8:  # nothing is left to gain from the emptiest bins
                    break
            elif stuck:  # a bin has gone: the others have changed
                self.open += stuck
                stuck = []
        return self.full + self.open + stuck

    def _fill(self, b: list[int]) -> int:
        return sum(self.lengths[i] for i in b)

    def _step(self, source: list[int]) -> bool:
        """One step that makes another bin fuller at the cost of ``source``."""
        size, out = self.lengths, sorted(source, key=self.lengths.__getitem__)
        given = [size[i] for i in out]
        pairs = sorted((given[x] + given[y], x, y) for x in range(len(out)) for y in range(x))
        sums = [p[0] for p in pairs]
        own = sum(given)
        for target in sorted(self.open, key=self._fill, reverse=True):
            fill = self._fill(target)
            space = self.capacity - fill
            best: tuple[int, list[int], list[int]] | None = None
            at = bisect_left(given, space + 1) - 1
            if at >= 0 and fill + given[at] > own:
                best = (given[at], [out[at]], [])
            for back in target:
                for values, single in ((given, True), (sums, False)):
                    at = bisect_left(values, space + size[back] + 1) - 1
                    gain = values[at] - size[back] if at >= 0 else 0
                    if gain > 0 and fill + gain > own and (best is None or gain > best[0]):
                        taken = [out[at]] if single else [out[pairs[at][1]], out[pairs[at][2]]]
                        best = (gain, taken, [back])
            if best:
                _, taken, back = best
                for i in taken:
                    source.remove(i)
                for i in back:
                    target.remove(i)
                target += taken
                source += back
                if self._fill(target) == self.capacity:
                    self.open.remove(target)
                    self.full.append(target)
                return True
        return False


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes into ``lengths``, as few as best fit and the local search find."""
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def pack(cut: DataFrame, capacity: int = 1024, shard_pieces: int = SHARD_PIECES, rounds: int = 2) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``cut`` comes from :func:`pieces`.

    In each further round, the pieces of bins with more than 2 % of free space are dealt and packed
    anew, now beside those of other shards.
    """
    rest, done = stored(cut, "packing-pieces"), []
    columns = [c for c in cut.columns if c != "deal"]
    for turn in range(rounds):
        packed = _round(rest, capacity, shard_pieces, turn)
        if turn < rounds - 1:
            packed = stored(packed, "packing-bins")
            tight = F.col("fill") * 50 >= F.lit(capacity * 49)
            rest = packed.filter(~tight).select(*cut.columns)
            packed = packed.filter(tight)
        done.append(packed.select(*columns, "sequence_id", "offset"))
    return reduce(DataFrame.unionByName, done)


def _round(cut: DataFrame, capacity: int, shard_pieces: int, turn: int) -> DataFrame:
    shards = max(1, -(-cut.count() // shard_pieces))
    key = F.xxhash64(F.lit(turn), cut.columns[0], "piece", "ids_crc32", "deal")
    names = cut.columns

    def place(shard, frame):
        frame = frame.sort_values(["length", "ids_crc32", "start", "deal"], ascending=[False, True, True, True], kind="stable")
        lengths = frame["length"].tolist()
        sequence, offset, fill = [0] * len(lengths), [0] * len(lengths), [0] * len(lengths)
        for number, members in enumerate(pack_lengths(lengths, capacity)):
            at, total = 0, sum(lengths[i] for i in members)
            for i in members:
                sequence[i], offset[i], fill[i] = (turn << 56) + (shard[0] << 24) + number, at, total
                at += lengths[i]
        return frame[names].assign(sequence_id=sequence, offset=offset, fill=fill)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    dealt = cut.withColumn("shard", F.pmod(key, F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(place, schema + ", sequence_id long, offset long, fill long")

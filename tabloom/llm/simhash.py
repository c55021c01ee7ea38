"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: 64 bits, each the majority over the XXH64 values of all shingles of words. Documents
with the same fingerprint are one group from the start; everything below works on distinct
fingerprints, so that copies never form pairs.

Links (a Hamming distance of at most ``distance``): the 64 bits are cut into ``distance + 1`` runs;
two linked fingerprints agree on one of them, so rows that agree on a run are a bucket and meet in
one task. The task sorts whole buckets by Gray rank and puts a hierarchical index over them. A node
holds the bits that all of its fingerprints share and its parent's do not; a search adds up the
differences from the top and leaves a node, with the whole group below it, when they exceed
``distance``. Buckets of more than ``max_group`` rows are cut again by runs of their remaining bits
until they are small, so that no task gets an unbounded group; nothing is capped. Each index returns a spanning forest of the links
it found rather than all pairs. Components follow from large-star and small-star steps on written
tables; labels and links stay distributed.

Cases: a text without words, or null, has fingerprint zero and is linked like any other; fewer
words than a shingle give one shingle; repeated rows each give a row; rows with a null id get the
component of their fingerprint (null if no id is in it); an empty table gives an empty table;
only the id and text columns are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import free_name, stored

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
FANOUT = 16
MAX_GROUP = 4_000
INDEXED = 20_000


# --- fingerprints ---


def fingerprint_of(text: str | None, shingle: int, seed: int) -> int:
    import numpy as np
    import xxhash

    # Words end at the blanks of the contract: space and \x09-\x0D, which is what bytes.split() knows.
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(s, seed) for s in shingles), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 65536):
        part = values[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, seed: int = 42
) -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed 64-bit number."""
    import pyarrow as pa

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            found = np.array([fingerprint_of(t.as_py(), shingle, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(fold, f"`{id_col}` {kind}, fp long")


# --- the index ---


def gray_rank(codes):
    """The place of each code in Gray order: each bit is the parity of itself and all higher bits."""
    import numpy as np

    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchy over distinct codes in Gray order; ``near(distance)`` finds all close pairs."""

    def __init__(self, codes, fanout: int = FANOUT):
        import numpy as np

        self.fanout = fanout
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.levels = []  # from the leaves' parents upwards: bits shared by all below, and their mask
        shared_or = shared_and = self.codes
        while len(shared_or) > 1:
            starts = np.arange(0, len(shared_or), fanout)
            shared_or, shared_and = np.bitwise_or.reduceat(shared_or, starts), np.bitwise_and.reduceat(shared_and, starts)
            self.levels.append((shared_and, ~(shared_or ^ shared_and)))

    def near(self, distance: int, block: int = 2048) -> Iterator[tuple]:
        """Arrays of positions (a, b), a before b in Gray order, at most ``distance`` apart."""
        import numpy as np

        for at in range(0, len(self.codes), block):
            ask = np.arange(at, min(at + block, len(self.codes)))
            seeker, node = ask, np.zeros(len(ask), dtype=np.int64)
            spent = np.zeros(len(ask), dtype=np.uint8)
            above = np.zeros(len(ask), dtype=np.uint64)
            for depth in range(len(self.levels) - 1, -1, -1):
                bits, mask = self.levels[depth]
                if depth < len(self.levels) - 1:
                    seeker, node, spent, above = self._children(seeker, node, spent, above, len(bits))
                fresh = mask[node] & ~above
                spent = spent + np.bitwise_count((self.codes[seeker] ^ bits[node]) & fresh)
                # A pair is wanted once: nodes whose last code stands before the seeker hold none.
                stays = (spent <= distance) & ((node + 1) * self.fanout ** (depth + 1) > seeker)
                seeker, node, spent, above = seeker[stays], node[stays], spent[stays], mask[node[stays]]
            if self.levels:
                seeker, node, spent, above = self._children(seeker, node, spent, above, len(self.codes))
                spent = spent + np.bitwise_count((self.codes[seeker] ^ self.codes[node]) & ~above)
                stays = (spent <= distance) & (node > seeker)
                yield seeker[stays], node[stays]

    def _children(self, seeker, node, spent, above, count: int):
        import numpy as np

        child = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
        real = child < count
        again = lambda x: np.repeat(x, self.fanout)[real]
        return again(seeker), child[real], again(spent), again(above)


def spanning_links(codes, distance: int) -> list[tuple[int, int]]:
    """(code, root of its component) for the codes that are not roots, from all links among ``codes``."""
    index = GrayIndex(codes)
    root = list(range(len(index.codes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in index.near(distance):
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    names = index.codes.view("int64").tolist()
    return [(names[x], names[find(x)]) for x in range(len(names)) if root[x] != x]


def _runs(start: int, stop: int, parts: int) -> list[tuple[int, int]]:
    cuts = [start + (stop - start) * i // parts for i in range(parts + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _link_rows(distance: int):
    """Streams rows (bucket, fp) in bucket order, whole buckets at a time, and returns links."""

    def links(batches):
        import numpy as np
        import pyarrow as pa

        def solved(parts):
            found = spanning_links(np.unique(np.concatenate(parts)).view(np.uint64), distance)
            columns = [pa.array([f[side] for f in found], pa.int64()) for side in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        held, tail = [], None
        for batch in batches:
            bucket, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(fp):
                continue
            if sum(map(len, held)) >= INDEXED and bucket[0] != tail:
                yield solved(held)
                held = []
            last = int(np.argmax(bucket == bucket[-1]))  # the last bucket may go on in the next batch
            if last and sum(map(len, held)) + last >= INDEXED:
                yield solved([*held, fp[:last]])
                held, fp = [], fp[last:]
            held.append(fp)
            tail = bucket[-1]
        if held:
            yield solved(held)

    return links


def _bucket(fp: Column, run: tuple[int, int]) -> Column:
    """Bits ``run`` of a fingerprint, counted from the lowest."""
    width = run[1] - run[0]
    bits = F.shiftrightunsigned(fp, run[0]) if run[0] else fp
    return bits if width >= 64 else bits.bitwiseAND(F.lit((1 << width) - 1))


def links(codes: DataFrame, distance: int = 2, max_group: int = MAX_GROUP) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join every pair within ``distance``."""
    if max_group < 1 << distance:
        raise ValueError("max_group must be at least 2 ** distance")
    spark = codes.sparkSession
    runs = _runs(0, 64, distance + 1)
    rest = codes.select(
        "fp",
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("path"), _bucket(F.col("fp"), r).alias("value")) for i, r in enumerate(runs)
        ])).alias("k"),
    ).select("fp", F.xxhash64("k.path", "k.value").alias("bucket"), F.array("k.path").alias("path"))
    found: list[DataFrame] = []
    while True:
        rest = stored(rest, "simhash-buckets")
        sizes = rest.groupBy("bucket", "path").count().filter(F.col("count") > max_group).drop("count")
        sizes = stored(sizes, "simhash-large")
        large = not sizes.isEmpty()
        small = rest.join(sizes, ["bucket", "path"], "left_anti") if large else rest
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        small = small.select("bucket", "fp").repartition(parts, "bucket").sortWithinPartitions("bucket")
        found.append(small.mapInArrow(_link_rows(distance), "a long, b long"))
        if not large:
            break
        rest = _cut_again(rest.join(sizes, ["bucket", "path"]), runs, distance)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return stored(out.distinct(), "simhash-links")


def _cut_again(rest: DataFrame, runs: list[tuple[int, int]], distance: int) -> DataFrame:
    """Rows of large buckets in narrower ones: two linked rows also agree on a part of another run.

    A path names the first run and then, for each further level, one of ``distance + 1`` parts of
    the longest stretch of bits that the path has not fixed yet.
    """
    paths = [tuple(r["path"]) for r in rest.select("path").distinct().collect()]
    out = None
    for path in sorted(paths):
        options = _stretches(path, runs, distance)
        if not options:
            continue  # at most ``distance`` open bits: too few fingerprints to be a large bucket
        keys = F.array(*[
            F.struct(
                F.array(*[F.lit(p) for p in (*path, i)]).alias("path"),
                F.xxhash64(F.col("bucket"), F.lit(i), *[_bucket(F.col("fp"), r) for r in part]).alias("bucket"),
            )
            for i, part in enumerate(options)
        ])
        part = rest.filter(F.col("path") == F.array(*[F.lit(p) for p in path])).select("fp", F.explode(keys).alias("k"))
        part = part.select("fp", "k.bucket", "k.path")
        out = part if out is None else out.unionByName(part)
    return out


def _stretches(path: tuple[int, ...], runs: list[tuple[int, int]], distance: int) -> list[list[tuple[int, int]]]:
    """The parts of the bits that a path leaves open, each a list of runs."""
    free = [b for i, r in enumerate(runs) if i != path[0] for b in range(*r)]
    for step in path[1:]:
        cuts = _runs(0, len(free), distance + 1)
        if step >= len(cuts):
            return []
        free = free[: cuts[step][0]] + free[cuts[step][1] :]
    out = []
    for a, b in _runs(0, len(free), distance + 1):
        bits, part = free[a:b], []
        for bit in bits:
            if part and part[-1][1] == bit:
                part[-1] = (part[-1][0], bit + 1)
            else:
                part.append((bit, bit + 1))
        out.append(part)
    return out if len(free) > distance else []


# --- components ---


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node.

    Large-star and small-star steps in turns until nothing changes; each turn's edges are a written
    table. Minima are summed up before any shuffle, and a node with very many edges is split by the
    join of two written tables.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "cc-min")
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter(F.col("a") != F.col("b")).distinct(), "cc")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "cc-min")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "cc")
        now = _signature(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def _rooted(codes: DataFrame, distance: int, max_group: int) -> DataFrame:
    """``fp``, ``least`` and the root of the component, from distinct fingerprints with their ``least``."""
    labels = components(links(codes.select("fp"), distance, max_group))
    return stored(codes.join(labels, codes.fp == labels.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"), "simhash-roots")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, distance: int = 2,
    seed: int = 42, max_group: int = MAX_GROUP,
) -> DataFrame:
    """Per row: ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id of its component."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    codes = stored(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-codes")
    roots = _rooted(codes, distance, max_group)
    least = stored(roots.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    named = stored(roots.join(least, "root").select("fp", "component_id"), "simhash-named")
    return marked.join(named, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, distance: int = 2, seed: int = 42
) -> DataFrame:
    """One document of each component, with its own columns: that of the smallest id, null ids last.

    Rows are told apart by id and two hashes of the text; of rows with the same id the smallest text
    hash comes first. If several components would keep different texts under one id, the first of
    them stays, so that ids stay unique; each text with a null id stands for itself, and of rows with
    equal id and text one stays. The documents are read and not copied: only the keys of the rows that
    go are joined with them, so texts move at most once, and not at all while Spark can broadcast those
    keys; rows repeated with id and text are the only ones that are grouped.
    """
    text = F.col(text_col)
    key = F.struct(
        F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"),
        F.xxhash64(text).alias("text"), F.hash(text).alias("check"),
    )
    mark = free_name(docs, "key")
    marked = docs.withColumn(mark, key)
    keys = fingerprints(marked, mark, text_col, shingle, seed).withColumnRenamed(mark, "key")
    keys = stored(keys.groupBy("key", "fp").agg(F.count("*").alias("n")), "simhash-keys")
    codes = stored(keys.groupBy("fp").agg(F.min("key").alias("least")), "simhash-codes")
    least = _rooted(codes, distance, MAX_GROUP).groupBy("root").agg(F.min("least").alias("key"))
    # A null id is one of its own for each text.
    own = F.when(F.col("key.nameless"), F.struct("key.text", "key.check"))
    kept = stored(least.groupBy("key.id", own).agg(F.min("key").alias("key")).select("key"), "simhash-kept")
    leaving = stored(keys.join(kept, "key", "left_anti").select("key").distinct(), "simhash-leaving")
    again = stored(keys.filter("n > 1").join(kept, "key", "left_semi").select("key").distinct(), "simhash-again")

    def meet(rows: DataFrame, with_keys: DataFrame, how: str) -> DataFrame:
        return rows.join(with_keys.withColumnRenamed("key", mark), mark, how)

    out = meet(marked, leaving.unionByName(again), "left_anti")
    if not again.isEmpty():
        out = out.unionByName(meet(marked, again, "left_semi").dropDuplicates([mark]))
    return out.select(*docs.columns)

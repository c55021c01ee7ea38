"""Collocations: phrases of two to four words that stay together, counted by top-order marginalisation.

Every word opens one window: the word and the next three of its piece as lead columns, padded with ""
where the piece ends. Only these longest windows are counted, per task first; one Spark ROLLUP over
their columns sums them to all shorter prefixes, which are the counts of all shorter phrases, of
words, and of all words of a language. A prefix that ends in padding is the shorter phrase's and is
left out.

Most windows of a text are met once. Sieves keep them short: pairs of words, and then phrases of three
whose pairs are marked, are hashed, and a bitmap of fixed size marks the hashes that come at least as
often as a candidate must. A window is padded from the first phrase without a mark on, as no candidate,
nor a part of one, holds it. Two phrases on one place only keep a window longer than needed; the counts
of candidates and their parts are those of the rollup and exact.

Texts are cut into words once, in Arrow batches, and written as blocks of word numbers of one language,
about ``BLOCK_WORDS`` each, beside the document at hand. A word or window on a third of all places is
one row per block before the shuffle. Only the bitmaps, of ``PLACES`` bits each, go through the driver.

Cases: a null text is empty; a null language is ``und``; documents are counted by rows, so repeated
rows count repeatedly and ids are not read; a text without words adds nothing; an empty table gives no
rows; columns other than the text and the language are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import stored
from tabloom.session import scratch_path

# Characters that end a piece (fixed values); all become line feeds.
PIECE_ENDS = b".,;:!?\x0b\x0c\r"
TO_LINES = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))
BLOCK_WORDS = 1_000_000
BLOCK_FILE = 8 << 20  # bytes of a Parquet row group of blocks
# A block is megabytes long: sizes are looked at from the first row on, where Parquet waits for a hundred. Zstandard is
# unpacked by pieces; Snappy takes memory outside the heap for a whole page, twice, and keeps it.
BLOCK_OPTIONS = {"compression": "zstd", "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
BATCH_ROWS = 1 << 16  # rows that a task hands over at once
PLACES = 1 << 27
BUCKET = 32_768  # bits in a bucket of Spark's bitmap functions
ORDER = 4
WORDS = [f"w{i}" for i in range(1, ORDER + 1)]


class Block:
    """Words of one language by number from 1 on, and a text as these numbers; 0 is the end of a piece."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.stream = lang, {}, []

    def add(self, raw: bytes) -> None:
        numbers, stream = self.numbers, self.stream
        for piece in raw.lower().translate(TO_LINES).split(b"\n"):
            words = piece.split()  # bytes split at ASCII white space: blanks and tabs are left of it
            if words:
                stream.extend([numbers.setdefault(w, len(numbers) + 1) for w in words])
                stream.append(0)


def encoded(texts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(lang, words, stream): the blocks of all texts, in a written table."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: dict[str, Block] = {}

        def row(block: Block) -> pa.RecordBatch:
            words = pa.array([list(block.numbers)], pa.list_(pa.binary()))
            stream = pa.array([np.array(block.stream, "<i4").tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([block.lang]), words, stream], names=["lang", "words", "stream"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = held.get(lang) or held.setdefault(lang, Block(lang))
                block.add(text.as_py() or b"")
                if sum(len(b.stream) for b in held.values()) >= block_words * 2 or len(block.stream) >= block_words:
                    full = max(held.values(), key=lambda b: len(b.stream))
                    yield row(held.pop(full.lang))
        for block in held.values():
            if block.stream:
                yield row(block)

    blocks = texts.mapInArrow(run, "lang string, words array<binary>, stream binary")
    path = scratch_path(texts.sparkSession, "phrase-blocks")
    blocks.write.options(**BLOCK_OPTIONS).option("parquet.block.size", str(BLOCK_FILE)).parquet(path)
    return texts.sparkSession.read.schema(blocks.schema).parquet(path)


def block_of(batch, i: int):
    """(language, its words with "" at 0, numbers, hashes of the words) of a row."""
    import numpy as np
    import xxhash

    lang, words = batch.column(0)[i].as_py(), [b"", *batch.column(1)[i].as_py()]
    seed = xxhash.xxh32_intdigest(lang.encode())
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
    return lang, words, np.frombuffer(batch.column(2)[i].as_py(), "<i4"), hashes


def spread(code):
    """Mixes the bits of 64-bit numbers."""
    import numpy as np

    code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(32))


def place_of(code, places: int):
    """The bit that a code has in a bitmap."""
    import numpy as np

    return (code % np.uint64(places)).astype(np.int64)


def marked_in(bits: bytes, place):
    import numpy as np

    return (np.frombuffer(bits, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def growing(stream, hashes, sieves: list[bytes], places: int):
    """For phrases of one, two and more words: a code of 63 bits at each place, and whether all they hold is marked.

    ``sieves`` are those of two words on; the last arrays are of the first order without one. A phrase is
    one only if both phrases a word shorter in it are.
    """
    import numpy as np

    mixed, whole = hashes[stream], stream > 0
    yield spread(mixed) >> np.uint64(1), whole
    for order in range(2, len(sieves) + 3):
        mixed = spread(mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[stream[order - 1 :]])
        code, whole = mixed >> np.uint64(1), whole[:-1] & whole[1:]
        if order - 2 < len(sieves):
            whole = whole & marked_in(sieves[order - 2], place_of(code, places))
        yield code, whole


def sieve(blocks: DataFrame, least: int, lower: list[bytes], places: int = PLACES) -> bytes:
    """The bitmap of places of codes that come at least ``least`` times, one order above the ``lower`` sieves."""
    import pyarrow as pa

    shared = blocks.sparkSession.sparkContext.broadcast(lower)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                _, _, stream, hashes = block_of(batch, i)
                *_, (code, whole) = growing(stream, hashes, shared.value, places)
                codes, counts = np.unique(code[whole], return_counts=True)
                codes, counts = codes.astype(np.int64), counts.astype(np.int64)
                for at in range(0, len(codes), BATCH_ROWS):
                    some = slice(at, at + BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays([pa.array(codes[some]), pa.array(counts[some])], names=["code", "n"])

    often = blocks.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    place = F.col("code") % places + 1  # Spark's buckets count from 1
    marked = often.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = bytearray(-(-places // BUCKET) * (BUCKET // 8))
    for r in marked.collect():  # at most places / 32,768 rows of 4 KB
        at = (r["bucket"] - 1) * (BUCKET // 8)
        bits[at : at + len(r["bits"])] = r["bits"]
    return bytes(bits)


def sieves(blocks: DataFrame, least: int, places: int = PLACES) -> list[bytes]:
    """A sieve for each order from pairs to one below the longest windows."""
    found: list[bytes] = []
    for _ in range(2, ORDER):
        found.append(sieve(blocks, least, found, places))
    return found


def counted_windows(batch, i: int, marked: list[bytes], places: int, rows: int = BATCH_ROWS) -> Iterator:
    """(lang, w1 to w4, n) of the block in a row, at most ``rows`` windows at once: only these are spelled out."""
    import numpy as np
    import pyarrow as pa

    lang, words, stream, hashes = block_of(batch, i)
    # Lead columns: a window goes on as far as all it holds is marked.
    leads = []
    for ahead, (_, whole) in enumerate(growing(stream, hashes, marked, places)):
        lead = np.zeros(len(stream), np.int32)
        lead[: len(whole)] = np.where(whole, stream[ahead:], 0)
        leads.append(lead)
    alone = np.bincount(leads[0][(stream > 0) & (leads[1] == 0)], minlength=len(words))
    at, bit = np.flatnonzero(leads[1]), max(1, len(words).bit_length())
    head, tail = [(leads[k][at].astype(np.int64) << bit) | leads[k + 1][at] for k in (0, 2)]
    del leads, at
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    new = np.ones(len(head), bool)
    new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    new = np.flatnonzero(new)
    counts, mask = np.diff(np.append(new, len(head))), (1 << bit) - 1
    head, tail, own = head[new], tail[new], np.flatnonzero(alone)
    del order, new
    spelled = pa.array(words, pa.binary()).cast(pa.string())
    none = np.zeros(len(own), np.int64)
    columns = [head >> bit, head & mask, tail >> bit, tail & mask]
    columns = [np.concatenate([x, y]) for x, y in zip(columns, [own, none, none, none])]
    n = np.concatenate([counts, alone[own]]).astype(np.int64)
    for at in range(0, len(n), rows):
        some = slice(at, at + rows)
        found = [spelled.take(pa.array(c[some])) for c in columns]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n[some]), pa.string()), *found, pa.array(n[some])], names=["lang", *WORDS, "n"]
        )


def windows(blocks: DataFrame, marked: list[bytes], places: int = PLACES) -> DataFrame:
    """(lang, w1 to w4, n): longest windows, padded with "", counted per block."""
    import pyarrow as pa

    shared = blocks.sparkSession.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from counted_windows(batch, i, shared.value, places)
                pa.default_memory_pool().release_unused()

    return blocks.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, w4 string, n long")


def phrase_counts(
    docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang", places: int = PLACES, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(lang, size, phrase, f): words and phrases met at least ``least`` times; size 0 has the language's count of words."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    blocks = encoded(texts, block_words)
    counted = windows(blocks, sieves(blocks, least, places), places)
    sums = counted.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # The level has a bit for each column that is summed away, the last column's lowest.
    size = F.when(F.col("level") == 15, 0).when(F.col("level") == 7, 1).when(F.col("level") == 3, 2)
    size = size.when(F.col("level") == 1, 3).when(F.col("level") == 0, 4)
    last = F.when(F.col("level") == 7, F.col("w1")).when(F.col("level") == 3, F.col("w2")).when(F.col("level") == 1, F.col("w3")).when(F.col("level") == 0, F.col("w4"))
    real = F.coalesce(last, F.lit("w")) != ""
    kept = sums.filter(F.col("lang").isNotNull() & real & ((F.col("f") >= least) | (F.col("level") == 15)))
    return kept.select("lang", size.alias("size"), F.concat_ws(" ", *WORDS).alias("phrase"), "f")


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80, scale: int = 2_000_000,
    text_col: str = "text", lang_col: str = "lang", places: int = PLACES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase met ``a`` times is cut in two, met ``l`` and ``r`` times, where floor(scale * a / (l + r)) is
    least, ties at the earlier cut. Phrases inside a longer one that has ``cover`` percent of their count
    are left out.
    """
    counts = stored(phrase_counts(docs, least, text_col, lang_col, places, block_words), "phrase-counts")
    words = F.split("phrase", " ")
    # Products may pass 64 bits.
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = counts.filter(F.col("size") >= 2).select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))
    part = lambda start, length: F.concat_ws(" ", F.slice("words", start, length))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    firsts = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    scored = scored.withColumn("whole", exact("a") * F.lit(scale)).withColumn("parts", exact("l") + exact("r"))
    scored = scored.withColumn("score", F.expr("whole div parts"))
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a").agg(least_cut).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")

    spans = [(i, n) for n in range(2, ORDER) for i in range(1, ORDER - n + 2)]
    inner = F.array(*[F.when(F.col("size") >= i + n - 1, F.when(F.col("size") > n, part(F.lit(i), F.lit(n)))) for i, n in spans])
    longer = candidates.filter(F.col("size") > 2).select("lang", F.col("a").alias("outer"), F.explode(F.array_compact(inner)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    covered = (exact("outer") * 100 >= exact("a") * cover)
    stays = scored.join(longer, ["lang", "phrase"], "left").filter(F.col("outer").isNull() | ~covered)

    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = stays.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = counts.filter(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )

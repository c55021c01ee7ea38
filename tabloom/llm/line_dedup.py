"""Line dedup: long lines that many documents share stay in one document only.

Lines are exploded, normalised and hashed; the distinct documents of each hash are counted, hashes
over the threshold are matched with the documents that hold them, and each document keeps its other
lines in their order. Only hashes travel; a text is shuffled once, to meet its document's hashes.
A line on a third of all documents is one row per document, summed before the shuffle, and the
match with the shared lines is a join of two written tables that adaptive execution can split.

Cases: a null or empty text is one empty line and is never dropped; repeated rows with one
document id count as one document; rows with a null id never count, never lose a line and stay;
an empty table gives an empty table; columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import lower_ascii, stored

BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def key_hash(key: Column) -> Column:
    """128 bits, so that different lines do not meet by chance."""
    return F.struct(F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 40, min_docs: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(document id, hash) pairs of long lines, and the shared hashes with the one document that keeps them."""
    pairs = (
        docs.select(F.col(id_col).alias("id"), F.explode(F.transform(lines_of(F.col(text_col)), line_key)).alias("key"))
        .filter(F.col("id").isNotNull() & (F.length("key") >= min_length))
        .select("id", key_hash(F.col("key")).alias("h"))
        .select("id", "h.h1", "h.h2")
        .distinct()
    )
    pairs = stored(pairs, "line-pairs")
    shared = pairs.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
    return pairs, stored(shared.filter(F.col("n") >= min_docs).drop("n"), "line-shared")


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 40, min_docs: int = 5
) -> DataFrame:
    """The documents with shortened texts, and ``n_lines`` (before) and ``n_dropped``.

    A document all of whose lines go keeps an empty text; a text that loses nothing is unchanged.
    """
    pairs, shared = shared_lines(docs, id_col, text_col, min_length, min_docs)
    drops = (
        pairs.join(shared, ["h1", "h2"])
        .filter(F.col("id") < F.col("keeper"))
        .groupBy("id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("_drops"))
    )
    drops = stored(drops, "line-drops").withColumnRenamed("id", "_id")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    lines = lines_of(F.col(text_col))

    def stays(line: Column) -> Column:
        key = line_key(line)
        return (F.length(key) < min_length) | ~F.array_contains(F.col("_drops"), key_hash(key))

    # The pairs to drop grow with the documents: a shuffled join at every size, split where skewed.
    joined = docs.select(*columns).join(drops.hint("merge"), F.col(id_col) == F.col("_id"), "left")
    kept = F.when(F.col("_drops").isNotNull(), F.filter(lines, stays))
    joined = joined.withColumn("_kept", kept).withColumn("n_lines", F.size(lines).cast("long"))
    return joined.select(
        *[
            F.when(F.col("_drops").isNull(), F.col(c)).otherwise(F.array_join("_kept", "\n")).alias(c)
            if c == text_col
            else F.col(c)
            for c in columns
        ],
        "n_lines",
        F.when(F.col("_drops").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
    )

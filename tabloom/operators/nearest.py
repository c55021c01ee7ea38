"""The best partners by inner product, pruned by norms.

Partners are put in order by falling length of their vectors and cut into blocks. By the
Cauchy-Schwarz inequality no score of a block exceeds the owner's length times the longest vector of the
block, so an owner whose k-th score so far is above that is finished with this and all later blocks.
Blocks are taken in rounds; the vectors of one round are broadcast, a bounded number of bytes
whatever the number of partners, and owners that are not finished carry their best ones, and with
them their k-th score, from round to round in a written table.

With ``prune=False`` nothing is skipped: every owner is multiplied with every block.

Products are made in single precision first. A pair whose product lies below the owner's k-th score by more than
the rounding of such a product can differ is done; the others are scored exactly, in doubles or, with ``single``,
in floats summed place by place of the vectors.

Owners are dealt evenly once and never move after that, and a hot owner or partner is one row. Ties in score go to the
smaller partner. All vectors have one length. Vectors that are null, or hold a null or a number that is not finite, take no part;
with fewer than ``k`` partners an owner gets all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tabloom.operators.ranking import numbered
from tabloom.session import written

BLOCK = 1_024
ROUND_BYTES = 32 << 20
OWNERS = 1_024


def _vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v, norm) of the rows that take part."""
    v = F.transform(vector, lambda x: x.cast("double"))
    whole = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return df.select(F.col(key).cast("long").alias("key"), v.alias("v")).where(whole).withColumn("norm", norm)


def best_partners(
    owners: DataFrame, partners: DataFrame, k: int, owner: str = "id", partner: str = "id", vector: str = "features",
    block: int = BLOCK, round_bytes: int = ROUND_BYTES, prune: bool = True, single: bool = False,
) -> DataFrame:
    """(owner, best, blocks): ``best`` is an array of (partner, score) by falling score, ``blocks`` how many
    blocks of partners the owner was multiplied with, which are all without ``prune``. With ``single`` scores are floats."""
    import pyarrow as pa

    spark = owners.sparkSession

    lengths = F.col("norm").desc()
    ordered = written(numbered(_vectors(partners, partner, vector), [lengths, F.col("key")], "place"), "partners")
    size = ordered.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.min(F.size("v")).alias("least")).first()
    width = size["width"] or 0
    if width != (size["least"] or 0):
        raise ValueError("vectors of different lengths")
    per_round = max(1, round_bytes // (8 * (width + 2)) // block) * block
    state = "key long, v array<double>, norm double, best array<struct<partner: long, score: double>>, blocks long, open boolean"
    none = F.array().cast("array<struct<partner: long, score: double>>")
    active = _vectors(owners, owner, vector).select("key", "v", "norm", none.alias("best"), F.lit(0).cast("long").alias("blocks"), F.lit(True).alias("open"))
    active = active.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    finished = []

    for start in range(0, size["n"], per_round):
        held = ordered.where(F.col("place").between(start, start + per_round - 1)).toArrow().sort_by("place")  # at most round_bytes
        matrix = held.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        shared = spark.sparkContext.broadcast((held.column("key").to_numpy(), matrix, held.column("norm").to_numpy()))
        final = start + per_round >= size["n"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, vectors, norms = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, OWNERS):
                    yield _round(batch.slice(at, OWNERS), keys, vectors, norms, k, block, final, width, prune, single)

        done = written(active.mapInArrow(run, state), "owners")
        shared.destroy()
        finished.append(done.where(~F.col("open")))
        active = done.where("open")
        if final or active.isEmpty():
            break
    result = active if not finished else finished[0]
    for part in finished[1:]:
        result = result.unionByName(part)
    return result.select(F.col("key").alias("owner"), "best", "blocks")


def _round(batch, keys, vectors, norms, k: int, block: int, final: bool, width: int, prune: bool = True, single: bool = False):
    """The owners of a batch after the blocks of one round."""
    import numpy as np
    import pyarrow as pa

    own = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    length, blocks = batch.column(2).to_numpy(), batch.column(4).to_numpy().copy()
    held, nobody = batch.column(3), np.iinfo(np.int64).max
    sizes = held.value_lengths().to_numpy()
    ids, scores = np.full((len(own), k), nobody), np.full((len(own), k), -np.inf)
    filled = np.arange(k) < sizes[:, None]
    ids[filled], scores[filled] = (held.flatten().field(i).to_numpy() for i in range(2))
    kth = scores[:, k - 1].copy()
    # Floats hold the vectors and their products where no number is huge; what they round off is in ``slack``.
    narrow = max(length.max(initial=0), norms.max(initial=0)) < 1e15
    kind = np.float32 if narrow else np.float64
    slack = (width + 3) * 2.0**-22 if narrow or single else 0.0
    room = np.empty(len(own) * min(block, len(keys)), kind)
    live, own_live, kth_live = np.arange(len(own)), own.astype(kind), kth
    for start in range(0, len(keys), block):
        # A margin for rounding: a bound that is a little too high only costs time.
        may_stay = kth_live <= length[live] * norms[start] * (1 + (slack if single else 1e-9)) + 1e-300
        if prune and not may_stay.all():
            live, own_live, kth_live = live[may_stay], own_live[may_stay], kth_live[may_stay]
            if not len(live):
                break
        blocks[live] += 1
        others = vectors[start : start + block]
        products = np.matmul(own_live, others.astype(kind).T, out=room[: len(live) * len(others)].reshape(len(live), -1))
        margin = slack * length[live] * norms[start] + 1e-25 if slack else np.zeros(len(live))
        least = kth_live - margin
        # A product that is no number is never the largest of a row.
        hit = np.flatnonzero((products.max(axis=1) if narrow else np.fmax.reduce(products, axis=1)) >= least)
        if len(hit):
            at = live[hit]
            row, column = _candidates(products[hit], least[hit], margin[hit], k)
            exact = _exact(own[at], others, row, column, single) if slack else products[hit][row, column]
            better = exact >= kth_live[hit][row]
            row, column, exact = row[better], column[better], exact[better]
            if len(row):
                ids[at], scores[at] = _merged(ids[at], scores[at], row, keys[start : start + block][column], exact, k)
                kth_live[hit] = scores[at, k - 1]
    still = np.zeros(len(own), bool)
    if not final:
        still[live] = True
    filled = ids != nobody
    offsets = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(ids[filled], pa.int64()), pa.array(scores[filled], pa.float64())], ["partner", "score"])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), batch.column(2), pa.ListArray.from_arrays(pa.array(offsets), pairs), pa.array(blocks, pa.int64()), pa.array(still)],
        names=["key", "v", "norm", "best", "blocks", "open"],
    )


def _candidates(products, least, margin, k: int):
    """(rows, columns) of the products that may be among the ``k`` best of their row, given the least that counts."""
    import numpy as np

    may = products >= least[:, None]
    many = np.flatnonzero(np.count_nonzero(may, axis=1) > k)
    if len(many):
        # At least k scores reach the k-th best product less the margin; what is below that by the margin again is not among them.
        own = products[many]
        top = np.partition(np.where(may[many], own, -np.inf), -k, axis=1)[:, -k]
        may[many] &= own >= (top - 2 * margin[many])[:, None]
    return np.nonzero(may)


def _exact(own, others, row, column, single: bool):
    """The products of the pairs, in doubles or in floats that are summed place by place."""
    import numpy as np

    if not single:
        return np.einsum("ij,ij->i", own[row], others[column])
    a, b = own.astype(np.float32)[row], others.astype(np.float32)[column]
    total = np.zeros(len(row), np.float32)
    for place in range(a.shape[1]):
        total += a[:, place] * b[:, place]
    return total.astype(float)


def _merged(ids, scores, row, partners, products, k: int):
    """The ``k`` best of each row's best so far and of its further pairs, by rising ``row``."""
    import numpy as np

    rows = np.concatenate([np.repeat(np.arange(len(ids)), k), row])
    sizes = k + np.bincount(row, minlength=len(ids))
    ids, scores = np.concatenate([ids.ravel(), partners]), np.concatenate([scores.ravel(), products])
    order = np.lexsort((ids, -scores, rows))
    first = order[(np.cumsum(sizes) - sizes)[:, None] + np.arange(k)]
    return ids[first], scores[first]


def best_rows(found: DataFrame, owner: str, partner: str) -> DataFrame:
    """(owner, partner, rating, place), one row for each of an owner's best partners."""
    exploded = found.select(F.col("owner").alias(owner), F.posexplode("best").alias("place", "b"))
    return exploded.select(owner, F.col("b.partner").alias(partner), F.col("b.score").alias("rating"), (F.col("place") + 1).alias("place"))

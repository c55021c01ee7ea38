"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

The vectors are dealt to shards of bounded size by a hash of a row number in a written table, so that
repeated rows spread over all shards, and the queries to blocks. Each
(shard, block) pair is one task's group: it builds a ball tree over the shard and searches it for
each query of the block, opening nodes by the largest inner product they can hold (centre product
plus query length times radius) and leaving all nodes that cannot reach the current k-th score. A
first round over one shard gives every query a k-th score, which the search of all other shards
starts from; within a shard the k-th score rises as results come in. The shards' results, at most
k each, are ranked at the end. Results are exact; ties go to the smaller id.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do rows with
a null id; shorter vectors are filled up with zeros; repeated rows are candidates of their own but
a query with repeated rows is asked once (its first vector in order); a query never finds its own
id; an empty table gives an empty table; only the id and vector columns are read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.llm.common import stored

SHARD_ROWS, BLOCK_QUERIES, LEAF = 1024, 2048, 64
EXACT = 2.0**53  # integers below are exact as doubles


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id`` and ``v``: floor(scale * x) of each component, of the vectors that take part."""
    x = F.col("v")
    good = F.col("id").isNotNull() & x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(good).withColumn("v", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))))


class BallTree:
    """Nodes over the rows of ``points``: centre, radius, and either two children or a range of rows."""

    def __init__(self, points, leaf: int = LEAF):
        import numpy as np

        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, end, left child, right child
        centres, radii = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            number = len(self.nodes)
            rows = points[self.order[start:end]]
            centre = rows.mean(axis=0)
            away = np.sqrt(((rows - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max())
            self.nodes.append((start, end, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, number, right) if side == 0 else (a, b, left, number)
            if end - start > leaf and radii[-1] > 0:
                # Two far points; each row goes with the nearer one, halves at least by rank.
                one = rows[away.argmax()]
                two = rows[((rows - one) ** 2).sum(axis=1).argmax()]
                along = rows @ (two - one)
                middle = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argsort(along, kind="stable")]
                todo += [(start + middle, end, number, 1), (start, start + middle, number, 0)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.points = points[self.order]

    def top(self, query, k: int, own: int, ids, floor: float) -> list[tuple[float, int]]:
        """The k best (score, -id) of other ids with scores of at least ``floor``, in no order."""
        import numpy as np

        length = float(np.sqrt((query**2).sum()))
        bounds = self.centres @ query + length * self.radii
        bounds = bounds + np.abs(bounds) * 1e-9 + 1e-3  # rounding never hides a result
        best: list[tuple[float, int]] = []
        open_nodes = [(-bounds[0], 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            least = max(floor, best[0][0]) if len(best) == k else floor
            if -bound < least:
                break
            start, end, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= least:
                        heapq.heappush(open_nodes, (-bounds[child], child))
                continue
            scores = self.points[start:end] @ query
            for i in np.flatnonzero(scores >= least).tolist():
                found = (scores[i], -int(ids[start + i]))
                if -found[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return best


def _plain(vectors, queries, ids, own, k: int) -> list[list[tuple[int, int]]]:
    """The same in exact integers, for components too large for doubles."""
    out = []
    for query, me in zip(queries, own):
        scores = [sum(int(a) * int(b) for a, b in zip(query, v)) for v in vectors]
        out.append(heapq.nlargest(k, [(s, -int(i)) for s, i in zip(scores, ids) if i != me]))
    return out


def _filled(arrays, width: int):
    import numpy as np

    out = np.zeros((len(arrays), width), dtype=np.int64)
    for row, a in zip(out, arrays):
        row[: len(a)] = a
    return out


def _search(k: int):
    def search(queries, rows):
        import numpy as np
        import pandas as pd

        found: list[tuple] = []
        if len(queries) and len(rows):
            width = max(map(len, [*queries["v"], *rows["v"]]))
            asked, points = _filled(queries["v"].tolist(), width), _filled(rows["v"].tolist(), width)
            ids = rows["id"].to_numpy()
            largest = float(np.abs(asked.astype(float)).max(initial=0)) * float(np.abs(points.astype(float)).max(initial=0))
            if largest * max(width, 1) < EXACT and width:
                tree = BallTree(points.astype(np.float64))
                ids = ids[tree.order]
                answers = [
                    tree.top(q, k, own, ids, floor)
                    for q, own, floor in zip(asked.astype(np.float64), queries["id"], queries["floor"])
                ]
            else:
                answers = _plain(points, asked, ids, queries["id"], k)
            low, high = -(2**63), 2**63 - 1
            for own, best in zip(queries["id"], answers):
                found += [(own, -i, max(low, min(high, int(s)))) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = 1024.0, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``; ``is_query`` is a condition on ``id`` (the row's id)."""
    vectors = whole_vectors(rows, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id())
    vectors = stored(vectors, "topk-vectors")
    queries = vectors.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n_rows, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_queries // block_queries))
    # A row goes to its shard once for each block, a query to its block once for each shard.
    numbers = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b)))
    points = vectors.withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(shards)).cast("int"))
    points = points.withColumn("block", numbers(0, blocks - 1))
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(blocks)).cast("int"))

    def round_of(asked: DataFrame, part: DataFrame) -> DataFrame:
        pairs = asked.groupBy("shard", "block").cogroup(part.groupBy("shard", "block"))
        return pairs.applyInPandas(_search(k), "query_id long, vec_id long, score long")

    first = round_of(
        queries.withColumn("shard", F.lit(0)).withColumn("floor", F.lit(float("-inf"))), points.filter("shard = 0")
    )
    first = stored(first, "topk-first")
    if shards == 1:
        return _ranked(first, k).select("query_id", "rank", "vec_id", "score")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
    floors = floors.filter(F.col("n") == k).select(F.col("query_id").alias("id"), "floor")
    asked = stored(queries.join(floors, "id", "left").fillna(float("-inf"), ["floor"]), "topk-asked")
    rest = round_of(asked.withColumn("shard", numbers(1, shards - 1)), points.filter("shard > 0"))
    return _ranked(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")

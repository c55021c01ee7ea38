"""Pruned best partners against all products."""

import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import nearest, recommend

rng = random.Random(5)


def rows_of(n, width, grid, shift=0):
    scale = lambda i: 4.0 / (1 + i)
    return [(i + shift, [scale(i % 37) * rng.randint(-grid, grid) / grid for _ in range(width)]) for i in range(n)]


def by_hand(owners, partners, k):
    out = {}
    for key, v in owners:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), other) for other, w in partners)[:k]
        out[key] = [(other, -score) for score, other in scored]
    return out


@pytest.mark.parametrize("block, round_bytes", [(1, 8 * 6 * 60), (7, 8 * 6 * 56), (64, 1 << 25)])
def test_best_partners_by_hand(spark, block, round_bytes):
    # Steps of 1/4 keep products exact, so that ties are ties.
    coarse = lambda rows: [(i, [round(4 * x) / 4 for x in v]) for i, v in rows]
    owners, partners = coarse(rows_of(60, 4, 4)), coarse(rows_of(150, 4, 4, 1000))
    partners += [(5000 + i, partners[0][1]) for i in range(5)]
    odd = [(9001, None), (9002, [1.0, None, 0.0, 0.0]), (9003, [float("nan"), 0.0, 0.0, 0.0]), (9004, [float("inf"), 0.0, 0.0, 0.0])]
    schema = "id long, features array<double>"
    a = spark.createDataFrame(owners + odd, schema).withColumn("key", F.lit("own"))
    b = spark.createDataFrame(partners + odd, schema).withColumn("norm", F.lit("own"))
    for k in (1, 10) if block > 1 else (1, 500):
        found = nearest.best_partners(a, b, k, block=block, round_bytes=round_bytes).collect()
        assert {r.owner: [(p.partner, pytest.approx(p.score)) for p in r.best] for r in found} == by_hand(owners, partners, k)
        if k == 1 and block < 10 and round_bytes < 1 << 20:
            assert sum(r.blocks for r in found) < len(owners) * -(-len(partners) // block) / 2  # most pairs of blocks are skipped


def test_equal_to_the_models_own(spark):
    ratings = spark.createDataFrame([(u, i, float((u * 7 + i * 3) % 5)) for u in range(80) for i in range(60) if (u + i) % 3], "u int, i int, r float")
    model = recommend.fit_als(ratings, "u", "i", "r", rank=4)
    for pruned, own in ((recommend.best_items_pruned, recommend.best_items), (recommend.best_users_pruned, recommend.best_users)):
        wanted = {(r[0], r.place): r for r in own(model, 5).collect()}
        mine = pruned(model, 5, block=8).collect()
        assert {(r[0], r.place) for r in mine} == set(wanted)
        for r in mine:
            assert r.rating == pytest.approx(wanted[r[0], r.place].rating, rel=1e-4, abs=1e-5)


def test_nobody_and_nothing(spark):
    none = spark.createDataFrame([], "id long, features array<double>")
    some = spark.createDataFrame([(1, [1.0, 2.0])], none.schema)
    assert nearest.best_partners(none, some, 3).collect() == []
    assert [(r.owner, r.best) for r in nearest.best_partners(some, none, 3).collect()] == [(1, [])]
    with pytest.raises(ValueError):
        nearest.best_partners(some, spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], none.schema), 3)


def test_best_items_in_the_models_types(spark):
    """What ``best_items`` and ``best_users`` give is what Spark's product of all gives, types included."""
    ratings = spark.createDataFrame([(u, i, float((u * 5 + i * 3) % 7)) for u in range(50) for i in range(40) if (u + i) % 3], "u int, i int, r float")
    model = recommend.fit_als(ratings, "u", "i", "r", rank=4)
    for mine, own in ((recommend.best_items, recommend.best_items_product), (recommend.best_users, recommend.best_users_product)):
        found, wanted = mine(model, 5), own(model, 5)
        assert [f.dataType for f in found.schema] == [f.dataType for f in wanted.schema] and found.columns == wanted.columns
        expected = {(r[0], r.place): r.rating for r in wanted.collect()}
        assert {(r[0], r.place): r.rating for r in found.collect()} == expected  # to the last digit
        assert "CartesianProduct" not in found._jdf.queryExecution().toString()


def test_owners_are_merged_together(monkeypatch):
    """One sort a block at most, not one for each owner that finds something; equal scores go to the smaller partner."""
    import numpy as np
    import pyarrow as pa

    sorts, plain = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda *a, **b: sorts.append(1) or plain(*a, **b))
    draw = np.random.default_rng(2)
    own, vectors = draw.integers(-9, 10, (40, 8)).astype(float), draw.integers(-9, 10, (4000, 8)).astype(float)
    keys = draw.permutation(4000)
    none = pa.array([[]] * 40, pa.list_(pa.struct([("partner", pa.int64()), ("score", pa.float64())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(own.tolist()), pa.array([1e9] * 40), none, pa.array([0] * 40, pa.int64())], names=["key", "v", "norm", "best", "blocks"])
    for k, block in ((10, 64), (3, 1000), (70, 64), (5000, 4000)):
        sorts.clear()
        out = nearest._round(batch, keys, vectors, np.ones(4000), k, block, True, 8)
        wanted = [keys[plain((keys, -(vectors @ v)))[:k]].tolist() for v in own]
        assert [[p["partner"] for p in row] for row in out.column(3).to_pylist()] == wanted
        assert len(sorts) <= -(-4000 // block)


def _random_model(spark, users, items, rank):
    draw = random.Random(3)
    rows = [(u, i, float(draw.randint(1, 50))) for u in range(users) for i in draw.sample(range(items), 12)]
    return recommend.fit_als(spark.createDataFrame(rows, "u int, i int, r float"), "u", "i", "r", rank=rank)


def test_best_items_multiplies_every_user_with_every_item(spark, monkeypatch):
    """No block is skipped, and the ratings are those of Spark's own product of all, to the last digit."""
    model, seen = _random_model(spark, 300, 500, 15), []
    plain = nearest.best_partners
    monkeypatch.setattr(nearest, "best_partners", lambda *a, **b: seen.append(plain(*a, block=16, **b)) or seen[-1])
    found = recommend.best_items(model, 7).collect()
    assert {r.blocks for r in seen[0].select("blocks").collect()} == {-(-model.itemFactors.count() // 16)}
    own = model.recommendForAllUsers(7).collect()
    assert {(r.u, r.place): r.rating for r in found} == {(r.u, p + 1): x.rating for r in own for p, x in enumerate(r.recommendations)}


def test_the_product_of_all_users_and_items_is_made_in_blocks(spark):
    model = _random_model(spark, 200, 300, 5)
    for mine, own in ((recommend.best_items_product, model.recommendForAllUsers), (recommend.best_users_product, model.recommendForAllItems)):
        found, wanted = mine(model, 4), own(4)
        assert "CartesianProduct" not in found._jdf.queryExecution().toString()  # Spark's own is one
        assert {(r[0], r.place): r.rating for r in found.collect()} == {(r[0], p + 1): x.rating for r in wanted.collect() for p, x in enumerate(r[1])}


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e20, 1e160])
@pytest.mark.parametrize("prune", [True, False])
def test_screened_products_lose_no_partner(spark, scale, prune):
    """Vectors that a float tells hardly apart, or cannot hold, give the same best ones as doubles."""
    draw = random.Random(8)
    near = lambda: [scale * (1 + draw.randint(-50, 50) * 2.0**-40) for _ in range(3)]
    owners, partners = [(i, [1.0, 2.0, 0.5 + i]) for i in range(5)], [(i, near()) for i in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, features array<double>")
    found = nearest.best_partners(frame(owners), frame(partners), 3, block=16, prune=prune).collect()
    for r in found:
        best = sorted((sum(a * b for a, b in zip(owners[r.owner][1], v)) for _, v in partners), reverse=True)[:3]
        assert [b.score for b in r.best] == pytest.approx(best, rel=1e-15, abs=0)

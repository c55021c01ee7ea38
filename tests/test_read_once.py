"""Rows that are read several times are joined once, and no step holds more than it needs."""

import pytest
from pyspark.sql import DataFrame

SF = "/root/testdata/sf0.001"


def test_ratings_are_read_from_a_table(spark):
    from tabloom.catalog.models import _ratings

    ratings = _ratings(spark, SF)
    assert ratings.count() > 0 and all("/tabloom/ratings-" in f for f in ratings.inputFiles())


def test_builds_read_a_table(spark):
    from tabloom.catalog.builds import _periods, _rows

    development, later = _periods(_rows(spark, SF))
    for rows in (development, *later.values()):
        assert all("/tabloom/modelling-" in f for f in rows.inputFiles())


def test_records_are_compressed_on_demand(spark, tmp_path):
    from tabloom.sources import readers, writers

    rows = spark.createDataFrame([(1, "a"), (2, None)], "k bigint, t string")
    path = writers.write_records(rows, str(tmp_path / "records"), compression="gzip")
    assert list((tmp_path / "records").glob("*.json.gz"))
    assert sorted(map(tuple, readers.read_records(spark, path, rows.schema).collect())) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("rows, parts", [(1, 0), (40 << 20, 40)])
def test_tasks_grow_in_number_with_the_rows(spark, rows, parts):
    from tabloom.catalog.base import by_rows

    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert by_rows(spark.range(10), rows, "id").rdd.getNumPartitions() == max(shuffled, parts)


def test_the_neural_network_keeps_no_second_copy(spark, monkeypatch):
    from tabloom.operators.encode import assemble
    from tabloom.operators.learners import train

    rows = assemble(spark.createDataFrame([(0.0, 1.0), (1.0, 3.0)] * 4, "label double, x double"), ["x"], "label")
    monkeypatch.setattr(type(rows), "persist", lambda self, *a: pytest.fail("persisted"))
    assert isinstance(train(rows, "neural_network", maxIter=2, seed=1).transform(rows), DataFrame)

"""Every registered query beside its SQL check, on the smallest tables."""

import pytest

import oracle
from conftest import SF
from tabloom.catalog import CHECKS, QUERIES

# Trained many times over; their parts are tested on their own.
SLOW = {"auto_train", "ml_mlp", "cv_cluster_sweep_bisecting", "ml_one_vs_rest"}


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_rows_match_sql(spark, sf, db, name):
    assert oracle.compare(QUERIES[name](spark, sf), db, CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS) - SLOW))
def test_gives_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())

"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check_queries import compare, connect
from conftest import SMALL
from pagedater.registry import oracles, queries


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, SMALL, name) == ""


def test_every_query_has_sql():
    """Three models are beyond SQL; their predictions are tested on rows of known classes."""
    assert set(queries.QUERIES) - set(oracles.ORACLES) == {"m1_decision_tree", "m2_svm", "m4_mlp"}
    assert set(oracles.ORACLES) <= set(queries.QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).columns == ["semicentury", "pages", "characters"]
    assert entry_points.entry(spark).count() > 0

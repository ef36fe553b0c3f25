"""Every named query against its SQL, on whole tables."""

import pytest

import __spark_entry__
from quillsieve.plans.catalog import QUERIES
from tests.compare import difference, duck

#: Queries of the optional folder have tests of their own.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, connection, name):
    problem, count, _ = difference(spark, name, sf_dir, connection)
    assert problem is None
    assert count > 0


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["lang", "num_docs", "num_chars", "mean_score"]
    assert result.count() > 0


def test_every_query_but_the_iterative_ones_has_sql():
    assert set(NAMES) - set(__spark_entry__.oracle_sql()) == {"train_head", "cluster_keywords"}

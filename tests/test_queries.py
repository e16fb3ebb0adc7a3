"""Every registered query against its reference SQL on the smallest test tables."""

import pytest

from checks import adapter, catalog, compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.database(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, connection, name):
    result = catalog.QUERIES[name](spark, SF_DIR)
    if name in catalog.ORACLES:
        assert compare.difference(result, connection, catalog.ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_no_query_is_empty(spark):
    empty = [name for name, run in catalog.QUERIES.items() if name.startswith(("b", "k")) and run(spark, SF_DIR).isEmpty()]
    assert empty == []


def test_every_reference_statement_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_messages_of_a_small_file_are_shared_by_all_cores(spark):
    raw = adapter.raw_messages(spark, "/root/testdata/sf0.001")
    assert raw.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism

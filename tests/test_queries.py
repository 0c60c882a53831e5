"""Every registered query against its oracle SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)

import pytest

import __spark_entry__ as entry
from tests import oracle

SF = f"{oracle.DATA}/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_its_sql(spark, con, name):
    assert oracle.compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0

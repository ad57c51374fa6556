"""Every query against its SQL on the smallest tables."""

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert len(got.columns) > 0
    if name in ORACLE:
        assert difference(got, con.execute(ORACLE[name]).df()) is None
    else:
        assert len(got) > 0

"""Every query with SQL against DuckDB, every other one for running at all."""

import pytest
from compare import rows, tables

from folioforge.plans import CATALOGUE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query(spark, duck, name):
    q = CATALOGUE[name]
    got = q.run(spark, SF).toPandas()
    if q.sql is None:
        assert len(got.columns)
        return
    want = duck.sql(q.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    # DuckDB gives nullable integers as floats
    plain = lambda r: [tuple(v[:-2] if v.endswith(".0") else v for v in x) for x in r]
    assert plain(a) == plain(b)

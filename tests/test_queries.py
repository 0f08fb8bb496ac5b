"""Every registered query against its SQL, and the shape of the registry itself."""

from __future__ import annotations

import pytest

from aduana.checks import oracle, registry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["DATA", "VL_FOB_EXP", "VL_FOB_IMP", "VL_SALDO_COMERCIAL"]
    assert df.count() > 0

"""Every registered query with a SQL twin, on the smallest given tables."""

import pytest
from compare import compare, duck

from shelfcast.plans import registry

SOURCE = "/root/testdata/sf0.001"
FNS, SQLS = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def twins():
    return duck(SOURCE)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_twin(spark, twins, name):
    assert compare(FNS[name](spark, SOURCE), twins, SQLS[name]) == []

"""Every registered query with an oracle matches DuckDB at sf0.01."""

import os

import pytest

from tests.oracle import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def _names():
    from tablewise.plans.registry import ORACLES, load_all
    load_all()
    return sorted(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_oracle(spark, con, name):
    from tablewise.plans.registry import ORACLES, QUERIES, rounded_sql
    errs = compare(QUERIES[name](spark, SF), con, rounded_sql(ORACLES[name]))
    assert not errs, errs

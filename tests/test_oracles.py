"""Every registered query against its DuckDB SQL on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from riskloom.schemas import MART_COLUMNS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys() and len(QUERIES) >= 41
    assert QUERIES.keys() <= contract.queries().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    n, problems = differences(spark, con, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems[:3]
    assert n > 0 or name in ("dq_unique",)


def test_entry(spark):
    out = contract.entry(spark)
    assert tuple(out.columns) == MART_COLUMNS and out.count() == 998

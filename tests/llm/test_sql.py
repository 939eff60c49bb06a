"""Queries that SQL can express against DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

from checks.compare import differences, duck
from riskloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


# rows of the queries that do not give one per document
ROWS = {"op12_automaton_search": 400, "op13_hard_negatives": 120}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    n, problems = differences(spark, duck(SF), QUERIES[name], ORACLES[name], SF)
    assert not problems and n == ROWS.get(name, 200)

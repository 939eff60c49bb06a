"""Daily states: how their work is dealt, and that the deal does not show."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from riskloom.operators import states
from riskloom.operators.heat import measure_heat, split_by_heat
from riskloom.operators.states import burst_states, combined_states, count_states, daily_states
from riskloom.params import HotKeyPolicy, RiskParams
from riskloom.plans.refresh import new_states
from riskloom.session import scratch
from tests.helpers import random_rows, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_into(text: str) -> set[str]:
    """Numbers of tasks that a plan deals rows into by its own choice."""
    return set(re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", text))


def lines(df) -> list[str]:
    return sorted(map(str, combined_states(df).collect()))


@pytest.fixture(scope="module")
def rows(spark):
    return table(spark, random_rows(5))


@pytest.mark.parametrize("hot", [None, 60, 1_000])
def test_rows_are_dealt_before_they_become_one_per_attribute(rows, monkeypatch, hot):
    """As many tasks as the rows need, each with few of them, and no sort of all values."""
    monkeypatch.setattr(states, "ROWS_PER_TASK", 20)
    heat = None if hot is None else measure_heat(rows, HotKeyPolicy(min_rows=hot))
    found = count_states(rows, heat=heat)
    text = plan(found)
    assert dealt_into(text) == {"15"} == dealt_into(text.split("Generate inline")[-1])
    # one exchange below the sums of ordinary customers' rows
    if hot == 1_000:
        assert text.count("Exchange") == 2
    monkeypatch.undo()
    assert lines(states.as_states(found)) == lines(states.as_states(count_states(rows)))


def test_bursts_are_dealt_by_the_number_of_rows(rows, monkeypatch):
    monkeypatch.setattr(states, "ROWS_PER_TASK", 20)
    split = split_by_heat(rows, measure_heat(rows))
    dealt = burst_states(split, n=300)
    assert dealt_into(plan(dealt)) == {"15"}
    assert sorted(map(str, dealt.collect())) == sorted(map(str, burst_states(split).collect()))


@pytest.mark.parametrize("hot", [60, 1_000])
def test_states_of_parts_merge_to_those_of_all(spark, rows, hot):
    """Whether everything has just arrived, or rows arrive beside others."""
    policy = HotKeyPolicy(min_rows=hot)
    late = F.col("transaction_id").substr(-1, 1).isin("3", "7")
    with scratch(spark) as keep:
        whole = new_states(rows, rows, RiskParams(), policy, keep)
        want = lines(daily_states(rows))
        assert lines(whole) == want
    with scratch(spark) as keep:
        first = new_states(rows.where(~late), rows.where(~late), RiskParams(), policy, keep)
        before = lines(first)
        assert before != want
        with scratch(spark) as again:
            assert lines(first.unionByName(new_states(rows.where(late), rows, RiskParams(), policy, again))) == want

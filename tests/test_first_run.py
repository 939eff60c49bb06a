"""The first scoring run tells its days from what it wrote."""

from __future__ import annotations

import datetime as dt

from riskloom.operators.profile import customer_baseline
from riskloom.plans.cycle import Store
from riskloom.plans.refresh import refresh_scores
from riskloom.session import work_folder, written
from riskloom.sources.tables import DailyTable
from tests.helpers import random_rows, table

RUN = dt.datetime(2024, 1, 25)


def test_scores_are_not_computed_again_for_their_days(spark, monkeypatch):
    txns = written(table(spark, random_rows(3, 60)), "txns")
    baseline = written(customer_baseline(txns, RUN.date(), RUN), "profiles")
    append, appended = DailyTable.append, []
    monkeypatch.setattr(DailyTable, "append", lambda self, rows: (append(self, rows), appended.append(rows))[0])
    select = type(txns).select

    def watched(self, *columns):
        assert not any(self is rows for rows in appended)
        return select(self, *columns)

    monkeypatch.setattr(type(txns), "select", watched)
    store = Store(spark, work_folder(spark, "first"))
    days = refresh_scores(txns, None, baseline, store.mart, RUN.date(), RUN)
    want = {r["transaction_date"] for r in txns.collect()}
    assert len(appended) == 1 and {r[0] for r in days.collect()} == want and None in want

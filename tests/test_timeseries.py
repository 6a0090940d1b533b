from __future__ import annotations

import pytest

from tendero.operators import timeseries as ts
from tests.conftest import day, one, records, ticket


def weeks(make):
    return make([ticket("1", "2025-01-06", amount=10.0), ticket("2", "2025-01-12", amount=5.0),
                 ticket("3", "2025-01-27", amount=30.0), ticket("4", "2025-02-03", amount=7.0)])


@pytest.mark.parametrize(("horizon", "last"), [("2025-02-03", "2025-01-27"), ("2025-02-09", "2025-02-03"), ("2025-02-08", "2025-01-27")])
def test_incomplete_last_week_is_dropped(make, horizon, last):
    got = records(ts.weekly_sales(weeks(make), horizon), "week_start")
    assert got[-1] == (day(last),)


def test_week_runs_monday_to_sunday_and_changes_skip_absent_weeks(make):
    got = records(ts.weekly_change(ts.weekly_sales(weeks(make), "2025-02-02")), "week_start", "wow_pct")
    assert got == [(day("2025-01-06"), None), (day("2025-01-27"), 1.0)]


def test_volatility_uses_the_sample_deviation(make):
    row = one(ts.format_volatility(ts.weekly_sales(weeks(make), "2025-02-02")))
    assert row["mean"] == 22.5 and round(row["std"], 6) == 10.606602 and round(row.cv, 6) == 0.471405


def test_extremes_leave_the_first_week_last(make):
    changes = ts.weekly_change(ts.weekly_sales(weeks(make), "2025-02-09"))
    got = records(ts.weekly_extremes(changes, 1), "tipo", "week_start")
    assert got == [("CAIDA", day("2025-02-03")), ("SUBIDA", day("2025-01-27"))]

from __future__ import annotations

import datetime as dt
import random
import re

from tendero.operators import kpis, series, stockgaps
from tests.conftest import day, line, ticket

START, END = "2025-01-20", "2025-02-20"


def shop(make, seed=1):
    rng = random.Random(seed)
    tickets, lines = [], []
    for k in range(160):
        date = dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(60))
        tickets.append(ticket(str(k), str(date), rng.choice(["S1", "S2", "S9"]), float(rng.randint(1, 50)), rng.choice(["COMPLETED"] * 5 + ["RETURNED"])))
        lines += [line(f"{k}-{n}", str(k), rng.choice(["I1", "I2", "I3"]), rng.randint(1, 4), rng.choice([0.333333, 1.0, 7.77])) for n in range(2)]
    return make(tickets, lines)


def days(first, last):
    return [day(first) + dt.timedelta(days=k) for k in range((day(last) - day(first)).days + 1)]


def test_each_day_is_the_figure_as_of_that_day(make):
    t = shop(make)
    daily = {(r.store_id, r.date): tuple(r)[2:] for r in series.kpi_availability_daily(t, START, END, active_days=9, idle_days=2).collect()}
    want = {}
    for date in days(START, END):
        for r in kpis.kpi_availability(t, str(date), active_days=9, idle_days=2).collect():
            want[(r.store_id, date)] = tuple(r)[1:]
    assert daily == want and len({store for store, _ in daily}) == 3


def test_daily_losses_add_up_to_the_gaps(make):
    t = shop(make)
    rows = series.kpi_stockout_daily(t, "2025-01-01", "2025-03-15").collect()
    gaps = stockgaps.stock_gaps(t, horizon="2025-03-15")
    assert sum(r.lost for r in rows) == stockgaps.gap_totals(gaps).first().ventas_estimadas_perdidas
    by_day: dict = {}
    for g in gaps.collect():
        for date in days(str(g.fecha_inicio_ausencia), str(g.fecha_fin_ausencia)):
            by_day[(g.store_id, date)] = by_day.get((g.store_id, date), 0.0) + g.venta_diaria_promedio_previa
    got = {(r.store_id, r.date): float(r.lost) for r in rows if r.lost}
    assert got.keys() == {k for k, v in by_day.items() if v > 1e-6}
    assert all(abs(got[k] - by_day[k]) < 1e-3 for k in got)
    net = {(r.store_id, r.date) for r in rows if r.net_sales is not None}
    assert net == {(r.store_id, r.transaction_date) for r in t["transactions"].collect()}


def test_a_period_inside_gives_the_same_days(make):
    t = shop(make)
    whole = {(r.store_id, r.date): r.lost for r in series.kpi_stockout_daily(t, "2025-01-01", "2025-03-15").collect()}
    part = {(r.store_id, r.date): r.lost for r in series.kpi_stockout_daily(t, START, END, horizon="2025-03-15").collect()}
    assert part == {k: v for k, v in whole.items() if day(START) <= k[1] <= day(END)}


def test_monthly_margin(make):
    t = make(
        [ticket("a", "2025-01-31"), ticket("b", "2025-02-01"), ticket("c", "2025-02-02", status="RETURNED")],
        [line("1", "a", "I1", 2, 10.0), line("2", "b", "I1", 1, 12.0), line("3", "c", "I1", 9, 99.0)],
    )
    rows = {str(r.month): r for r in series.kpi_margin_return_monthly(t).collect()}
    assert {m: (r.retorno_margen_bruto_sobre_costo, r.meets_target) for m, r in rows.items()} == {
        "2025-01-01": (1.5, False), "2025-02-01": (2.0, True)
    }


def test_weekly_health_of_whole_weeks_only(make):
    t = shop(make)
    rows = series.kpi_health_score_weekly(t, "2025-01-07", "2025-02-08").collect()
    assert {str(r.week_start) for r in rows} <= {"2025-01-13", "2025-01-20", "2025-01-27"}
    for r in rows:
        point = {p.store_id: p.availability for p in kpis.kpi_availability(t, str(r.week_start + dt.timedelta(days=6))).collect()}
        assert r.availability == point[r.store_id]


def test_no_item_meets_a_calendar(make):
    """One join of lines and tickets; days are only written out after the sums by store and day."""
    plan = series.kpi_availability_daily(shop(make), START, END)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Inner", plan)) == 1
    spread = [at for at, row in enumerate(plan.split("\n")) if "Generate explode(sequence" in row]
    summed = [at for at, row in enumerate(plan.split("\n")) if "Aggregate [store_id" in row and "sum(" in row]
    assert len(spread) == 1 and spread[0] < min(summed)

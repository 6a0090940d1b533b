from __future__ import annotations

import random

from pyspark.sql import functions as F

from tendero.operators import base, stockgaps
from tests.conftest import day, line, one, records, ticket

GAP = ("fecha_inicio_ausencia", "fecha_fin_ausencia", "dias_sin_venta", "venta_diaria_promedio_previa", "venta_estimada_perdida", "active_gap")


def two_sales(make, second, price=14.0):
    return make(
        [ticket("a", "2025-01-01"), ticket("b", second)], [line("1", "a", "I1", 1, price), line("2", "b", "I1", 1, price)]
    )


def test_inner_and_trailing_gap(make):
    t = two_sales(make, "2025-01-05")
    got = records(stockgaps.stock_gaps(t, horizon="2025-01-09"), *GAP)
    assert got == [
        (day("2025-01-02"), day("2025-01-04"), 3, 1.0, 3.0, False),
        (day("2025-01-06"), day("2025-01-09"), 4, 2.0, 8.0, True),
    ]


def test_two_silent_days_are_no_gap(make):
    assert stockgaps.stock_gaps(two_sales(make, "2025-01-04"), horizon="2025-01-04").count() == 0


def test_lookback_is_fourteen_days(make):
    t = two_sales(make, "2025-01-15")
    last = [r for r in records(stockgaps.stock_gaps(t, horizon="2025-01-18"), *GAP) if r[-1]]
    assert last[0][3] == 1.0  # Jan 1 is 15 days before the gap of Jan 16


def test_sales_after_the_horizon_do_not_count(make):
    t = two_sales(make, "2025-02-01")
    got = records(stockgaps.stock_gaps(t, horizon="2025-01-10"), *GAP)
    assert got == [(day("2025-01-02"), day("2025-01-10"), 9, 1.0, 9.0, True)]


def test_default_horizon_is_the_last_completed_sale(make):
    t = make(
        [ticket("a", "2025-01-01"), ticket("b", "2025-01-06", store="S2"), ticket("c", "2025-03-01", status="RETURNED")],
        [line("1", "a"), line("2", "b")],
    )
    assert records(stockgaps.stock_gaps(t), "store_id", "dias_sin_venta") == [("S1", 5)]


def random_sales(make, seed):
    rng = random.Random(seed)
    tickets, items = [], []
    for i in range(250):
        date = f"2025-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d}"
        status = "RETURNED" if rng.random() < 0.1 else "COMPLETED"
        tickets.append(ticket(f"t{i}", date, rng.choice(["S1", "S2", "S3"]), status=status))
        # One item takes a third of the lines.
        items += [line(f"{i}-{j}", f"t{i}", rng.choice(["I1", "I1", "I2", "I3"]), rng.randint(1, 4), rng.randint(1, 9) / 4)
                  for j in range(rng.randint(1, 3))]
    return make(tickets, items)


def test_calendar_form_agrees(make):
    t = random_sales(make, 7)
    for grain in (("store_id", "item_id"), ("store_id", "category"), ("item_id",)):
        for horizon in ("2025-03-31", None, "2025-02-10"):
            direct = stockgaps.stock_gaps(t, grain, horizon)
            calendar = stockgaps.stock_gaps_calendar(t, grain, horizon)
            assert direct.columns == calendar.columns
            assert records(direct) == records(calendar)


def test_brute_force(make):
    t = random_sales(make, 11)
    sold: dict[tuple, dict] = {}
    dates = {r.transaction_id: (r.store_id, r.transaction_date) for r in base.completed(t).collect()}
    for r in t["transaction_items"].collect():
        if r.transaction_id in dates:
            store, date = dates[r.transaction_id]
            days = sold.setdefault((store, r.item_id), {})
            days[date] = days.get(date, 0.0) + r.quantity * r.unit_price
    horizon, want = day("2025-03-31").toordinal(), set()
    for (store, item), days in sold.items():
        numbers = {d.toordinal(): v for d, v in days.items()}
        run = []
        for n in range(min(numbers), horizon + 2):
            if n <= horizon and n not in numbers:
                run.append(n)
                continue
            if len(run) >= 3:
                before = sum(numbers.get(run[0] - k, 0.0) for k in range(1, 15)) / 14
                want.add((store, item, run[0], run[-1], round(before * len(run), 6)))
            run = []
    got = {
        (r.store_id, r.item_id, r.fecha_inicio_ausencia.toordinal(), r.fecha_fin_ausencia.toordinal(), round(r.venta_estimada_perdida, 6))
        for r in stockgaps.stock_gaps(t, horizon="2025-03-31").collect()
    }
    assert got == want


def test_rollups(make):
    t = random_sales(make, 3)
    gaps = stockgaps.stock_gaps(t, horizon="2025-03-31").cache()
    totals = one(stockgaps.gap_totals(gaps))
    assert totals.ausencias == gaps.count() and totals.ausencias_activas == gaps.filter("active_gap").count()
    by_category = sum(r.ventas_estimadas_perdidas for r in stockgaps.lost_sales_by_category(gaps).collect())
    assert by_category == totals.ventas_estimadas_perdidas
    assert abs(float(by_category) - gaps.agg(F.sum("venta_estimada_perdida")).collect()[0][0]) < 1e-3
    assert {r.vendor_name for r in stockgaps.lost_sales_by_vendor(gaps).collect()} <= {"Proveedor 1", "SIN_VENDOR"}
    top = [r.venta_estimada_perdida for r in stockgaps.top_gaps(gaps, 5).collect()]
    assert top == sorted(top, reverse=True) and top[0] == gaps.agg(F.max("venta_estimada_perdida")).collect()[0][0]
    assert all(r.active_gap for r in stockgaps.top_gaps(gaps, 5, active_only=True).collect())


def test_spine_covers_first_sale_to_horizon(make):
    t = two_sales(make, "2025-01-05")
    spine = stockgaps.date_spine(stockgaps.daily_item_sales(t), base.as_date("2025-01-09"))
    assert spine.count() == 9
    assert stockgaps.date_spine(stockgaps.daily_item_sales(t), base.as_date("2024-12-01")).count() == 0

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tendero.functions import category_en
from tendero.operators import base, sales
from tests.conftest import day, one, records, ticket

COMP = ("2025-01-01", "2025-06-30")


def test_returned_tickets_subtract(make):
    t = make([ticket("a", "2025-01-01", amount=10.25), ticket("b", "2025-01-01", amount=3.1, status="RETURNED")])
    assert records(base.net_transactions(t), "transaction_id", F.col("ventas_netas").cast("double")) == [
        ("a", 10.25), ("b", -3.1),
    ]
    assert float(one(sales.net_sales_total(t)).ventas_netas) == 7.15


def test_comparable_sales_growth_and_rank(make):
    t = make(
        [
            ticket("1", "2024-02-01", "S1", 100.0), ticket("2", "2025-02-01", "S1", 150.0),
            ticket("3", "2024-02-01", "S2", 100.0), ticket("4", "2025-06-30", "S2", 110.0),
            ticket("5", "2024-09-01", "S1", 999.0),  # between the two periods
        ]
    )
    rows = records(sales.comp_sales_store(t, *COMP), "store_id", sales.GROWTH, sales.RANK)
    assert [(s, round(g, 6), r) for s, g, r in rows] == [("S1", 0.5, 1), ("S2", 0.1, 2)]


@pytest.mark.parametrize("zeroed", ["2024-02-01", "2025-02-01"])
def test_store_with_a_zero_period_is_dropped(make, zeroed):
    dates = ["2024-02-01", "2025-02-01"]
    rows = [ticket(d, d, "S1", 50.0) for d in dates] + [ticket("r" + zeroed, zeroed, "S1", 50.0, "RETURNED")]
    assert sales.comp_sales_store(make(rows), *COMP).count() == 0


def test_store_opened_after_the_earlier_period_is_not_comparable(make):
    t = make([ticket("1", "2024-06-10", "S3", 10.0), ticket("2", "2025-06-10", "S3", 20.0)])
    assert sales.comp_sales_store(t, *COMP).count() == 0


def test_leap_day_period_clamps(make):
    t = make([ticket("1", "2023-02-28", "S1", 10.0), ticket("2", "2024-02-29", "S1", 20.0)])
    stores = [("S1", "Uno", "CR", "x", "EXPRESS", 100, day("2020-01-01"), "Sur")]
    t = {**t, "stores": make(stores=stores)["stores"]}
    assert one(sales.comp_sales_store(t, "2024-02-01", "2024-02-29"))[sales.GROWTH] == 1.0


def test_rollups_add_up(make):
    t = make(
        [ticket(f"{s}{y}", f"{y}-03-01", s, a) for s, y, a in
         (("S1", 2024, 10.0), ("S1", 2025, 20.0), ("S2", 2024, 10.0), ("S2", 2025, 5.0))]
    )
    comparable = sales.comp_sales_store(t, *COMP)
    total = one(sales.comp_sales_by(comparable, "country"))
    assert (float(total.gmv_current), float(total.gmv_previous), total.stores, total.growth_pct) == (25.0, 20.0, 2, 0.25)
    levels = records(sales.comp_sales_levels(comparable), "level", "member", "growth_pct")
    assert levels == [("country", "CR", 0.25), ("format", "EXPRESS", 0.25), ("total", "ALL", 0.25)]
    extremes = records(sales.comp_sales_extremes(comparable, 1), "extremo", "store_id")
    assert extremes == [("MEJOR", "S1"), ("PEOR", "S2")]


def four_stores(make):
    stores = [(f"S{i}", f"T{i}", "CR", "x", "EXPRESS", 1, day("2020-01-01"), "Sur") for i in range(1, 5)]
    return make([ticket(f"t{i}", "2025-05-01", f"S{i}", float(i)) for i in range(1, 5)], stores=stores)


@pytest.mark.parametrize(("method", "p25", "flagged"), [("linear", 1.75, ["S1"]), ("lower", 1.0, [])])
def test_p25_rule(make, method, p25, flagged):
    out = sales.store_productivity(four_stores(make), "2025-04-01", "2025-06-30", method=method).cache()
    assert {r[sales.P25] for r in out.collect()} == {p25}
    low = out.filter(F.col("alerta_rendimiento") == "BAJO_RENDIMIENTO")
    assert [r[0] for r in records(low, "store_id")] == flagged


def test_lower_flags_are_a_subset_of_interpolated_flags(make):
    t = four_stores(make)
    low = {
        m: {r[0] for r in records(
            sales.store_productivity(t, "2025-04-01", "2025-06-30", method=m).filter("alerta_rendimiento <> 'OK'"), "store_id")}
        for m in ("linear", "lower")
    }
    assert low["lower"] <= low["linear"]


def test_default_quarter_is_the_one_of_the_last_ticket(make):
    t = make([ticket("1", "2025-03-31", amount=5.0), ticket("2", "2025-04-01", amount=7.0), ticket("3", "2025-05-02", amount=1.0)])
    assert float(one(sales.store_productivity(t)).ventas_netas) == 8.0


def test_zero_surface_gives_null_not_an_error(make):
    stores = [("S1", "Uno", "CR", "x", "EXPRESS", 0, day("2020-01-01"), "Sur")]
    out = one(sales.store_productivity(make([ticket("1", "2025-05-01")], stores=stores), "2025-04-01", "2025-06-30"))
    assert out[sales.PER_SQM] is None and out.alerta_rendimiento == "OK"


def test_unique_ids_agrees_when_ids_are_unique_and_exact_counts_copies_once(make):
    clean = make([ticket("1", "2025-05-01"), ticket("2", "2025-05-02")])
    assert records(sales.net_sales_by_format(clean)) == records(sales.net_sales_by_format(clean, unique_ids=True))
    copied = make([ticket("1", "2025-05-01"), ticket("1", "2025-05-01")])
    assert one(sales.net_sales_by_format(copied)).transacciones == 1


def test_positive_tickets_option(make):
    t = make([ticket("1", "2025-05-01", amount=10.0), ticket("2", "2025-05-01", amount=0.0)])
    assert one(sales.net_sales_by_format(t)).ticket_promedio == 5.0
    assert one(sales.net_sales_by_format(t, positive_tickets=True)).ticket_promedio == 10.0


def test_format_totals_equal_grand_total(make):
    t = make([ticket(str(i), "2025-05-01", s, 1.1 * i) for i, s in enumerate(("S1", "S2", "S3", "S1"))])
    by_format = sum(r.ventas_netas for r in sales.net_sales_by_format(t).collect())
    assert by_format == one(sales.net_sales_total(t)).ventas_netas


def test_store_day_selectors(make):
    t = make([ticket("1", "2025-05-01", "S1"), ticket("2", "2025-05-02", "S1"), ticket("3", "2025-05-02", "S3")])
    assert sales.store_day(t).count() == 3
    assert records(sales.store_day(t, country="GT"), "store_id") == [("S3",)]
    assert records(sales.store_day(t, store_id="S1", start="2025-05-02"), "date") == [(day("2025-05-02"),)]
    assert sales.store_day(t, format="EXPRESS", region="Norte").count() == 0


def test_top_and_returns(make):
    t = make([ticket("1", "2025-05-01", "S1", 5.0), ticket("2", "2025-05-01", "S2", 9.0),
              ticket("3", "2025-05-01", "S2", 2.0, "RETURNED")])
    assert records(sales.top_stores(t, 1), "store_id") == [("S2",)]
    returned = one(sales.returns_by_format(t))
    assert (returned.transacciones_devueltas, float(returned.monto_devuelto)) == (1, 2.0)
    assert records(sales.stores_by_format(t)) == [("DESCUENTO", 1), ("EXPRESS", 2)]


def test_counts_and_validation(make):
    t = make([ticket("1", "2025-05-01"), ticket("2", "2025-06-01")])
    assert dict(records(base.table_counts(t)))["transactions"] == 2
    validation = {r.tabla: r for r in base.load_validation(t).collect()}
    assert validation["transactions"].fecha_maxima == day("2025-06-01")
    assert validation["stores"].fecha_minima is None and validation["stores"].filas == 3


def test_category_names_in_english(spark):
    df = spark.createDataFrame([("Hogar",), ("Otra",), (None,)], "c string")
    assert records(df.select(category_en("c"))) == [(None,), ("Home",), ("Otra",)]

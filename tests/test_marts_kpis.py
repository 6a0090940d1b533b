from __future__ import annotations

from pyspark.sql import functions as F

from tendero.operators import kpis, marts
from tests.conftest import day, line, one, records, ticket


def promo(store, variant, start, end):
    return (store, "Prueba", variant, day(start), day(end), "EXHIBICION")


def star(make):
    return make(
        [ticket("a", "2025-01-02", "S1", 20.0, customer="C"), ticket("b", "2025-01-05", "S1", 8.0, "RETURNED"), ticket("c", "2025-01-02", "S2", 4.0)],
        [line("1", "a", "I1", 2, 10.0), line("2", "b", "I2", 2, 4.0), line("3", "c", "I3", 1, 4.0), line("4", "c", "XX", 1, 1.0)],
        promotions=[
            promo("S1", "CONTROL", "2025-01-01", "9999-12-31"), promo("S2", "CONTROL", "2025-01-01", "2025-01-03"),
            promo("S2", "TREATMENT", "2025-01-02", "2025-01-03"), promo("S3", "CONTROL", "2030-01-01", "2030-01-02"),
        ],
    )


def test_item_fact_keeps_its_grain_and_keys_resolve(make):
    t = star(make)
    fact = marts.fact_sales_item(t, "salt").cache()
    assert fact.count() == 4
    promos = {r.transaction_item_id: (r.promociones_vigentes, r.promotion_key) for r in fact.collect()}
    assert promos["1"][0] == 1 and promos["1"][1] is not None
    assert promos["3"] == (2, None)  # two variants on the same day: counted, not chosen
    joined = fact.join(marts.dim_promotion(t), "promotion_key").join(marts.dim_store(t), "store_key")
    assert {r.store_id for r in joined.collect()} == {"S1"}
    by_id = {r.transaction_item_id: r for r in fact.collect()}
    assert float(by_id["1"].margen_bruto) == 12.0 and float(by_id["2"].margen_bruto) == -6.0
    assert by_id["4"].costo_unitario is None
    assert by_id["2"].customer_key == marts.ANONYMOUS_KEY
    customer = marts.dim_customer(t, "salt").filter(f"customer_key = '{by_id['1'].customer_key}'")
    assert one(customer).mes_primera_compra == day("2025-01-01")


def test_customer_ids_do_not_leak_and_salt_matters(make):
    t = star(make)
    a, b = ({r.customer_hash for r in marts.dim_customer(t, s).collect()} for s in ("x", "y"))
    assert "C" not in a and a & b == {None}
    assert "customer_id" not in marts.dim_customer(t, "x").columns


def test_store_day_fact(make):
    rows = {r.date_key: r for r in marts.fact_store_day(star(make)).filter(F.col("transacciones") == 1).collect()}
    assert float(rows["20250105"].monto_devoluciones) == 8.0 and float(rows["20250105"].ventas_netas) == -8.0


def test_dim_date(make):
    rows = {r.date_key: r for r in marts.dim_date(star(make), "2024-12-29", "2025-01-02").collect()}
    assert len(rows) == 5
    assert rows["20241229"].inicio_semana == day("2024-12-23") and rows["20241230"].semana_fiscal == 1
    assert (rows["20250101"].trimestre, rows["20250101"].anio) == (1, 2025)


def test_dimensions(make):
    t = star(make)
    vendor_keys = {r.vendor_key for r in marts.dim_vendor(t).collect()}
    products = {r.item_id: r.vendor_key for r in marts.dim_product(t).collect()}
    assert products["I1"] in vendor_keys and products["I2"] not in vendor_keys and products["I3"] is None
    assert marts.fact_transaction(t, "s").count() == 3
    assert records(marts.fact_cohort_month(t), "cohort_month_key", "mes_relativo") == [("202501", 0)]
    assert marts.fact_stock_gap(t, "2025-01-09").count() == 2


def test_weekly_kpis(make):
    t = make([ticket("a", "2025-01-06", "S1", 100.0), ticket("b", "2025-01-06", "S2", 100.0, customer="C")])
    rows = {r.store_id: r for r in kpis.kpi_sales_per_sqm(t).collect()}
    assert (rows["S1"].value, rows["S2"].value, rows["S1"].p50_format) == (1.0, 0.5, 0.75)
    assert rows["S1"].meets_target and not rows["S2"].meets_target
    assert {r.store_id for r in kpis.kpi_tx_per_sqm(t).filter("meets_target").collect()} == {"S1"}
    assert one(kpis.kpi_loyalty_conversion(t)).conversion == 0.5


def test_avg_ticket_year_on_year(make):
    t = make([ticket("a", "2023-02-28", amount=10.0), ticket("b", "2024-02-28", amount=10.4), ticket("c", "2024-02-29", amount=10.1)])
    rows = {r.date: r for r in kpis.kpi_avg_ticket(t).collect()}
    assert rows[day("2024-02-28")].meets_target and not rows[day("2024-02-29")].meets_target
    assert rows[day("2024-02-29")].previous_ticket == 10.0 and rows[day("2023-02-28")].growth is None


def test_stockout_and_availability(make):
    t = make(
        [ticket("a", "2025-01-01", amount=100.0), ticket("b", "2025-01-10", amount=100.0), ticket("o", "2024-01-01", amount=1.0)],
        [line("1", "a", "I1", 1, 14.0), line("2", "b", "I2", 1, 1.0), line("3", "o", "I3", 1, 1.0)],
    )
    row = one(kpis.kpi_availability(t, "2025-01-10"))
    assert (row.active_items, row.idle_items, row.availability) == (2, 1, 0.5)
    lost = one(kpis.kpi_stockout_index(t, "2025-01-10"))
    assert lost.stockout_index > 0.02 and not lost.meets_target


def test_health_score_scales_within_format(make):
    tickets = [ticket(f"{s}{i}", "2025-01-10", s, a) for s, a, n in (("S1", 100.0, 4), ("S2", 10.0, 1)) for i in range(n)]
    items = [line("1", "S10", "I1"), line("2", "S20", "I1")]
    old = [ticket("old", "2025-01-01", "S2", 1.0)]
    t = make(tickets + old, items + [line("3", "old", "I2")])
    rows = {r.store_id: r for r in kpis.kpi_health_score(t, "2025-01-01", "2025-01-10").collect()}
    assert round(rows["S1"].health_score, 9) == 100.0 and rows["S2"].health_score == 0.0
    alone = make([ticket("x", "2025-01-10", "S3", 5.0)], [line("1", "x")])
    assert one(kpis.kpi_health_score(alone, "2025-01-01", "2025-01-10")).health_score is None

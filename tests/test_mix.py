from __future__ import annotations

from pyspark.sql import functions as F

from tendero.operators import base, mix, sales
from tests.conftest import line, one, records, ticket


def basket(make):
    return make(
        [ticket("a", "2025-05-01", "S1", 20.0), ticket("b", "2025-05-03", "S3", 9.0), ticket("r", "2025-05-03", "S1", 4.0, "RETURNED")],
        [
            line("1", "a", "I1", 2, 8.0), line("2", "a", "I2", 4, 1.0),
            line("3", "b", "I3", 3, 3.0), line("4", "r", "I2", 1, 4.0),
        ],
    )


def test_item_sales_and_enriched(make):
    t = basket(make)
    amounts = records(base.item_sales(t), "transaction_item_id", F.col("ventas_brutas_item").cast("double"), F.col("costo_item").cast("double"))
    assert amounts[0] == ("1", 16.0, 8.0)
    wide = base.sales_enriched(t)
    assert {"store_country", "vendor_country"} <= set(wide.columns)
    assert float(wide.filter("transaction_item_id = '4'").collect()[0].net_line_gmv) == -4.0


def test_vendor_margin(make):
    rows = {(r.vendor_name, r.category, r.vendor_id): r for r in mix.vendor_margin_return(basket(make)).collect()}
    tv = rows["Proveedor 1", "Electrónica", "V1"]
    assert (float(tv.margen_bruto), tv.retorno_margen_bruto_sobre_costo, tv.alerta_retorno_margen) == (8.0, 1.0, "OK")
    milk = rows["SIN_VENDOR", "Alimentos", None]
    assert milk.alerta_retorno_margen == "RETORNO_MARGEN_BAJO_1" and milk.velocidad_unidades_por_dia == 3.0
    assert ("SIN_VENDOR", "Alimentos", "V9") in rows


def test_units_per_day_spans_first_to_last_sale(make):
    t = make([ticket("a", "2025-05-01"), ticket("b", "2025-05-04")], [line("1", "a", "I1", 2), line("2", "b", "I1", 6)])
    assert one(mix.vendor_margin_return(t)).velocidad_unidades_por_dia == 2.0


def test_zero_cost_gives_null_return(make):
    products = [("I1", "x", "M", "V1", "c", "d", 0.0)]
    t = make([ticket("a", "2025-05-01")], [line("1", "a")], products=products)
    row = one(mix.vendor_margin_return(t))
    assert row.retorno_margen_bruto_sobre_costo is None and row.alerta_retorno_margen == "OK"


def test_unknown_items_option(make):
    t = make([ticket("a", "2025-05-01")], [line("1", "a", "I1"), line("2", "a", "XX")])
    assert mix.vendor_margin_return(t).count() == 1
    assert mix.vendor_margin_return(t, keep_unknown_items=True).count() == 2


def test_pareto_shares(make):
    out = mix.pareto(basket(make)).cache()
    express = records(out.filter("format = 'EXPRESS'"), "category", F.col("net_line_gmv").cast("double"), "cum_share")
    assert express == [("Alimentos", 0.0, 1.0), ("Electrónica", 16.0, 1.0)]
    ends = out.groupBy("format").agg(F.max("cum_share"))
    assert {r[1] for r in ends.collect()} == {1.0}
    assert records(mix.pareto_top_by_format(out, 1), "format", "category") == [
        ("DESCUENTO", "Alimentos"), ("EXPRESS", "Electrónica"),
    ]
    assert records(mix.category_share(basket(make), "Electrónica"), "share") == [(16 / 25,)]


def test_category_sales_ignores_returns(make):
    got = records(sales.category_sales(basket(make)), "category", F.col("ventas_brutas").cast("double"), "unidades")
    assert got == [("Alimentos", 13.0, 7), ("Electrónica", 16.0, 2)]


def test_promo_sides_and_reading(make):
    t = make(
        [ticket("a", "2025-05-01", amount=30.0), ticket("b", "2025-05-01", amount=10.0), ticket("c", "2025-05-01", amount=5.0)],
        [
            line("1", "a", "I1", 3, 10.0, True), line("2", "b", "I1", 1, 10.0),
            line("3", "c", "I2", 1, 5.0),
        ],
    )
    rows = {r.category: r for r in mix.promo_impact(t).collect()}
    tv = rows["Electrónica"]
    assert (tv.transacciones_con_promocion, tv.diferencia_unidades_promedio, tv.diferencia_ticket_promedio) == (1, 2.0, 20.0)
    assert tv.lectura_promocion == "UPLIFT_REAL"
    bread = rows["Alimentos"]
    assert bread.diferencia_unidades_promedio is None and bread.lectura_promocion == "SIN_UPLIFT_CLARO"
    assert [r[0] for r in records(mix.promo_impact_ranked(mix.promo_impact(t)), "category", sort=False)] == ["Electrónica", "Alimentos"]


def test_more_units_with_a_lower_ticket(make):
    t = make(
        [ticket("a", "2025-05-01", amount=5.0), ticket("b", "2025-05-01", amount=10.0)],
        [line("1", "a", "I1", 3, 1.0, True), line("2", "b", "I1", 1, 10.0)],
    )
    assert one(mix.promo_impact(t)).lectura_promocion == "MAS_UNIDADES_CON_MENOR_TICKET"


def test_one_promo_line_marks_the_whole_ticket_category(make):
    t = make([ticket("a", "2025-05-01")], [line("1", "a", "I2", 1, 1.0, True), line("2", "a", "I3", 1, 1.0, False)])
    row = one(mix.promo_impact_long(t))
    assert (row.promo_tx, row.transactions, row.avg_units) == (True, 1, 2.0)


def test_recommendation_labels(make):
    t = make(
        [ticket("a", "2025-05-01"), ticket("b", "2025-05-10")],
        [line("1", "a", "I1", 1, 90.0), line("2", "b", "I2", 1, 10.0)],
    )
    got = {r.category: r for r in mix.category_recommendation(t, "2025-05-10").collect()}
    assert got["Electrónica"].recomendacion == "PRIORIDAD_ALTA"
    assert (got["Alimentos"].recomendacion, got["Alimentos"].participacion_ventas) == ("MONITOREO", 0.1)
    later = {r.category: r.recomendacion for r in mix.category_recommendation(t, "2025-05-13").collect()}
    assert later["Alimentos"] == "PRIORIDAD_MEDIA"


def test_a_ticket_with_most_lines_is_whole(make):
    """One ticket holds a third of the lines; results equal plain arithmetic."""
    n = 3000
    items = [line(f"h{i}", "hot", "I1", 1, 1.0, i == 0) for i in range(n // 3)]
    items += [line(f"c{i}", f"t{i % 500}", "I2", 1, 2.0) for i in range(n - n // 3)]
    tickets = [ticket("hot", "2025-05-01", amount=1000.0)] + [ticket(f"t{i}", "2025-05-02", amount=8.0) for i in range(500)]
    t = make(tickets, items)
    sides = {(r.category, r.promo_tx): r for r in mix.promo_impact_long(t).collect()}
    assert sides["Electrónica", True].avg_units == 1000.0
    assert sides["Alimentos", False].avg_units == 4.0
    margins = {r.category: r for r in mix.vendor_margin_return(t).collect()}
    assert float(margins["Electrónica"].ventas_brutas_items) == 1000.0

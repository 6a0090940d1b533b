from __future__ import annotations

from tendero.operators import quality as q
from tests.conftest import day, line, one, records, ticket


def dirty(make):
    return make(
        [
            ticket("a", "2025-01-01", "S1", 10.0), ticket("a", "2025-01-01", "S1", 10.0),
            ticket("b", "2025-01-04", "S1", 0.0, customer="C", card=False), ticket("c", "2025-01-09", "S9", 5.0, card=True),
            ticket("d", "2024-05-01", "S3", 5.0, customer="D"), ticket("e", "2025-01-10", "S2", -4.0),
        ],
        [line("1", "b", "I1", 1, 0.0), line("2", "b", "I1", 1, 0.0, True), line("3", "c", "XX", 2, 3.0), line("4", "d", "I1", 1, 5.005)],
        promotions=[("S1", "P", "CONTROL", day("2025-01-01"), day("2025-01-02"), "E"), ("S1", "P", "TREATMENT", day("2025-01-01"), day("2025-01-02"), "E")],
    )


def test_checks(make):
    t = dirty(make)
    assert tuple(one(q.dq_null_customer(t)))[:2] == (4, 6)
    assert tuple(one(q.dq_loyalty_consistency(t))) == (1, 1)
    assert sum(r.transacciones for r in q.dq_loyalty_matrix(t).collect()) == 6
    assert one(q.dq_duplicate_keys(t["transactions"], ("transaction_id",))).duplicados == 1
    assert one(q.dq_nonpositive_total(t)).transacciones_no_positivas == 2
    assert one(q.dq_zero_price_no_promo(t)).items_precio_cero == 1
    assert one(q.dq_orphan_store(t)).huerfanos == 1
    assert one(q.dq_orphan_item(t)).huerfanos == 1
    assert one(q.dq_orphan_vendor_count(t)).productos_con_vendor_inexistente == 2
    assert records(q.dq_orphan_vendor_list(t), "item_id", "vendor_id") == [("I2", "V9"), ("I3", None)]
    early = one(q.dq_before_opening(t))
    assert (early.transacciones, early.fecha_minima) == (1, day("2024-05-01"))
    assert records(q.dq_multi_variant_stores(t), "store_id", "variantes_detectadas") == [("S1", "CONTROL, TREATMENT")]
    assert one(q.dq_profile(t)).transaction_items == 4
    assert records(q.dq_hot_tickets(t, 2)) == [("b", 2)]


def test_mismatch_tolerance_and_tickets_without_lines(make):
    row = one(q.dq_amount_mismatch(dirty(make)))
    # b matches, d differs by 0.005 (inside the tolerance), c is short by one; a and e have no lines.
    assert (row.transacciones_con_diferencia, float(row.diferencia_maxima), row.proporcion_negativa) == (1, 1.0, 1.0)


def test_no_mismatch(make):
    t = make([ticket("a", "2025-01-01", amount=10.0)], [line("1", "a", "I1", 1, 10.0)])
    row = one(q.dq_amount_mismatch(t))
    assert row.transacciones_con_diferencia == 0 and row.diferencia_maxima is None and row.proporcion_negativa is None


def test_missing_days(make):
    t = make([ticket("1", "2025-01-01", "S1"), ticket("2", "2025-01-10", "S1"),
              ticket("3", "2025-01-03", "S2"), ticket("4", "2025-01-05", "S2", status="RETURNED"), ticket("5", "2025-01-06", "S2")])
    got = records(q.dq_store_missing_days(t))
    assert got == [
        ("S1", 8, 1, day("2025-01-02"), day("2025-01-09"), 8),
        ("S2", 7, 3, day("2025-01-07"), day("2025-01-10"), 4),
    ]


def test_equal_runs_keep_the_first_and_full_stores_are_absent(make):
    t = make([ticket("1", "2025-01-02", "S1"), ticket("2", "2025-01-04", "S1")]
             + [ticket(f"f{i}", f"2025-01-0{i}", "S2") for i in range(1, 6)])
    assert records(q.dq_store_missing_days(t)) == [("S1", 3, 3, day("2025-01-01"), day("2025-01-01"), 1)]


def test_findings_table(make):
    t = dirty(make)
    rows = {r.check: r for r in q.dq_findings(t).collect()}
    assert len(rows) == 13
    assert (rows["transaction_id_duplicado"].failed, rows["transaction_id_duplicado"].total) == (1, 6)
    assert rows["total_distinto_de_items"].detail == "1.00"
    assert rows["producto_sin_vendor"].pct == 2 / 3 * 100
    assert rows["venta_antes_de_apertura"].detail == "2024-05-01..2024-05-01"


def test_kpi_rules(make):
    t = dirty(make)
    rules = {r.rule: (r.failed, r.total) for r in q.dq_kpi_rules(t, "2025-01-10").collect()}
    assert rules["venta_negativa_sin_devolucion"] == (1, 6)
    assert rules["vendor_inexistente"] == (2, 3)
    assert rules["item_sin_historia"] == (2, 3)
    assert rules["mes_relativo_negativo"][0] == 0


def test_purchases_before_the_stored_first_month(make, spark):
    t = make([ticket("1", "2025-01-05", customer="C1"), ticket("2", "2025-02-05", customer="C1"), ticket("3", "2025-02-05", customer="C2")])
    stored = spark.createDataFrame([("C1", day("2025-02-01")), ("C2", day("2025-02-01"))], "customer_id string, mes_primera_compra date")
    rules = {r.rule: (r.failed, r.total) for r in q.dq_kpi_rules(t, "2025-02-10", first_months=stored).collect()}
    assert rules["mes_relativo_negativo"] == (1, 3)


def test_weekly_drop_needs_history(make):
    tickets = [ticket(f"{w}-{i}", f"2025-01-{6 + 7 * w:02d}") for w, n in enumerate((10, 10, 6, 8)) for i in range(n)]
    got = records(q.weekly_ticket_drops(make(tickets)), "week_start", "tx", "caida")
    assert [(r[1], r[2]) for r in got] == [(10, False), (10, False), (6, True), (8, False)]

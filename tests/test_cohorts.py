from __future__ import annotations

import pytest

from tendero.operators import cohorts
from tests.conftest import day, one, records, ticket


def shoppers(make):
    return make(
        [
            ticket("1", "2024-01-05", customer="A", amount=10.0), ticket("2", "2024-01-20", customer="A", amount=20.0),
            ticket("3", "2024-02-01", customer="A", amount=40.0), ticket("4", "2024-07-09", customer="A", amount=50.0),
            ticket("5", "2024-01-31", customer="B", amount=30.0),
            ticket("6", "2024-02-10", customer="C", amount=5.0),
            ticket("7", "2023-12-01", customer="B", amount=9.0, status="RETURNED"),
            ticket("8", "2023-11-01", amount=9.0),
            ticket("9", "2023-11-01", customer="A", card=False),
        ]
    )


def test_activity(make):
    got = records(
        cohorts.cohort_activity(shoppers(make)), "mes_cohorte", "mes_relativo", "clientes_activos", "clientes_cohorte",
        "ticket_promedio", "tasa_retencion",
    )
    jan, feb = day("2024-01-01"), day("2024-02-01")
    assert got == [(jan, 0, 2, 2, 20.0, 1.0), (jan, 1, 1, 2, 40.0, 0.5), (jan, 6, 1, 2, 50.0, 0.5), (feb, 0, 1, 1, 5.0, 1.0)]


def test_retention_pivot_and_trend(make):
    rows = {r.mes_cohorte: r for r in cohorts.cohort_retention(shoppers(make)).collect()}
    jan = rows[day("2024-01-01")]
    assert (jan.retencion_mes_0, jan.retencion_mes_1, jan.retencion_mes_2) == (1.0, 0.5, None)
    assert jan.tendencia_ticket_mes_0_a_mes_6 == "CRECE"
    assert rows[day("2024-02-01")].tendencia_ticket_mes_0_a_mes_6 == "SIN_DATOS"


@pytest.mark.parametrize(("later", "label"), [(10.0, "SIN_DATOS"), (9.0, "DECRECE"), (11.0, "CRECE")])
def test_trend_label(make, later, label):
    t = make([ticket("1", "2024-01-05", customer="A", amount=10.0), ticket("2", "2024-07-05", customer="A", amount=later)])
    assert one(cohorts.cohort_retention(t)).tendencia_ticket_mes_0_a_mes_6 == label


def test_month_zero_is_always_full(make):
    zero = cohorts.cohort_activity(shoppers(make)).filter("mes_relativo = 0")
    assert {r.tasa_retencion for r in zero.collect()} == {1.0}


def test_group_compare_is_an_unweighted_mean(make):
    t = make(
        [ticket("1", "2024-01-05", customer="A"), ticket("2", "2024-02-05", customer="A"),
         ticket("3", "2024-03-05", customer="B"), ticket("4", "2024-03-05", customer="C"), ticket("5", "2024-04-05", customer="C")]
    )
    row = one(cohorts.cohort_group_compare(t, "2024-01-01", "2024-02-01", "2024-04-01"))
    assert tuple(row) == (1.0, 0.5)


def test_first_month(make):
    assert records(cohorts.customer_first_month(shoppers(make))) == [
        ("A", day("2024-01-01")), ("B", day("2024-01-01")), ("C", day("2024-02-01")),
    ]

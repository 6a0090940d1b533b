from __future__ import annotations

import math

import numpy as np
import pytest

from tendero.functions.student_t import critical_value, two_sided_p
from tendero.operators import experiments as ex
from tests.conftest import day, one, records, ticket


def promo(store, variant, start="2024-09-01", end="2024-10-12"):
    return (store, "Prueba", variant, day(start), day(end), "EXHIBICION")


# Textbook two-sided 5 % and 1 % points.
@pytest.mark.parametrize(
    ("df", "alpha", "value"),
    [(1, 0.05, 12.7062), (2, 0.05, 4.3027), (5, 0.05, 2.5706), (10, 0.05, 2.2281), (30, 0.05, 2.0423),
     (120, 0.05, 1.9799), (10, 0.01, 3.1693), (1e6, 0.05, 1.95996)],
)
def test_t_table(df, alpha, value):
    got = critical_value(np.array([float(df)]), np.array([alpha]))[0]
    assert abs(got - value) < 6e-5
    assert abs(two_sided_p(np.array([got]), np.array([float(df)]))[0] - alpha) < 1e-9


def test_t_tail_against_closed_forms():
    t = np.array([0.0, 0.3, 1.0, 2.5, 8.0, 50.0])
    one_df = 1 - 2 / math.pi * np.arctan(t)
    assert np.allclose(two_sided_p(t, np.ones_like(t)), one_df, rtol=1e-9)
    two_df = 1 - t / np.sqrt(2 + t * t)
    assert np.allclose(two_sided_p(t, np.full_like(t, 2.0)), two_df, rtol=1e-8, atol=1e-14)


def test_welch_by_hand(spark):
    rows = [("CONTROL", float(i)) for i in range(1, 6)] + [("TREATMENT", float(2 * i)) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "variant string, x double")
    row = one(ex.welch_test(df, ("x",)))
    assert (row.n_control, row.n_treatment, row.control_mean, row.treatment_mean, row.diff) == (5, 5, 3.0, 6.0, 3.0)
    assert round(row.t, 4) == 1.8974 and round(row.df, 4) == 5.8824 and row.lift_pct == 100.0
    assert abs(row.p_value - 0.1075) < 5e-4
    assert row.ci_low < 0 < row.ci_high and abs((row.ci_low + row.ci_high) / 2 - 3.0) < 1e-9


def test_degenerate_groups_give_nulls(spark):
    df = spark.createDataFrame([("CONTROL", 1.0), ("TREATMENT", 2.0), ("TREATMENT", 2.0)], "variant string, x double")
    row = one(ex.welch_test(df, ("x",)))
    assert row.t is None and row.p_value is None and row.ci_low is None and row["diff"] == 1.0


def test_segments_match_separate_tests(spark):
    rows = [(v, s, float(i * k + j)) for i, v in ((1, "CONTROL"), (2, "TREATMENT")) for j in range(6) for k, s in ((1, "a"), (3, "b"))]
    df = spark.createDataFrame(rows, "variant string, seg string, x double")
    together = {r.seg: r for r in ex.welch_test(df, ("x",), segments=("seg",)).collect()}
    for seg in ("a", "b"):
        alone = one(ex.welch_test(df.filter(f"seg = '{seg}'"), ("x",)))
        assert abs(alone.t - together[seg].t) < 1e-12 and abs(alone.p_value - together[seg].p_value) < 1e-12


def test_dual_variant_stores_leave_the_trial(make):
    t = make(promotions=[promo("S1", "CONTROL"), promo("S1", "TREATMENT"), promo("S2", "CONTROL"), promo("S2", "CONTROL"), promo("S3", "TREATMENT")])
    assert records(ex.ab_clean_assignment(t)) == [("S2", "CONTROL"), ("S3", "TREATMENT")]
    assert records(ex.multi_variant_stores(t)) == [("S1", 2, "CONTROL, TREATMENT")]
    assert records(ex.ab_format_counts(t, ("EXPRESS", "DESCUENTO"))) == [("CONTROL", 1, 0), ("TREATMENT", 0, 1)]
    assert records(ex.ab_size_summary(t), "variant", "count", "mean", "median", "min", "max") == [
        ("CONTROL", 1, 200.0, 200.0, 200, 200), ("TREATMENT", 1, 50.0, 50.0, 50, 50),
    ]


def test_period_metrics_and_wide(make):
    t = make(
        [
            ticket("a", "2024-08-31", "S2", 60.0), ticket("b", "2024-07-21", "S2", 60.0), ticket("c", "2024-07-20", "S2", 999.0),
            ticket("d", "2024-09-01", "S2", 60.0), ticket("e", "2024-10-12", "S2", 180.0), ticket("f", "2024-10-13", "S2", 999.0),
            ticket("g", "2024-09-05", "S2", 999.0, "RETURNED"), ticket("h", "2024-09-05", "S3", 6.0),
        ],
        promotions=[promo("S2", "CONTROL"), promo("S3", "TREATMENT")],
    )
    wide = one(ex.ab_wide(t, "2024-09-01", "2024-10-12"))
    assert (wide.store_id, wide.pre_weekly_gmv, wide.test_weekly_gmv, wide.gmv_change) == ("S2", 20.0, 40.0, 20.0)
    assert (wide.pre_ticket, wide.test_ticket) == (60.0, 120.0)
    summary = {r.variant: r for r in ex.ab_summary(ex.ab_period_metrics(t, "2024-09-01", "2024-10-12"), "test").collect()}
    assert summary["TREATMENT"].avg_weekly_gmv == 1.0 and summary["CONTROL"].n == 1


def test_did_is_welch_on_changes(make):
    rng = np.random.default_rng(5)
    stores = [(f"S{i}", f"T{i}", "CR", "x", "EXPRESS", 10, day("2020-01-01"), "Sur") for i in range(8)]
    promos = [promo(f"S{i}", "CONTROL" if i < 4 else "TREATMENT") for i in range(8)]
    tickets = [ticket(f"{i}{d}", d, f"S{i}", float(rng.integers(10, 90))) for i in range(8) for d in ("2024-08-01", "2024-09-10")]
    t = make(tickets, stores=stores, promotions=promos)
    row = [r for r in ex.ab_did(t, "2024-09-01", "2024-10-12").collect() if r.metric == "gmv_change"][0]
    wide = ex.ab_wide(t, "2024-09-01", "2024-10-12").toPandas()
    c, r = (wide[wide.variant == v].gmv_change for v in ("CONTROL", "TREATMENT"))
    se = math.sqrt(c.var(ddof=1) / 4 + r.var(ddof=1) / 4)
    assert abs(row.t - (r.mean() - c.mean()) / se) < 1e-9

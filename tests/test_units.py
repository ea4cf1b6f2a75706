"""Hand-written fixtures with expected values computed by hand (FIXTURES.md section 3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.operators import drift, lines, marts, planning, pnl, purchasing, pvm, receivables, variance
from tests.conftest import rows

D = dt.date


def sales(spark, data, cols="sku string, order_date date, ch string, qty double, revenue double, cost double"):
    return spark.createDataFrame(data, cols)


def products(spark):
    return spark.createDataFrame([("a", "Shoes", "PE", 5.0), ("b", "Bags", "AH", 9.0)],
                                 "sku string, cat string, collection string, unit_cost double")


def test_margin_guard_zero_revenue(spark):
    f = sales(spark, [("a", D(2025, 1, 3), "Web", 1.0, 0.0, 5.0)])
    m = marts.sales_mart(f, products(spark))
    assert rows(m, "margin", "margin_pc") == [(-5.0, None)]


def test_orphan_sku_kept_with_null_category(spark):
    f = sales(spark, [("zzz", D(2025, 1, 3), "Web", 1.0, 10.0, 4.0),
                      ("a", D(2025, 1, 4), "Web", 1.0, 20.0, 5.0)])
    m = marts.sales_mart(f, products(spark))
    assert m.count() == 2
    cube = marts.monthly_cube(m)
    got = {c: float(v) for c, v in rows(cube, "cat", "revenue")}
    assert got == {"Shoes": 20.0, None: 10.0}
    budget = spark.createDataFrame([(1, "Web", "Shoes", 15.0, 5.0)],
                                   "mo int, ch string, cat string, budget_revenue double, budget_margin double")
    v = variance.budget_variance(m, budget, 2025)
    got = {r[0]: r[1] for r in rows(v, "cat", "budget_revenue")}
    assert got == {"Shoes": 15.0, None: None}


def test_share_of_month_total(spark):
    f = sales(spark, [("a", D(2025, 1, 3), "Web", 1.0, 60.0, 1.0),
                      ("b", D(2025, 1, 5), "Shop", 1.0, 40.0, 1.0)])
    cube = marts.monthly_cube(marts.sales_mart(f, products(spark)))
    got = sorted(rows(pnl.pnl_mix_share(cube), "ch", "mix_share_pc"))
    assert got == [("Shop", 40.0), ("Web", 60.0)]


@pytest.mark.parametrize("actual,expected", [
    (89.0, K.STATUS_LABELS["strong_under"]), (90.0, K.STATUS_LABELS["under"]),
    (94.0, K.STATUS_LABELS["under"]), (95.0, K.STATUS_LABELS["on_track"]),
    (105.0, K.STATUS_LABELS["on_track"]), (106.0, K.STATUS_LABELS["over"]),
])
def test_budget_status_bounds(spark, actual, expected):
    df = spark.createDataFrame([(actual, 100.0)], "a double, b double")
    got = rows(df.select(variance.status((F.col("a") - F.col("b")) / F.col("b"))))
    assert got == [(expected,)]


def test_budget_status_without_budget_is_else_branch(spark):
    df = spark.createDataFrame([(50.0, None)], "a double, b double")
    got = rows(df.select(variance.status((F.col("a") - F.col("b")) / F.col("b"))))
    assert got == [(K.STATUS_LABELS["on_track"],)]


def test_budget_cell_without_actual_is_absent(spark):
    f = sales(spark, [("a", D(2025, 1, 3), "Web", 1.0, 60.0, 1.0)])
    m = marts.sales_mart(f, products(spark))
    budget = spark.createDataFrame(
        [(1, "Web", "Shoes", 50.0, 10.0), (2, "Web", "Shoes", 70.0, 10.0)],
        "mo int, ch string, cat string, budget_revenue double, budget_margin double")
    v = variance.budget_variance(m, budget, 2025)
    assert rows(v, "mo", "budget_revenue", "actual_revenue", "var_revenue") == [(1, 50.0, 60.0, 10.0)]
    full = variance.actual_vs_budget(m, budget, 2025, how="full")
    assert full.count() == 2


def _pvm_mart(spark, lines_):
    data = [(sku, D(y, 3, 1), "Web", q, q * p, 0.0) for sku, y, q, p in lines_]
    prods = spark.createDataFrame([("a", "Cat", "PE", 0.0), ("b", "Cat", "PE", 0.0),
                                   ("c", "Solo", "PE", 0.0)],
                                  "sku string, cat string, collection string, unit_cost double")
    return marts.sales_mart(sales(spark, data), prods)


def test_pvm_category_grain(spark):
    m = _pvm_mart(spark, [("a", 2024, 100.0, 10.0), ("a", 2025, 80.0, 13.0)])
    got = rows(pvm.pvm_effects(m, 2025), "cat", "total_var", "volume", "price", "mix")
    assert got == [("Cat", 40.0, -200.0, 240.0, 0.0)]
    assert str(rows(pvm.pvm_effects(m, 2025), "mix")[0][0]) == "0.0"  # not -0.0


def test_pvm_sku_grain_mix(spark):
    m = _pvm_mart(spark, [("a", 2024, 10.0, 10.0), ("a", 2025, 12.0, 10.0),
                          ("b", 2024, 10.0, 20.0), ("b", 2025, 6.0, 22.0)])
    got = rows(pvm.pvm_mix_by_sku(m, 2025), "total_var", "volume", "price", "mix")
    assert got == [(-48.0, -30.0, 12.0, -30.0)]


def test_pvm_category_in_one_year_dropped(spark):
    m = _pvm_mart(spark, [("a", 2024, 10.0, 10.0), ("a", 2025, 12.0, 10.0), ("c", 2025, 5.0, 3.0)])
    assert [r[0] for r in rows(pvm.pvm_effects(m, 2025), "cat")] == ["Cat"]


def _dso_input(spark, values, ch="Web", months=None):
    months = months or [f"2024-{m:02d}" for m in range(1, len(values) + 1)]
    return spark.createDataFrame([(ym, ch, v) for ym, v in zip(months, values)],
                                 "ym string, ch string, delay_days double").withColumn(
        "amount", F.lit(1.0)).withColumn("order_date", F.to_date(F.concat("ym", F.lit("-15"))))


def test_dso_moving_average_over_rounded_values(spark):
    d = receivables.dso_report(_dso_input(spark, [1.0, 2.0, 4.0, 45.1]))
    assert [r[0] for r in rows(d.orderBy("ym"), "dso_avg3")] == [1.0, 1.5, 2.3, 17.0]


def test_dso_yoy_is_positional(spark):
    months = [f"2024-{m:02d}" for m in range(1, 13)] + ["2025-02"]  # 2025-01 missing
    vals = [float(i) for i in range(1, 14)]
    d = receivables.dso_report(_dso_input(spark, vals, months=months)).orderBy("ym")
    yoy = [r[0] for r in rows(d, "yoy")]
    assert yoy[:12] == [None] * 12 and yoy[12] == 12.0  # 13 - 1 (12th previous row)


def test_dso_alerts(spark):
    df = spark.createDataFrame(
        [("2025-01", "Marketplace", 55.0), ("2025-02", "Marketplace", 55.1),
         ("2025-01", "Web", 3.1), ("2025-01", "Boutique", 99.0)],
        "ym string, ch string, dso_days double")
    a = receivables.dso_alerts(df, receivables.alert_rules(spark))
    got = {(r[0], r[1]): r[2] for r in rows(a, "ym", "ch", "alert")}
    assert got == {("2025-01", "Marketplace"): None,
                   ("2025-02", "Marketplace"): "Marketplace DSO degraded",
                   ("2025-01", "Web"): "Web payment anomaly", ("2025-01", "Boutique"): None}


def _charges(spark, values):
    return spark.createDataFrame(
        [(f"2024-{i + 1:02d}", "CC01", "Ads", v) for i, v in enumerate(values)],
        "ym string, cc_id string, nature string, amount double")


def test_zscore_values_and_alerts(spark):
    cc = spark.createDataFrame([("CC01", "Marketing", 0.0)], "cc_id string, cc_name string, payroll_base double")
    z = drift.charge_zscores(_charges(spark, [100.0, 110.0, 90.0, 105.0, 200.0]), cc).orderBy("ym")
    assert [r[0] for r in rows(z, "z")] == [None, None, -2.12, 0.5, 11.56]
    alerts = drift.charge_alerts(z, 20)
    got = [(r[0], r[1]) for r in rows(alerts, "ym", "severity")]
    assert got == [("2024-05", K.SEVERITY_LABELS["major"]), ("2024-03", K.SEVERITY_LABELS["significant"])]


def test_zscore_constant_series_has_no_alert(spark):
    cc = spark.createDataFrame([("CC01", "Marketing", 0.0)], "cc_id string, cc_name string, payroll_base double")
    z = drift.charge_zscores(_charges(spark, [50.0, 50.0, 50.0]), cc)
    assert all(r[0] is None for r in rows(z, "z"))
    assert drift.charge_alerts(z, 20).count() == 0


@pytest.mark.parametrize("values,target,kept", [
    ([40.0, 40.0, 40.0, 40.0], 100.0, 3), ([50.0, 50.0, 50.0], 100.0, 2), ([10.0, 10.0], 100.0, 2)])
def test_running_cutoff(spark, values, target, kept):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate(values)], "g string, k long, v double")
    for width in (1, 2, 1000):  # one row per bucket, mixed, one bucket
        out = rows(lines.running_cutoff(df, "g", ["k"], "v", target=target, width=width),
                   "kept_rows", "kept_value")
        assert out == [(kept, pytest.approx(sum(values[:kept])))]


def test_seasonality_allocation_and_budget_scale(spark):
    assert math.isclose(sum(K.SEASONALITY.values()), 12.70)
    t = spark.createDataFrame([(2025, 85_000_000.0)], "yr int, target double")
    alloc = planning.seasonal_allocation(t)
    assert alloc.count() == 12
    assert math.isclose(sum(r[0] for r in rows(alloc, "target")), 85_000_000.0, abs_tol=0.05)
    coef12 = sum(85_000_000.0 * c / 12 for c in K.SEASONALITY.values())
    assert round(coef12, 2) == 89_958_333.33


def test_freight_step(spark):
    demand = spark.createDataFrame([("2025-05", "a", 100.0), ("2025-06", "a", 100.0)],
                                   "ym string, sku string, qty double")
    prods = spark.createDataFrame([("a", "Shoes", "PE", 10.0)],
                                  "sku string, cat string, collection string, unit_cost double")
    p = purchasing.purchase_costing(demand, prods, 2025, ("X", "Y")).orderBy("ym")
    assert rows(p, "goods", "freight") == [(1000.0, 30.0), (1000.0, 34.5)]


def test_calendar_flags(spark):
    b = spark.createDataFrame([(D(2024, 11, 19), D(2024, 12, 28))], "start date, end date")
    cal = {r[0]: r[1:] for r in rows(planning.calendar_dim(b), "date", "is_black_friday",
                                     "is_christmas", "is_weekend", "weekday_name")}
    assert cal[D(2024, 11, 19)][0] is False and cal[D(2024, 11, 20)][0] is True
    assert cal[D(2024, 12, 24)][1] is True and cal[D(2024, 12, 25)][1] is False
    assert cal[D(2024, 11, 23)][2] is True and cal[D(2024, 11, 23)][3] == "Saturday"
    assert cal[D(2024, 11, 25)][2] is False


def test_headline_kpis_without_previous_year(spark):
    f = sales(spark, [("a", D(2025, 1, 3), "Web", 2.0, 60.0, 20.0)])
    k = pnl.headline_kpis(marts.sales_mart(f, products(spark)), 2025)
    assert rows(k, "revenue", "margin", "qty", "revenue_growth_pc", "margin_rate_delta_pts") == [
        (60.0, 40.0, 2.0, None, None)]


def test_budget_union_fills_missing_columns(spark):
    rev = spark.createDataFrame([(2025, 1, "CA", "Web", "Shoes", 10.0, 0.5)],
                                "yr int, mo int, type string, ch string, cat string, amount double, margin_pc double")
    exp = spark.createDataFrame([(2025, 1, "Charges", "CC01", 7.0)],
                                "yr int, mo int, type string, cc_id string, amount double")
    u = planning.budget_union(rev, exp)
    assert u.columns == planning.BUDGET_COLUMNS
    assert sorted(rows(u), key=str) == sorted([
        (2025, 1, "CA", "Web", "Shoes", None, 10.0, 0.5),
        (2025, 1, "Charges", None, None, "CC01", 7.0, None)], key=str)


def test_surrogate_keys_sequential(spark):
    df = spark.createDataFrame([(k,) for k in [50, 3, 7, 1000, 42, 8]], "k long")
    got = rows(lines.surrogate_keys(df, "k", "CMD%08d", partitions=3).orderBy("k"))
    assert got == [(3, "CMD00000001"), (7, "CMD00000002"), (8, "CMD00000003"),
                   (42, "CMD00000004"), (50, "CMD00000005"), (1000, "CMD00000006")]


def test_collection_delay_clipped(spark):
    df = spark.createDataFrame([(D(2025, 1, 10), -3), (D(2025, 1, 10), 45)],
                               "order_date date, raw_delay int")
    got = rows(receivables.collection_delay(df), "delay_days", "settle_date")
    assert got == [(0, D(2025, 1, 10)), (45, D(2025, 2, 24))]

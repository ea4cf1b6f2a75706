"""Physical-plan checks: pruning, pushdown, single scans, no cross joins, no Python UDFs."""

import pytest

from closebook.plans import catalog as C

SF = "/root/testdata/sf0.001"


def plan(spark, key):
    df = C.QUERIES[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, key):
    df = C.QUERIES[key](spark, SF)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("key", sorted(C.QUERIES))
def test_no_cross_join_no_python(spark, key):
    p = formatted(spark, key)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (key, bad)


def test_mix_share_scans_fact_once(spark):
    p = formatted(spark, "pnl_mix_share")
    assert p.count("lineitem.parquet") == 1


def test_year_slice_reaches_parquet(spark):
    p = formatted(spark, "headline_kpis")
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_column_pruning(spark):
    p = formatted(spark, "pnl_monthly")
    line = [x for x in p.splitlines() if "ReadSchema" in x and "l_orderkey" in x][0]
    for unused in ("l_shipdate", "l_tax", "l_returnflag", "l_suppkey"):
        assert unused not in line


def test_top_k_alerts_use_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "charge_alerts_top20")


def test_partial_aggregation_before_shuffle(spark):
    p = formatted(spark, "pnl_monthly_cube")
    assert "partial_sum" in p


@pytest.mark.parametrize("key,absent", [
    ("control_growth", ["customer.parquet", "part.parquet"]),
    ("running_cutoff", ["customer.parquet", "part.parquet"]),
    ("headline_kpis", ["customer.parquet"]),
    ("pvm_effects", ["customer.parquet"]),
    ("control_channel_mix", ["part.parquet"]),
])
def test_reports_join_only_the_dimensions_they_use(spark, key, absent):
    p = formatted(spark, key)
    for table in absent:
        assert table not in p, (key, table)


@pytest.mark.parametrize("key", ["budget_variance", "budget_status_counts", "budget_variance_monthly"])
def test_budget_reports_join_the_budget_and_prune_the_orders_by_year(spark, key):
    # actuals of N LEFT JOIN the budget table built from N-1: every scan of orders is bounded by dates
    p = formatted(spark, key)
    scans = [x for x in p.splitlines() if "PushedFilters" in x and "o_orderdate" in x]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in x and "LessThan(o_orderdate" in x for x in scans)


@pytest.mark.parametrize("key", ["budget_expense", "budget_union", "charge_schedule"])
def test_charge_plans_prune_the_lines_by_year(spark, key):
    p = formatted(spark, key)
    assert any("GreaterThanOrEqual(l_shipdate" in x and "LessThan(l_shipdate" in x
               for x in p.splitlines() if "PushedFilters" in x)


@pytest.mark.parametrize("key", ["collections_mart", "dso_alerts", "dso_monthly", "working_capital_impact"])
def test_collections_read_the_orders_once(spark, key):
    assert formatted(spark, key).count("orders.parquet") == 1


@pytest.mark.parametrize("key", ["purchase_costing", "freight_ratio_trend", "pvm_mix_by_sku"])
def test_parts_are_joined_after_aggregation(spark, key):
    assert formatted(spark, key).count("part.parquet") == 1


@pytest.mark.parametrize("key", ["kpi_mart", "budget_variance", "budget_variance_monthly"])
def test_budget_and_actuals_read_the_fact_once(spark, key):
    df = C.QUERIES[key](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("l_orderkey") and sum("FileScan parquet" in x and "lineitem.parquet" in x for x in final.splitlines()) == 1

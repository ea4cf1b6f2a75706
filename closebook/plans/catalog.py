"""Driver catalog: every operator bound to the testdata tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; all are lazy but the line sequences (``running_cutoff`` and the
surrogate keys), which write their checkpoints when they are called. Parameters of the testdata binding (year N, channel slice,
thresholds, rule targets) are collected in ``PARAMS``. Money sums are exact;
amounts a report leaves unrounded are given in cents (2 dp), millions at 4 dp.
Each report joins only the dimensions it reads (``_mart`` variants).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.functions.dates import as_date, in_years
from closebook.functions.numeric import dround, rnd
from closebook.operators import (apportion, controls, drift, lines, marts, planning, pnl, purchasing, pvm,
                                 receivables, refresh, series, values, variance)
from closebook.session import checkpoint_dir
from closebook.sources import storage
from closebook.sources.clustered import write_clustered
from closebook.sources.rejects import load_typed
from closebook.sources.star import table_row_counts, write_csv
from closebook.sources.testdata import LINE_KEYS, TestData

PARAMS = {
    "year": 2000,                       # N on the testdata (N-1 = 1999; 2001 is partial)
    "channel": "BUILDING",              # channel slice of P7
    "dso_rules": [("MACHINERY", 450.0, "DSO degraded"), ("BUILDING", 430.0, "Payment anomaly")],
    "dso_check": ("MACHINERY", "2000-01", 450.0),
    "marketing_cc": ("CC00",),
    "charge_spike": ("CC01", "R"),
    "upmarket_cat": "PROMO",
    "markdown": ("MEDIUM", "Brand#13"),
    "overstock": ("STANDARD", "Brand#11"),
    "cutoff_share": 0.5,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _finish(df: DataFrame) -> DataFrame:
    """Report exact decimal amounts as DOUBLE (the reference's money type)."""
    dec_cols = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
                if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(dec_cols) if dec_cols else df


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _finish(fn(spark, sf_dir))
        QUERIES[name] = run
        return run
    return deco


def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round report columns: exact for decimals, scaled half-away for doubles."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: dround(c, digits) if isinstance(types[c], T.DecimalType) else rnd(c, digits)
        for c in cols})


# --------------------------------------------------------------------------
# shared building blocks: lazy plans built once per accessor (no data cached)
# --------------------------------------------------------------------------

def _memo(fn):
    """Build a shared lazy plan once per TestData accessor (plans, not data)."""
    @functools.wraps(fn)
    def wrapper(td: TestData) -> DataFrame:
        if fn.__name__ not in td.memo:
            td.memo[fn.__name__] = fn(td)
        return td.memo[fn.__name__]
    return wrapper


@_memo
def _mart(td: TestData) -> DataFrame:
    return marts.sales_mart(td.sales_fact(), td.products())


@_memo
def _mart_no_channel(td: TestData) -> DataFrame:
    """Mart for reports without a channel axis: no orders x customer join."""
    return marts.sales_mart(td.sales_fact(with_channel=False), td.products())


@_memo
def _mart_no_product(td: TestData) -> DataFrame:
    """Mart for revenue-by-channel reports: no part join (no category, no cost)."""
    return marts.sales_mart(td.sales_fact())


@_memo
def _lines(td: TestData) -> DataFrame:
    """Revenue lines with their order month only: lineitem x orders."""
    return marts.sales_mart(td.sales_fact(with_channel=False))


@_memo
def _cube(td: TestData) -> DataFrame:
    return marts.monthly_cube(_mart(td))


@_memo
def _cmart(td: TestData) -> DataFrame:
    return marts.collections_mart(receivables.collection_delay(td.collections(with_channel=True)), None)


@_memo
def _charges_m(td: TestData) -> DataFrame:
    return drift.charges_monthly(td.charges())


@_memo
def _charges_before(td: TestData) -> DataFrame:
    """Monthly charges of N-1 alone: the date range stands below the aggregate and reaches the scan."""
    return drift.charges_monthly(td.charges().filter(in_years("charge_date", PARAMS["year"] - 1)))


@_memo
def _budget(td: TestData) -> DataFrame:
    y = PARAMS["year"]
    return planning.budget_union(planning.budget_revenue(_mart(td), y),
                                 planning.budget_expense(_charges_before(td), y, PARAMS["marketing_cc"]))


@_memo
def _cells(td: TestData) -> DataFrame:
    return variance.resolve_budget(_budget(td), PARAMS["year"])


@_memo
def _two_years(td: TestData) -> DataFrame:
    """The cube of N-1 and N alone; both bounds reach the scan of the orders."""
    y = PARAMS["year"]
    return marts.monthly_cube(_mart(td).filter(in_years("order_date", y - 1, y)))


def _cells_from(cube: DataFrame) -> DataFrame:
    """Budget cells of N whose base is read from ``cube``, which the actuals read too."""
    y = PARAMS["year"]
    return variance.resolve_budget(planning.budget_revenue(None, y, base=planning.revenue_budget_base(cube, y)), y)


@_memo
def _dso(td: TestData) -> DataFrame:
    return receivables.dso_report(_cmart(td), receivables.alert_rules(td.spark, PARAMS["dso_rules"]))


_LATEST: list[TestData] = []


def _td(spark: SparkSession, sf_dir: str) -> TestData:
    """The accessor of the session and folder used last: readers and shared plans are built once.

    Only one is kept, so stopped sessions and old file listings go away.
    """
    if not _LATEST or _LATEST[0].spark is not spark or _LATEST[0].base != sf_dir.rstrip("/"):
        _LATEST[:] = [TestData(spark, sf_dir)]
    return _LATEST[0]


def forget() -> None:
    """Drop the accessor: the next query lists files and builds plans anew."""
    _LATEST.clear()


# --------------------------------------------------------------------------
# 2.A sources and marts
# --------------------------------------------------------------------------

@query("table_row_counts")
def q_table_row_counts(spark, sf_dir):
    td = _td(spark, sf_dir)
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    return table_row_counts({n: td.table(n) for n in names})


@query("sales_mart")
def q_sales_mart(spark, sf_dir):
    return _mart(_td(spark, sf_dir))


@query("pnl_monthly_cube")
def q_pnl_monthly_cube(spark, sf_dir):
    return _round(_cube(_td(spark, sf_dir)), 2, "revenue", "cost", "margin")


@query("collections_mart")
def q_collections_mart(spark, sf_dir):
    return _cmart(_td(spark, sf_dir))


@query("kpi_mart")
def q_kpi_mart(spark, sf_dir):
    td = _td(spark, sf_dir)
    return marts.kpi_mart(_cube(td), _cells_from(_cube(td)), PARAMS["year"])


@query("kpi_mart_preview")
def q_kpi_mart_preview(spark, sf_dir):
    return marts.kpi_mart_preview(q_kpi_mart(spark, sf_dir))


# --------------------------------------------------------------------------
# 2.B P&L and KPIs
# --------------------------------------------------------------------------

@query("pnl_monthly")
def q_pnl_monthly(spark, sf_dir):
    return pnl.pnl_monthly(_cube(_td(spark, sf_dir)))


@query("pnl_mix_share")
def q_pnl_mix_share(spark, sf_dir):
    return _round(pnl.pnl_mix_share(_cube(_td(spark, sf_dir))), 2, "revenue", "month_revenue")


@query("monthly_evolution")
def q_monthly_evolution(spark, sf_dir):
    return _round(pnl.monthly_evolution(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"]), 4,
                  "revenue_m", "margin_m")


@query("category_split")
def q_category_split(spark, sf_dir):
    return _round(pnl.category_split(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"]), 4, "revenue_m")


@query("headline_kpis")
def q_headline_kpis(spark, sf_dir):
    return pnl.headline_kpis(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])


@query("filter_years")
def q_filter_years(spark, sf_dir):
    return pnl.filter_years(_lines(_td(spark, sf_dir)))


@query("filter_channels")
def q_filter_channels(spark, sf_dir):
    return pnl.filter_channels(_mart_no_product(_td(spark, sf_dir)))


@query("pnl_channel_slice")
def q_pnl_channel_slice(spark, sf_dir):
    df = pnl.pnl_channel_slice(_mart(_td(spark, sf_dir)), PARAMS["year"], PARAMS["channel"])
    return _round(df, 4, "revenue_m", "margin_m")


# --------------------------------------------------------------------------
# 2.C budget variance
# --------------------------------------------------------------------------

@query("budget_resolved")
def q_budget_resolved(spark, sf_dir):
    return _round(_cells(_td(spark, sf_dir)), 2, "budget_revenue", "budget_margin")


@query("budget_variance")
def q_budget_variance(spark, sf_dir):
    td = _td(spark, sf_dir)
    cube, y = _two_years(td), PARAMS["year"]
    return variance.budget_variance(None, _cells_from(cube), y, actuals=variance.cube_actual_cells(cube, y))


@query("budget_status_counts")
def q_budget_status_counts(spark, sf_dir):
    return variance.budget_status_counts(q_budget_variance(spark, sf_dir))


@query("budget_variance_monthly")
def q_budget_variance_monthly(spark, sf_dir):
    td = _td(spark, sf_dir)
    cube, y = _two_years(td), PARAMS["year"]
    df = variance.budget_variance_monthly(None, _cells_from(cube), y, actuals=variance.cube_actual_cells(cube, y))
    return _round(df, 4, "budget_m", "actual_m", "var_m")


# --------------------------------------------------------------------------
# 2.D price / volume / mix
# --------------------------------------------------------------------------

@query("pvm_yearly_base")
def q_pvm_yearly_base(spark, sf_dir):
    df = pvm.pvm_yearly_base(_mart_no_channel(_td(spark, sf_dir)))
    return _round(_round(df, 2, "revenue"), 4, "avg_price")


@query("pvm_pivot")
def q_pvm_pivot(spark, sf_dir):
    df = pvm.pvm_pivot(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])
    return _round(_round(df, 2, "revenue_n", "revenue_1"), 4, "price_n", "price_1")


@query("pvm_effects")
def q_pvm_effects(spark, sf_dir):
    return pvm.pvm_effects(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])


@query("pvm_ratios")
def q_pvm_ratios(spark, sf_dir):
    return pvm.pvm_ratios(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])


@query("pvm_effects_m")
def q_pvm_effects_m(spark, sf_dir):
    return pvm.pvm_effects_m(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])


@query("pvm_mix_by_sku")
def q_pvm_mix_by_sku(spark, sf_dir):
    td = _td(spark, sf_dir)
    return pvm.pvm_mix_by_sku(_lines(td), PARAMS["year"], td.products())


# --------------------------------------------------------------------------
# 2.E receivables / DSO
# --------------------------------------------------------------------------

@query("dso_monthly")
def q_dso_monthly(spark, sf_dir):
    return receivables.dso_monthly(_cmart(_td(spark, sf_dir))).drop("amount")


@query("dso_trend")
def q_dso_trend(spark, sf_dir):
    return receivables.dso_monthly(_cmart(_td(spark, sf_dir))).select("ym", "ch", "dso_days")


@query("dso_moving_avg")
def q_dso_moving_avg(spark, sf_dir):
    return _dso(_td(spark, sf_dir)).select("ym", "ch", "dso_days", "dso_avg3")


@query("dso_mom")
def q_dso_mom(spark, sf_dir):
    return _dso(_td(spark, sf_dir)).select("ym", "ch", "dso_days", "mom")


@query("dso_yoy")
def q_dso_yoy(spark, sf_dir):
    return _dso(_td(spark, sf_dir)).select("ym", "ch", "dso_days", "yoy")


@query("dso_alerts")
def q_dso_alerts(spark, sf_dir):
    return _dso(_td(spark, sf_dir)).select("ym", "ch", "dso_days", "alert")


@query("dso_channel_check")
def q_dso_channel_check(spark, sf_dir):
    ch, start, thr = PARAMS["dso_check"]
    return receivables.dso_channel_check(_cmart(_td(spark, sf_dir)), ch, start, thr)


@query("collection_delay")
def q_collection_delay(spark, sf_dir):
    td = _td(spark, sf_dir)
    return receivables.collection_delay(td.collections()).select(
        "order_id", "l_linenumber", "l_partkey", "l_suppkey", "order_date", "settle_date",
        "delay_days")


# --------------------------------------------------------------------------
# 2.F drift detection
# --------------------------------------------------------------------------

@query("charges_monthly")
def q_charges_monthly(spark, sf_dir):
    return _round(_charges_m(_td(spark, sf_dir)), 2, "amount")


@query("charges_baseline")
def q_charges_baseline(spark, sf_dir):
    b = drift.trailing_baseline(_charges_m(_td(spark, sf_dir)), ["cc_id", "nature"], "ym", "amount")
    return _round(b, 2, "amount", "mean12", "std12")


def _zs(spark, sf_dir):
    td = _td(spark, sf_dir)
    return drift.charge_zscores(_charges_m(td), td.cost_centres())


@query("charge_zscores")
def q_charge_zscores(spark, sf_dir):
    return _zs(spark, sf_dir).drop("_mean", "_z")


@query("charge_alerts_top20")
def q_charge_alerts_top20(spark, sf_dir):
    return drift.charge_alerts(_zs(spark, sf_dir), 20, True)


@query("charge_alerts_top15")
def q_charge_alerts_top15(spark, sf_dir):
    return drift.charge_alerts(_zs(spark, sf_dir), 15, False)


# --------------------------------------------------------------------------
# 2.G controls
# --------------------------------------------------------------------------

@query("control_by_year")
def q_control_by_year(spark, sf_dir):
    return controls.control_by_year(_mart_no_channel(_td(spark, sf_dir)))


@query("control_channel_mix")
def q_control_channel_mix(spark, sf_dir):
    return controls.control_channel_mix(_mart_no_product(_td(spark, sf_dir)), PARAMS["year"])


@query("control_category_mix")
def q_control_category_mix(spark, sf_dir):
    return controls.control_category_mix(_mart_no_channel(_td(spark, sf_dir)), PARAMS["year"])


@query("control_growth")
def q_control_growth(spark, sf_dir):
    return controls.control_growth(_lines(_td(spark, sf_dir)))


# --------------------------------------------------------------------------
# 2.H planning tables and line logic
# --------------------------------------------------------------------------

@query("calendar_dim")
def q_calendar_dim(spark, sf_dir):
    o = _td(spark, sf_dir).table("orders")
    bounds = o.agg(F.min(as_date("o_orderdate")).alias("start"),
                   F.max(as_date("o_orderdate")).alias("end"))
    return planning.calendar_dim(bounds)


@query("seasonal_allocation")
def q_seasonal_allocation(spark, sf_dir):
    return planning.seasonal_allocation(planning.yearly_targets(_lines(_td(spark, sf_dir))))


@query("running_cutoff")
def q_running_cutoff(spark, sf_dir):
    td = _td(spark, sf_dir)
    # bucket width from one column of lineitem: the lines are exactly its rows
    df = lines.running_cutoff(_lines(td), "ym", LINE_KEYS, "revenue", share=PARAMS["cutoff_share"],
                              keys=td.table("lineitem").select("l_orderkey"))
    return _round(df.withColumnRenamed("kept_value", "kept_revenue"), 2, "kept_revenue", "target")


@query("price_scenario")
def q_price_scenario(spark, sf_dir):
    return purchasing.price_scenario(
        _mart_no_channel(_td(spark, sf_dir)), PARAMS["year"], PARAMS["upmarket_cat"], PARAMS["markdown"],
        sale_pick=F.col("l_linenumber") <= 2, lost_pick=F.col("l_linenumber") == 3)


@query("line_valuation")
def q_line_valuation(spark, sf_dir):
    td = _td(spark, sf_dir)
    li = td.table("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount")
    p = td.table("part").select("p_partkey", "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    unit_price = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) / F.nullif(
        F.col("l_quantity"), F.lit(0.0))
    return purchasing.line_valuation(j, unit_price, F.col("p_retailprice"), F.col("l_quantity"),
                                     LINE_KEYS)


@query("sku_monthly_demand")
def q_sku_monthly_demand(spark, sf_dir):
    return _round(purchasing.sku_monthly_demand(_mart_no_channel(_td(spark, sf_dir))), 2, "cost")


def _purchases(td: TestData) -> DataFrame:
    return purchasing.purchase_costing(purchasing.sku_monthly_demand(_lines(td)), td.products(),
                                       PARAMS["year"], PARAMS["overstock"])


@query("purchase_costing")
def q_purchase_costing(spark, sf_dir):
    return _purchases(_td(spark, sf_dir))


@query("budget_revenue")
def q_budget_revenue(spark, sf_dir):
    return planning.budget_revenue(_mart(_td(spark, sf_dir)), PARAMS["year"])


@query("budget_expense")
def q_budget_expense(spark, sf_dir):
    return planning.budget_expense(_charges_before(_td(spark, sf_dir)), PARAMS["year"],
                                   PARAMS["marketing_cc"])


@query("budget_union")
def q_budget_union(spark, sf_dir):
    return _budget(_td(spark, sf_dir))


@query("charge_schedule")
def q_charge_schedule(spark, sf_dir):
    return planning.charge_schedule(_charges_before(_td(spark, sf_dir)), PARAMS["year"],
                                    PARAMS["marketing_cc"], PARAMS["charge_spike"])


@query("payroll_schedule")
def q_payroll_schedule(spark, sf_dir):
    return planning.payroll_schedule(_td(spark, sf_dir).cost_centres(), PARAMS["year"])


@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    o = _td(spark, sf_dir).table("orders")
    return lines.surrogate_keys(o, "o_orderkey", "CMD%08d").withColumnRenamed("code", "order_code")


@query("surrogate_keys_lines")
def q_surrogate_keys_lines(spark, sf_dir):
    li = _td(spark, sf_dir).table("lineitem")
    return lines.surrogate_keys(li, LINE_KEYS, "VTE%010d").withColumnRenamed("code", "line_code")


@query("surrogate_keys_customers")
def q_surrogate_keys_customers(spark, sf_dir):
    c = _td(spark, sf_dir).table("customer")
    return lines.surrogate_keys(c, "c_custkey", "C%06d").withColumnRenamed("code", "customer_code")


@query("surrogate_keys_products")
def q_surrogate_keys_products(spark, sf_dir):
    p = _td(spark, sf_dir).table("part")
    return lines.surrogate_keys(p, "p_partkey", "SKU%06d").withColumnRenamed("code", "product_code")


@query("surrogate_keys_invoices")
def q_surrogate_keys_invoices(spark, sf_dir):
    bought = _purchases(_td(spark, sf_dir))
    return lines.surrogate_keys(bought, ["ym", "sku"], "FA%07d").withColumnRenamed("code", "invoice_code")


# --------------------------------------------------------------------------
# 2.I extensions
# --------------------------------------------------------------------------

@query("freight_ratio_trend")
def q_freight_ratio_trend(spark, sf_dir):
    return purchasing.freight_ratio_trend(_purchases(_td(spark, sf_dir)))


@query("margin_drift")
def q_margin_drift(spark, sf_dir):
    return purchasing.margin_drift(_cube(_td(spark, sf_dir)))


@query("working_capital_impact")
def q_working_capital_impact(spark, sf_dir):
    return receivables.working_capital_impact(_dso(_td(spark, sf_dir)))


@query("pnl_operating")
def q_pnl_operating(spark, sf_dir):
    td = _td(spark, sf_dir)
    payroll = planning.payroll_schedule(td.cost_centres(), PARAMS["year"])
    return pnl.pnl_operating(_cube(td), _charges_m(td), payroll)


@query("revenue_zscores")
def q_revenue_zscores(spark, sf_dir):
    return drift.revenue_zscores(_cube(_td(spark, sf_dir)))


# --------------------------------------------------------------------------
# calendar-exact series, reduced facts, several grains in one pass
# --------------------------------------------------------------------------

@query("dso_yoy_dense")
def q_dso_yoy_dense(spark, sf_dir):
    return series.dso_report_dense(_cmart(_td(spark, sf_dir)))


@query("charges_baseline_dense")
def q_charges_baseline_dense(spark, sf_dir):
    base = series.baseline_dense(_charges_m(_td(spark, sf_dir)), ["cc_id", "nature"], "amount")
    return _round(base, 2, "amount", "mean12", "std12")


@query("headline_kpis_reduced")
def q_headline_kpis_reduced(spark, sf_dir):
    td, y = _td(spark, sf_dir), PARAMS["year"]
    return pnl.headline_kpis(marts.sales_mart(td.sales_of_years(y - 1, y), td.products()), y)


@query("category_split_reduced")
def q_category_split_reduced(spark, sf_dir):
    td, y = _td(spark, sf_dir), PARAMS["year"]
    return _round(pnl.category_split(marts.sales_mart(td.sales_of_years(y), td.products()), y), 4, "revenue_m")


@query("control_pack")
def q_control_pack(spark, sf_dir):
    return controls.control_pack(_mart(_td(spark, sf_dir)), PARAMS["year"])


@query("pnl_monthly_cube_refreshed")
def q_pnl_monthly_cube_refreshed(spark, sf_dir):
    """The cube after a first load without year N, N's lines as a late batch, and a recomputed month."""
    mart, y = _mart(_td(spark, sf_dir)), PARAMS["year"]
    path = f"{checkpoint_dir(spark).rstrip('/')}/cube-{uuid.uuid4().hex}"
    storage.remove_at_exit(spark, path)
    late = F.coalesce(in_years("order_date", y), F.lit(False))
    refresh.add_lines(mart.filter(~late), path)
    refresh.add_lines(mart.filter(late), path, "late")
    refresh.recompute_months(mart, path, [f"{y - 1}-12", f"{y}-01"])
    return _round(refresh.cube_from_partials(spark, path), 2, "revenue", "cost", "margin")


@query("surrogate_keys_reloaded")
def q_surrogate_keys_reloaded(spark, sf_dir):
    """Order codes after a load up to N-1 and a reload with all orders."""
    o = _td(spark, sf_dir).table("orders")
    first = lines.stable_keys(None, o.filter(as_date("o_orderdate") < F.lit(f"{PARAMS['year']}-01-01").cast("date")), "o_orderkey", "CMD%08d")
    return lines.stable_keys(first, o, "o_orderkey", "CMD%08d").select("o_orderkey", F.col("code").alias("order_code"))


@query("budget_revenue_sku")
def q_budget_revenue_sku(spark, sf_dir):
    mart = _mart_no_product(_td(spark, sf_dir))
    return apportion.budget_revenue_sku(mart, PARAMS["year"], bucket=F.pmod("sku", F.lit(apportion.BUCKETS)))


@query("typed_load_outcome")
def q_typed_load_outcome(spark, sf_dir):
    """All orders written as delimited text, some with damage by key, and loaded: order id and reason (null: loaded)."""
    k = F.col("o_orderkey")
    text = _td(spark, sf_dir).table("orders").select(
        k.cast("string").alias("order_id"),
        F.when(k % 109 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(k % 101 == 0, F.lit("31/12/1999")).otherwise(as_date("o_orderdate").cast("string")).alias("order_date"),
        F.when(k % 103 == 0, F.lit("1 200,50")).otherwise(F.col("o_totalprice").cast("string")).alias("total"))
    schema = T.StructType().add("order_id", "long").add("status", "string").add("order_date", "date").add("total", "double")
    path = f"{checkpoint_dir(spark).rstrip('/')}/typed-{uuid.uuid4().hex}"
    storage.remove_at_exit(spark, path)
    write_csv(text, f"{path}/orders.csv")
    load = load_typed(spark, f"{path}/orders.csv", schema, f"{path}/staged", required=("status",))
    bad = load.rejects.select(F.split("text", ";")[0].cast("long").alias("order_id"), "reason")
    return load.valid.select("order_id", F.lit(None).cast("string").alias("reason")).unionByName(bad)


@query("filter_years_in_use")
def q_filter_years_in_use(spark, sf_dir):
    td = _td(spark, sf_dir)
    dates = td.order_dates().select("order_id", F.year("order_date").alias("yr"))
    return (values.values_in_use(dates, "order_id", "yr", td.table("lineitem"), "l_orderkey")
            .select(F.col("value").alias("yr")).orderBy(F.col("yr").desc()))


@query("filter_channels_in_use")
def q_filter_channels_in_use(spark, sf_dir):
    td = _td(spark, sf_dir)
    return (values.values_in_use(td.order_channels(), "order_id", "ch", td.table("lineitem"), "l_orderkey")
            .select(F.col("value").alias("ch")).orderBy("ch"))


@query("pnl_channel_slice_clustered")
def q_pnl_channel_slice_clustered(spark, sf_dir):
    """P7 on all sales lines written along a Z-order curve over date, channel and product."""
    td = _td(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}"
    storage.remove_at_exit(spark, path)
    fact = td.sales_fact()
    write_clustered(fact, path, ("order_date", "ch", "sku"))
    mart = marts.sales_mart(spark.read.schema(fact.schema).parquet(path), td.products())
    return _round(pnl.pnl_channel_slice(mart, PARAMS["year"], PARAMS["channel"]), 4, "revenue_m", "margin_m")

"""Planning tables (G1, G2, G8-G12): calendar, seasonal targets, budgets, schedules.

They are built from data-derived axes (date bounds, N-1 aggregates, cost
centres) with generators (``sequence`` + ``explode``) instead of Python loops
or cross joins: each axis row expands into its months, and the fixed monthly
coefficients are looked up in a literal array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.functions.dates import in_years, year_month
from closebook.functions.numeric import agg_exact, rnd, safe_div

BUDGET_COLUMNS = ["yr", "mo", "type", "ch", "cat", "cc_id", "amount", "margin_pc"]


def season_coef(mo: Column) -> Column:
    """Seasonality coefficient of a month (1..12) from the fixed table."""
    arr = F.array(*[F.lit(float(K.SEASONALITY[m])) for m in range(1, 13)])
    return F.element_at(arr, mo)


def _months() -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mo")


def calendar_dim(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """G1: one row per day between the bounds with 12 calendar attributes.

    Sales months are January and July, Black Friday is 20-30 November,
    Christmas is 1-24 December. ``weekday_name`` is the English day name,
    ``week`` the ISO week.
    """
    d = bounds.select(F.explode(F.sequence(F.col(start), F.col(end),
                                           F.expr("INTERVAL 1 DAY"))).alias("date"))
    day, mo = F.dayofmonth("date"), F.month("date")
    return d.select(
        "date",
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"),
        day.alias("day"), mo.alias("mo"), F.year("date").alias("yr"),
        F.quarter("date").alias("qtr"), F.weekofyear("date").alias("week"),
        F.date_format("date", "EEEE").alias("weekday_name"),
        F.dayofweek("date").isin(1, 7).alias("is_weekend"),
        F.date_format("date", "yyyy-MM").alias("ym"),
        mo.isin(*K.SALE_MONTHS).alias("is_sale"),
        ((mo == 11) & (day >= K.BLACK_FRIDAY_FROM_DAY)).alias("is_black_friday"),
        ((mo == 12) & day.between(1, K.CHRISTMAS_LAST_DAY)).alias("is_christmas"))


def seasonal_allocation(targets: DataFrame) -> DataFrame:
    """Annual target x coef / sum of the year's coefs -> monthly target.

    ``targets``: (yr, target). The sum of coefficients is taken per year with
    a window over that year's twelve rows.
    """
    m = targets.select("yr", "target", _months()).withColumn("coef", season_coef(F.col("mo")))
    total = F.sum("coef").over(Window.partitionBy("yr"))
    return m.select("yr", "mo", rnd(F.col("target") * F.col("coef") / total, 2).alias("target"))


def yearly_targets(mart: DataFrame, growth: float = K.GROWTH_N) -> DataFrame:
    """Target of year y = actual revenue of y-1 x (1 + growth) (window over the yearly aggregate)."""
    y = agg_exact(mart, ["yr"], revenue=("money", "revenue"))
    prev = F.lag("revenue").over(Window.orderBy("yr"))
    prev_yr = F.lag("yr").over(Window.orderBy("yr"))
    return (y.select("yr", (prev * F.lit(1.0 + growth)).alias("target"), prev_yr.alias("_py"))
             .filter(F.col("_py") == F.col("yr") - 1).drop("_py"))


def budget_amount(total: Column, ch_rev: Column, cat_rev: Column, mo: Column,
                  growth: float = K.GROWTH_N) -> Column:
    """G8 cell amount: target x channel share x category share x coef / 12 (2 dp),
    target = N-1 revenue x (1 + growth), shares of the N-1 revenue."""
    target = total * F.lit(1.0 + growth)
    return rnd(target * safe_div(ch_rev, total) * safe_div(cat_rev, total) * season_coef(mo)
               / F.lit(12.0), 2)


def budget_margin_rate(ch_margin: Column, ch_rev: Column, cat_margin: Column,
                       cat_rev: Column) -> Column:
    """G8 margin rate: mean of the channel and category margin rates (4 dp)."""
    return rnd((safe_div(ch_margin, ch_rev) + safe_div(cat_margin, cat_rev)) / F.lit(2.0), 4)


def revenue_budget_base(cube: DataFrame, year: int) -> DataFrame:
    """N-1 revenue and margin per (channel, category) read from the monthly cube.

    The year stands in the sums, not in a filter that would move below the
    cube's aggregates, so the cube can be shared with other readers.
    """
    before = (F.col("yr") == F.lit(year - 1)) & F.col("ch").isNotNull() & F.col("cat").isNotNull()
    return (cube.groupBy("ch", "cat").agg(F.sum(F.when(before, F.col("revenue"))).alias("rev"),
                                          F.sum(F.when(before, F.col("margin"))).alias("mar"),
                                          F.count(F.when(before, F.lit(1))).alias("_n"))
                .filter("_n > 0").drop("_n"))


def budget_revenue(mart: DataFrame | None, year: int, growth: float = K.GROWTH_N,
                   base: DataFrame | None = None) -> DataFrame:
    """Revenue budget of ``year`` per month x channel x category.

    amount = target x channel share x category share x coef / 12 (coef / 12,
    not coef / sum of coefs: the budget total is about 1.058 x target);
    margin rate = mean of the channel and category margin rates (4 dp).
    Target, shares and margin rates come from the N-1 actuals (``base``, e.g.
    ``revenue_budget_base`` of a cube, or aggregated here from the lines);
    the cells are the (channel, category) pairs sold in N-1, each expanded
    into 12 months.
    """
    if base is None:
        base = agg_exact(mart.filter(in_years("order_date", year - 1) & F.col("ch").isNotNull()
                                     & F.col("cat").isNotNull()),
                         ["ch", "cat"], rev=("money", "revenue"), mar=("money", "margin"))
    by_ch, by_cat, all_ = (Window.partitionBy("ch"), Window.partitionBy("cat"),
                           Window.partitionBy())
    cells = base.select(
        "ch", "cat", F.sum("rev").over(all_).alias("_tot"),
        F.sum("rev").over(by_ch).alias("_chr"), F.sum("rev").over(by_cat).alias("_catr"),
        F.sum("mar").over(by_ch).alias("_chm"), F.sum("mar").over(by_cat).alias("_catm"))
    m = cells.select("*", _months())
    c = F.col
    return m.select(F.lit(year).alias("yr"), "mo", F.lit("CA").alias("type"), "ch", "cat",
                    budget_amount(c("_tot"), c("_chr"), c("_catr"), c("mo"), growth).alias("amount"),
                    budget_margin_rate(c("_chm"), c("_chr"), c("_catm"), c("_catr")).alias("margin_pc"))


def budget_expense(monthly_charges: DataFrame, year: int, marketing_cc: tuple[str, ...]) -> DataFrame:
    """Expense budget per month x cost centre: N-1 monthly average x 1.03,
    x 1.5 for the marketing cost centres in October and November."""
    base = (monthly_charges.filter(F.col("ym").startswith(str(year - 1)))
            .groupBy("cc_id").agg((F.sum("amount") / F.lit(12.0)).alias("base")))
    m = base.select("cc_id", "base", _months())
    peak = F.col("cc_id").isin(*marketing_cc) & F.col("mo").isin(*K.MARKETING_PEAK_MONTHS)
    amount = (F.col("base") * F.lit(K.EXPENSE_INFLATION)
              * F.when(peak, F.lit(K.MARKETING_PEAK)).otherwise(F.lit(1.0)))
    return m.select(F.lit(year).alias("yr"), "mo", F.lit("Charges").alias("type"), "cc_id",
                    rnd(amount, 2).alias("amount"))


def budget_union(revenue: DataFrame, expense: DataFrame) -> DataFrame:
    """Heterogeneous union; columns missing on one side become NULL."""
    return revenue.unionByName(expense, allowMissingColumns=True).select(*BUDGET_COLUMNS)


def _schedule_months(year: int) -> Column:
    """Month starts of N-1 and N."""
    return F.explode(F.sequence(F.make_date(F.lit(year - 1), F.lit(1), F.lit(1)),
                                F.make_date(F.lit(year), F.lit(12), F.lit(1)),
                                F.expr("INTERVAL 1 MONTH"))).alias("month")


def charge_schedule(monthly_charges: DataFrame, year: int, marketing_cc: tuple[str, ...],
                    spike: tuple[str, str]) -> DataFrame:
    """Recurring charges of N-1 and N per (cost centre, nature).

    base = N-1 monthly average of the series; x 1.40 for the ``spike``
    series in April-June N; x 1.5 for marketing cost centres in Oct/Nov.
    """
    base = (monthly_charges.filter(F.col("ym").startswith(str(year - 1)))
            .groupBy("cc_id", "nature").agg((F.sum("amount") / F.lit(12.0)).alias("base")))
    m = base.select("cc_id", "nature", "base", _schedule_months(year))
    mo, yr = F.month("month"), F.year("month")
    spike_on = ((F.col("cc_id") == F.lit(spike[0])) & (F.col("nature") == F.lit(spike[1]))
                & (yr == F.lit(year)) & mo.isin(*K.CHARGE_SPIKE_MONTHS))
    peak = F.col("cc_id").isin(*marketing_cc) & mo.isin(*K.MARKETING_PEAK_MONTHS)
    amount = (F.col("base") * F.when(spike_on, F.lit(K.CHARGE_SPIKE)).otherwise(F.lit(1.0))
              * F.when(peak, F.lit(K.MARKETING_PEAK)).otherwise(F.lit(1.0)))
    return m.select(year_month("month").alias("ym"), "cc_id", "nature", rnd(amount, 2).alias("amount"))


def payroll_schedule(cost_centres: DataFrame, year: int) -> DataFrame:
    """Monthly payroll of N-1 and N per cost centre: x 1.025 in N, x 1.8 in December."""
    m = cost_centres.select("cc_id", "payroll_base", _schedule_months(year))
    amount = (F.col("payroll_base")
              * F.when(F.year("month") == F.lit(year), F.lit(K.PAYROLL_RAISE_N)).otherwise(F.lit(1.0))
              * F.when(F.month("month") == 12, F.lit(K.PAYROLL_DECEMBER)).otherwise(F.lit(1.0)))
    return m.select(year_month("month").alias("ym"), "cc_id", rnd(amount, 2).alias("amount"))

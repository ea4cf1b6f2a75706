"""Budget against actual (V1-V5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.functions.dates import in_years
from closebook.functions.numeric import agg_exact, dround, millions, msum, pct, rnd, safe_div

CELL = ["mo", "ch", "cat"]


def resolve_budget(budget: DataFrame, year: int, kind: str = "CA") -> DataFrame:
    """V1: revenue budget cells of ``year`` with the budgeted margin (amount x margin rate).

    ``budget`` carries channel / category labels (the star adapter resolves
    ids to labels with LEFT JOINs on the dimensions).
    """
    return (budget.filter((F.col("type") == F.lit(kind)) & (F.col("yr") == F.lit(year)))
                  .select("mo", "ch", "cat", F.col("amount").alias("budget_revenue"),
                          (F.col("amount") * F.col("margin_pc")).alias("budget_margin")))


def status(ratio: Column, labels: dict[str, str] = K.STATUS_LABELS) -> Column:
    """V3: classify the unrounded variance ratio; NULL (no budget) falls in the ELSE branch."""
    return (F.when(ratio < F.lit(K.STATUS_STRONG_UNDER), F.lit(labels["strong_under"]))
             .when(ratio < F.lit(K.STATUS_UNDER), F.lit(labels["under"]))
             .when(ratio > F.lit(K.STATUS_OVER), F.lit(labels["over"]))
             .otherwise(F.lit(labels["on_track"])))


def actual_cells(mart: DataFrame, year: int, channel: str | None = None) -> DataFrame:
    """Actual revenue and margin of ``year`` per (mo, ch, cat) from sales lines."""
    act = mart.filter(in_years("order_date", year))
    if channel is not None:
        act = act.filter(F.col("ch") == F.lit(channel))
    return agg_exact(act, CELL, actual_revenue=("money", "revenue"),
                     actual_margin=("money", "margin"))


def cube_actual_cells(cube: DataFrame, year: int, channel: str | None = None) -> DataFrame:
    """The same cells read from the monthly cube.

    The year stands in the sums, not in a filter below them, so that the
    budget's base (``planning.revenue_budget_base``) and these cells read one
    cube: Spark runs its plan once and reuses the exchange.
    """
    now = F.col("yr") == F.lit(year)
    c = cube if channel is None else cube.filter(F.col("ch") == F.lit(channel))
    return (c.groupBy(*CELL).agg(F.sum(F.when(now, F.col("revenue"))).alias("actual_revenue"),
                                 F.sum(F.when(now, F.col("margin"))).alias("actual_margin"),
                                 F.count(F.when(now, F.lit(1))).alias("_n"))
             .filter("_n > 0").drop("_n"))


def actual_vs_budget(mart: DataFrame | None, budget_cells: DataFrame, year: int,
                     channel: str | None = None, how: str = "left",
                     actuals: DataFrame | None = None) -> DataFrame:
    """Actuals of ``year`` per cell LEFT JOIN budget cells (unrounded).

    Actuals are aggregated before the join, so the join sees one row per
    cell; pass ``actuals`` (e.g. ``cube_actual_cells``) to reuse an existing
    aggregate. Actuals are the left side: a budget cell without sales
    disappears (``how='full'`` keeps it, as an opt-in).
    """
    act = actuals if actuals is not None else actual_cells(mart, year, channel)
    return act.join(budget_cells.select(*CELL, "budget_revenue", "budget_margin"), CELL, how)


def budget_variance(mart: DataFrame | None, budget_cells: DataFrame | None, year: int,
                    channel: str | None = None, actuals: DataFrame | None = None, how: str = "left") -> DataFrame:
    """V2 + V3: per cell budget, actual, variance and variance % for revenue and margin.

    ``how='full'`` also lists budget cells without sales (NULL actuals).
    """
    j = actual_vs_budget(mart, budget_cells, year, channel, how=how, actuals=actuals)
    var_r = F.col("actual_revenue") - F.col("budget_revenue")
    var_m = F.col("actual_margin") - F.col("budget_margin")
    return (j.select(
        *CELL,
        rnd("budget_revenue", 0).alias("budget_revenue"),
        dround("actual_revenue", 0).alias("actual_revenue"),
        rnd(var_r, 0).alias("var_revenue"),
        pct(var_r, F.col("budget_revenue"), 1).alias("var_revenue_pc"),
        rnd("budget_margin", 0).alias("budget_margin"),
        dround("actual_margin", 0).alias("actual_margin"),
        rnd(var_m, 0).alias("var_margin"),
        pct(var_m, F.col("budget_margin"), 1).alias("var_margin_pc"),
        status(safe_div(var_r, F.col("budget_revenue"))).alias("status"),
        F.abs(var_r).alias("_abs_var"))
        .orderBy(F.col("mo"), F.col("_abs_var").desc_nulls_last())
        .drop("_abs_var"))


def budget_status_counts(variance: DataFrame) -> DataFrame:
    """Number of cells per status."""
    return variance.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status")


def budget_variance_monthly(mart: DataFrame | None, budget_cells: DataFrame | None, year: int,
                            channel: str | None = None,
                            labels=("favourable", "unfavourable"),
                            actuals: DataFrame | None = None) -> DataFrame:
    """V4 + V5: monthly roll-up of the cell join, in millions, with the favourable flag.

    SUM(actual - budget) skips cells without budget, like the reference.
    """
    j = actual_vs_budget(mart, budget_cells, year, channel, actuals=actuals)
    agg = j.groupBy("mo").agg(
        msum("budget_revenue").alias("budget"), F.sum("actual_revenue").alias("actual"),
        msum(F.col("actual_revenue") - F.col("budget_revenue")).alias("var"))
    return (agg.select("mo", millions(F.col("budget")).alias("budget_m"),
                       millions(F.col("actual")).alias("actual_m"),
                       millions(F.col("var")).alias("var_m"),
                       pct(F.col("var"), F.col("budget"), 1).alias("var_pc"),
                       F.when(F.col("var") >= 0, F.lit(labels[0]))
                        .otherwise(F.lit(labels[1])).alias("favourable"))
               .orderBy("mo"))

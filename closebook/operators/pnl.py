"""P&L reports and headline KPIs (P1-P7) and the operating P&L by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions.dates import in_years, month_key
from closebook.functions.numeric import agg_exact, dround, millions, msum, pct, rnd, safe_div


def _slice(mart: DataFrame, year: int | None = None, channel: str | None = None) -> DataFrame:
    """Parameterised slice; values are bound as literals, never spliced into SQL text."""
    df = mart
    if year is not None:
        df = df.filter(in_years("order_date", year))
    if channel is not None:
        df = df.filter(F.col("ch") == F.lit(channel))
    return df


def pnl_mix_share(cube: DataFrame) -> DataFrame:
    """Cell revenue against its month total.

    The month total is a window sum over the cube (partition = month), so the
    fact is scanned once; a self-join on a second aggregation would scan it
    twice.
    """
    month_total = F.sum("revenue").over(Window.partitionBy("ym"))
    return (cube.select("ym", "ch", "cat", "revenue", month_total.alias("month_revenue"))
                .withColumn("mix_share_pc", pct(F.col("revenue"), F.col("month_revenue"), 1)))


def pnl_monthly(cube: DataFrame) -> DataFrame:
    """Channel x category x month P&L, amounts at 0 dp, rates at 1 dp, mix share."""
    month_total = F.sum("revenue").over(Window.partitionBy("ym"))
    return (cube.withColumn("month_revenue", month_total)
                .select("ym", "ch", "cat", "qty",
                        dround("revenue", 0).alias("revenue"), dround("cost", 0).alias("cost"),
                        dround("margin", 0).alias("margin"),
                        pct(F.col("margin"), F.col("revenue"), 1).alias("margin_pc"),
                        pct(F.col("revenue"), F.col("month_revenue"), 1).alias("mix_share_pc"))
                .orderBy(*[F.col(c).asc_nulls_last() for c in ["ym", "ch", "cat"]]))


def monthly_evolution(mart: DataFrame, year: int, channel: str | None = None) -> DataFrame:
    """P3 (and P7 with a channel): revenue and margin in millions, margin % per month."""
    return (agg_exact(_slice(mart, year, channel), [month_key("order_date").alias("_m")],
                      revenue=("money", "revenue"), margin=("money", "margin"))
            .select(F.date_format("_m", "yyyy-MM").alias("ym"),
                    millions(F.col("revenue")).alias("revenue_m"),
                    millions(F.col("margin")).alias("margin_m"),
                    pct(F.col("margin"), F.col("revenue"), 1).alias("margin_pc"))
            .orderBy("ym"))


def pnl_channel_slice(mart: DataFrame, year: int, channel: str) -> DataFrame:
    """The monthly evolution of one channel."""
    return monthly_evolution(mart, year, channel)


def category_split(mart: DataFrame, year: int, channel: str | None = None) -> DataFrame:
    """Revenue by category (millions) and its share of the slice total.

    The share is a window over the post-aggregate rows (one per category), so
    the unpartitioned window sees only a handful of rows.
    """
    agg = agg_exact(_slice(mart, year, channel), ["cat"], revenue=("money", "revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    return (agg.select("cat", millions(F.col("revenue")).alias("revenue_m"),
                       pct(F.col("revenue"), total, 1).alias("share_pc"))
               .orderBy(F.col("revenue_m").desc()))


def headline_kpis(mart: DataFrame, year: int, channel: str | None = None) -> DataFrame:
    """P5: year totals against N-1 in a single pass (conditional aggregation).

    Growth and margin-rate deltas are NULL when N-1 has no sales.
    """
    df = _slice(mart, None, channel).filter(in_years("order_date", year - 1, year))
    cur = F.col("yr") == F.lit(year)
    prev = F.col("yr") == F.lit(year - 1)
    agg = agg_exact(
        df, [],
        revenue=("money", F.when(cur, F.col("revenue"))),
        cost=("money", F.when(cur, F.col("cost"))),
        margin=("money", F.when(cur, F.col("margin"))),
        qty=("sum", F.when(cur, F.col("qty"))),
        revenue_1=("money", F.when(prev, F.col("revenue"))),
        margin_1=("money", F.when(prev, F.col("margin"))))
    rate = safe_div(F.col("margin"), F.col("revenue")) * F.lit(100.0)
    rate_1 = safe_div(F.col("margin_1"), F.col("revenue_1")) * F.lit(100.0)
    return agg.select(
        dround("revenue", 2).alias("revenue"), dround("cost", 2).alias("cost"),
        dround("margin", 2).alias("margin"), "qty",
        pct(F.col("revenue") - F.col("revenue_1"), F.col("revenue_1"), 1).alias("revenue_growth_pc"),
        pct(F.col("margin") - F.col("margin_1"), F.col("margin_1"), 1).alias("margin_growth_pc"),
        rnd(rate, 1).alias("margin_rate_pc"),
        rnd(rate - rate_1, 1).alias("margin_rate_delta_pts"))


def filter_years(mart: DataFrame) -> DataFrame:
    """Distinct years, most recent first."""
    return mart.select("yr").distinct().orderBy(F.col("yr").desc())


def filter_channels(mart: DataFrame) -> DataFrame:
    """Distinct channels, ascending."""
    return mart.select("ch").distinct().orderBy(F.col("ch").asc_nulls_last())


def pnl_operating(cube: DataFrame, charges: DataFrame, payroll: DataFrame) -> DataFrame:
    """X4 (extension): monthly gross margin - external charges - payroll.

    Three month-level aggregates (exact decimal sums; ``cube`` and ``charges``
    already carry decimal amounts) joined with full outer joins on the month,
    so a month present in any source is kept; missing parts count as 0.
    """
    m = cube.groupBy("ym").agg(F.sum("margin").alias("margin"))
    c = charges.groupBy("ym").agg(F.sum("amount").alias("charges"))
    p = payroll.groupBy("ym").agg(msum("amount").alias("payroll"))
    j = m.join(c, "ym", "full").join(p, "ym", "full")
    z = F.lit(0).cast("decimal(1,0)")
    result = (F.coalesce(F.col("margin"), z) - F.coalesce(F.col("charges"), z)
              - F.coalesce(F.col("payroll"), z))
    return j.select("ym", dround("margin", 2).alias("margin"), dround("charges", 2).alias("charges"),
                    dround("payroll", 2).alias("payroll"),
                    dround(result, 2).alias("operating_result")).orderBy("ym")

"""Consistency controls printed at load time (Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions.dates import in_years
from closebook.functions.numeric import agg_exact, millions, pct


def control_by_year(mart: DataFrame) -> DataFrame:
    """Q1: revenue and margin (millions, 2 dp) and margin % (1 dp) per year."""
    return (agg_exact(mart, ["yr"], revenue=("money", "revenue"), margin=("money", "margin"))
            .select("yr", millions(F.col("revenue"), 2).alias("revenue_m"),
                    millions(F.col("margin"), 2).alias("margin_m"),
                    pct(F.col("margin"), F.col("revenue"), 1).alias("margin_pc"))
            .orderBy("yr"))


def _mix(mart: DataFrame, year: int, axis: str) -> DataFrame:
    """Share of one axis in the year total.

    The reference divides by an uncorrelated scalar subquery; here the total
    is a window over the per-axis aggregate (a few rows), one scan of the fact.
    """
    agg = agg_exact(mart.filter(in_years("order_date", year)), [axis], revenue=("money", "revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    return (agg.select(axis, millions(F.col("revenue"), 2).alias("revenue_m"),
                       pct(F.col("revenue"), total, 1).alias("share_pc"))
               .orderBy(F.col("revenue_m").desc(), F.col(axis).asc_nulls_last()))


def control_channel_mix(mart: DataFrame, year: int) -> DataFrame:
    """Q2: channel mix of year N."""
    return _mix(mart, year, "ch")


def control_category_mix(mart: DataFrame, year: int) -> DataFrame:
    """Q3: category mix of year N."""
    return _mix(mart, year, "cat")


def control_growth(mart: DataFrame) -> DataFrame:
    """Q4: yearly revenue and growth vs the previous year (window over the yearly aggregate)."""
    agg = agg_exact(mart, ["yr"], revenue=("money", "revenue"))
    prev = F.lag("revenue").over(Window.orderBy("yr"))
    return (agg.select("yr", millions(F.col("revenue"), 2).alias("revenue_m"),
                       pct(F.col("revenue") - prev, prev, 1).alias("growth_pc"))
               .orderBy("yr"))


def control_pack(mart: DataFrame, year: int) -> DataFrame:
    """Q1-Q4 from one pass over the lines: one row per year, per channel of ``year`` and per category of ``year``.

    The lines are summed up once to (year, channel, category) cells with exact
    money; GROUPING SETS over the cells give the three grains with their grain
    id, and each figure is read from its grain: margin rate and growth from the
    years, shares from the grain's total. NULL labels are groups of their own.
    """
    cells = agg_exact(mart, ["yr", "ch", "cat"], revenue=("money", "revenue"), margin=("money", "margin"))
    sets = [["yr"], ["yr", "ch"], ["yr", "cat"]]
    sums = cells.groupingSets([[F.col(c) for c in s] for s in sets], "yr", "ch", "cat").agg(
        F.grouping_id().alias("gid"), F.sum("revenue").alias("revenue"), F.sum("margin").alias("margin"))
    # the grain id has a bit for each of (yr, ch, cat) that is summed over
    grain = F.when(F.col("gid") == 3, "year").when(F.col("gid") == 1, "channel").otherwise("category")
    rows = sums.withColumn("grain", grain).filter((F.col("grain") == "year") | (F.col("yr") == F.lit(year)))
    total = F.sum("revenue").over(Window.partitionBy("grain"))
    before = F.lag("revenue").over(Window.partitionBy("grain").orderBy("yr"))
    by_year = F.col("grain") == "year"
    key = F.when(by_year, F.col("yr").cast("string")).when(F.col("grain") == "channel", F.col("ch")).otherwise(F.col("cat"))
    return rows.select(
        "grain", key.alias("key"), millions(F.col("revenue"), 2).alias("revenue_m"),
        F.when(by_year, millions(F.col("margin"), 2)).alias("margin_m"),
        F.when(by_year, pct(F.col("margin"), F.col("revenue"), 1)).alias("margin_pc"),
        F.when(by_year, pct(F.col("revenue") - before, before, 1)).alias("growth_pc"),
        F.when(~by_year, pct(F.col("revenue"), total, 1)).alias("share_pc"))

"""Pricing and purchasing logic (G4-G7) and the purchase-side analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.functions.dates import month_key
from closebook.functions.numeric import agg_exact, dec, dround, money, msum, rnd, safe_div


def price_scenario(mart: DataFrame, year: int, upmarket_cat: str,
                   markdown: tuple[str, str], sale_pick: Column, lost_pick: Column) -> DataFrame:
    """Rule-based price adjustment, then revenue before / after per (category, month).

    Rules (multipliers on the line price):
      * ``upmarket_cat`` in year N: x 1.30, and the ``lost_pick`` lines of it are dropped;
      * ``markdown`` = (category, collection) in September N: x 0.85;
      * sales months (January, July): ``sale_pick`` lines x 0.70.
    ``sale_pick`` / ``lost_pick`` are deterministic line predicates standing in
    for the generator's random 40 % / 20 % draws.
    """
    in_n = F.col("yr") == F.lit(year)
    up = in_n & (F.col("cat") == F.lit(upmarket_cat))
    md = (in_n & (F.col("mo") == F.lit(K.MARKDOWN_MONTH)) & (F.col("cat") == F.lit(markdown[0]))
          & (F.col("collection") == F.lit(markdown[1])))
    sale = F.col("mo").isin(*K.SALE_MONTHS) & sale_pick
    one = dec("1.00")
    mult = (F.when(up, dec(K.PRICE_UPMARKET)).otherwise(one)
            * F.when(md, dec(K.PRICE_MARKDOWN)).otherwise(one)
            * F.when(sale, dec(K.PRICE_SALE)).otherwise(one))
    kept = ~(up & lost_pick)
    after = F.when(kept, money("revenue") * mult)
    return (mart.groupBy("cat", month_key("order_date").alias("_m"))
            .agg(msum("revenue").alias("revenue_before"), F.sum(after).alias("revenue_after"),
                 F.count(F.when(kept, F.lit(1))).alias("lines_after"))
            .select("cat", F.date_format("_m", "yyyy-MM").alias("ym"),
                    dround("revenue_before", 2).alias("revenue_before"),
                    dround("revenue_after", 2).alias("revenue_after"), "lines_after"))


def line_valuation(lines: DataFrame, unit_price: Column, unit_cost: Column, qty: Column,
                   keys: list[str]) -> DataFrame:
    """revenue = round(unit price x qty, 2); cost = round(unit cost x qty, 2)."""
    return lines.select(*keys, rnd(unit_price * qty, 2).alias("revenue"),
                        rnd(unit_cost * qty, 2).alias("cost"))


def sku_monthly_demand(mart: DataFrame) -> DataFrame:
    """Quantity and (if the lines carry it) cost sold per (month, SKU)."""
    cost = {"cost": ("money", "cost")} if "cost" in mart.columns else {}
    agg = agg_exact(mart, [month_key("order_date").alias("_m"), "sku"], qty=("sum", "qty"), **cost)
    return agg.select(F.date_format("_m", "yyyy-MM").alias("ym"), "sku", "qty", *cost)


def purchase_costing(demand: DataFrame, products: DataFrame, year: int,
                     overstock: tuple[str, str]) -> DataFrame:
    """Purchase orders sized on demand, valued at unit cost, plus freight.

    order qty = floor(qty x 1.6) for the ``overstock`` (category, collection)
    in March-April N, else floor(qty); goods = round(qty x unit cost, 2);
    freight = round(goods x rate, 2) with the rate stepping from 3 % to 3.45 %
    from June N; total = goods + freight. Demand joins products on SKU
    (inner: every purchase needs a product cost).
    """
    j = demand.join(products.select("sku", "cat", "collection", "unit_cost"), "sku", "inner")
    yr = F.substring("ym", 1, 4).cast("int")
    mo = F.substring("ym", 6, 2).cast("int")
    over = ((yr == F.lit(year)) & mo.isin(*K.OVERSTOCK_MONTHS)
            & (F.col("cat") == F.lit(overstock[0])) & (F.col("collection") == F.lit(overstock[1])))
    qty = F.floor(F.col("qty") * F.when(over, F.lit(K.OVERSTOCK_FACTOR)).otherwise(F.lit(1.0)))
    rate = F.when((yr == F.lit(year)) & (mo >= F.lit(K.FREIGHT_STEP_MONTH)),
                  F.lit(K.FREIGHT_RATE_FROM_STEP)).otherwise(F.lit(K.FREIGHT_RATE))
    p = j.select("ym", "sku", qty.cast("long").alias("qty"), "unit_cost", rate.alias("rate"))
    p = p.withColumn("goods", rnd(F.col("qty") * F.col("unit_cost"), 2))
    p = p.withColumn("freight", rnd(F.col("goods") * F.col("rate"), 2))
    return p.select("ym", "sku", "qty", "goods", "freight",
                    (F.col("goods") + F.col("freight")).alias("total"))


def freight_ratio_trend(purchases: DataFrame) -> DataFrame:
    """X1 (extension): freight / goods per month and its change in points.

    The lag runs over the month-level aggregate (one row per month).
    """
    m = agg_exact(purchases, ["ym"], goods=("money", "goods"), freight=("money", "freight"))
    ratio = safe_div(F.col("freight"), F.col("goods")) * F.lit(100.0)
    m = m.withColumn("_r", ratio)
    return m.select("ym", dround("goods", 2).alias("goods"), dround("freight", 2).alias("freight"),
                    rnd("_r", 3).alias("ratio_pc"),
                    rnd(F.col("_r") - F.lag("_r").over(Window.orderBy("ym")), 3).alias("change_pts")
                    ).orderBy("ym")


def margin_drift(cube: DataFrame, window: int = 12) -> DataFrame:
    """X2 (extension): category margin % per month against its trailing mean."""
    m = (cube.filter(F.col("cat").isNotNull()).groupBy("ym", "cat")
         .agg(F.sum("margin").alias("margin"), F.sum("revenue").alias("revenue"))
         .withColumn("_pc", safe_div(F.col("margin"), F.col("revenue")) * F.lit(100.0)))
    w = Window.partitionBy("cat").orderBy("ym").rowsBetween(-window, -1)
    m = m.withColumn("_tm", F.avg("_pc").over(w))
    return m.select("ym", "cat", rnd("_pc", 2).alias("margin_pc"),
                    rnd("_tm", 2).alias("trailing_mean"),
                    rnd(F.col("_pc") - F.col("_tm"), 2).alias("gap"))

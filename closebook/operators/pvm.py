"""Price / volume / mix decomposition of the revenue change N vs N-1.

volume = (q_n - q_1) * p_1 ; price = (p_n - p_1) * q_n ; mix = total - volume - price
with p = revenue / quantity at the same grain. At category grain the mix
residual is zero up to float noise (kept faithfully, -0.0 normalised);
E6 computes the price effect per SKU so the mix captures within-category shifts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.functions.dates import in_years
from closebook.functions.numeric import agg_exact, dround, millions, no_negative_zero, pct, rnd, safe_div


def pvm_yearly_base(mart: DataFrame) -> DataFrame:
    """Quantity, revenue and average price per (year, category)."""
    return (agg_exact(mart, ["yr", "cat"], qty=("sum", "qty"), revenue=("money", "revenue"))
            .withColumn("avg_price", safe_div(F.col("revenue"), F.col("qty"))))


def pvm_pivot(mart: DataFrame, year: int, keys=("cat",)) -> DataFrame:
    """N and N-1 side by side per category, in one pass (conditional aggregation).

    Only categories sold in both years are kept (the inner self-join semantics);
    a NULL category never matches itself and is dropped too.
    """
    cur = F.col("yr") == F.lit(year)
    prev = F.col("yr") == F.lit(year - 1)
    agg = agg_exact(mart.filter(in_years("order_date", year - 1, year)), list(keys),
                    qty_n=("sum", F.when(cur, F.col("qty"))),
                    qty_1=("sum", F.when(prev, F.col("qty"))),
                    revenue_n=("money", F.when(cur, F.col("revenue"))),
                    revenue_1=("money", F.when(prev, F.col("revenue"))),
                    _rows_n=("count", F.when(cur, F.lit(1))),
                    _rows_1=("count", F.when(prev, F.lit(1))))
    both = (F.col("_rows_n") > 0) & (F.col("_rows_1") > 0)
    for k in keys:
        both = both & F.col(k).isNotNull()
    return (agg.filter(both)
               .select(*keys, "qty_n", "qty_1",
                       safe_div(F.col("revenue_n"), F.col("qty_n")).alias("price_n"),
                       safe_div(F.col("revenue_1"), F.col("qty_1")).alias("price_1"),
                       "revenue_n", "revenue_1"))


def _effects(p: DataFrame) -> DataFrame:
    total = F.col("revenue_n") - F.col("revenue_1")
    volume = (F.col("qty_n") - F.col("qty_1")) * F.col("price_1")
    price = (F.col("price_n") - F.col("price_1")) * F.col("qty_n")
    return p.select("*", total.alias("_total"), volume.alias("_volume"), price.alias("_price"),
                    (total - volume - price).alias("_mix"))


def pvm_effects(mart: DataFrame, year: int) -> DataFrame:
    """The three effects in currency units (0 dp), largest change first."""
    e = _effects(pvm_pivot(mart, year))
    return (e.select("cat", dround("revenue_1", 0).alias("revenue_1"),
                     dround("revenue_n", 0).alias("revenue_n"),
                     dround("_total", 0).alias("total_var"), rnd("_volume", 0).alias("volume"),
                     rnd("_price", 0).alias("price"),
                     no_negative_zero(rnd("_mix", 0)).alias("mix"),
                     F.abs("_total").alias("_order"))
             .orderBy(F.col("_order").desc()).drop("_order"))


def pvm_ratios(mart: DataFrame, year: int) -> DataFrame:
    """Growth, price and volume change in % (1 dp)."""
    p = pvm_pivot(mart, year)
    return (p.select("cat",
                     pct(F.col("revenue_n") - F.col("revenue_1"), F.col("revenue_1"), 1).alias("growth_pc"),
                     pct(F.col("price_n") - F.col("price_1"), F.col("price_1"), 1).alias("price_pc"),
                     pct(F.col("qty_n") - F.col("qty_1"), F.col("qty_1"), 1).alias("volume_pc"),
                     F.abs(F.col("revenue_n") - F.col("revenue_1")).alias("_order"))
             .orderBy(F.col("_order").desc()).drop("_order"))


def pvm_effects_m(mart: DataFrame, year: int) -> DataFrame:
    """E5: the decomposition in millions (2 dp) with the ratios, as the dashboard shows it."""
    e = _effects(pvm_pivot(mart, year))

    def m(c):
        return rnd(F.col(c) / F.lit(1e6), 2)

    def md(c):
        return millions(F.col(c), 2)

    return (e.select("cat", md("revenue_1").alias("revenue_1_m"), md("revenue_n").alias("revenue_n_m"),
                     md("_total").alias("total_var_m"), m("_volume").alias("volume_m"),
                     m("_price").alias("price_m"), no_negative_zero(m("_mix")).alias("mix_m"),
                     pct(F.col("_total"), F.col("revenue_1"), 1).alias("growth_pc"),
                     pct(F.col("price_n") - F.col("price_1"), F.col("price_1"), 1).alias("price_pc"),
                     pct(F.col("qty_n") - F.col("qty_1"), F.col("qty_1"), 1).alias("volume_pc"),
                     F.abs("_total").alias("_order"))
             .orderBy(F.col("_order").desc()).drop("_order"))


def pvm_mix_by_sku(mart: DataFrame, year: int, products: DataFrame | None = None) -> DataFrame:
    """E6 (extension): price effect summed over SKUs sold in both years; mix = residual.

    Two aggregations: SKU grain (conditional sums of N and N-1), then a
    roll-up to category of the SKU-level rows. Volume stays at category grain.
    New and dropped SKUs fall into the mix. With ``products`` (sku, cat), the
    lines need no category: they are aggregated by SKU before the join.
    """
    cur = F.col("yr") == F.lit(year)
    prev = F.col("yr") == F.lit(year - 1)
    lines = mart.filter(in_years("order_date", year - 1, year))
    if products is None:
        lines = lines.filter(F.col("cat").isNotNull())
    sku = agg_exact(lines, ["sku"] if products is not None else ["cat", "sku"],
                    q_n=("sum", F.when(cur, F.col("qty"))), q_1=("sum", F.when(prev, F.col("qty"))),
                    r_n=("money", F.when(cur, F.col("revenue"))),
                    r_1=("money", F.when(prev, F.col("revenue"))))
    if products is not None:
        sku = sku.join(products.select("sku", "cat").filter(F.col("cat").isNotNull()), "sku")
    sku_price = ((safe_div(F.col("r_n"), F.col("q_n")) - safe_div(F.col("r_1"), F.col("q_1")))
                 * F.col("q_n"))
    cat = (sku.groupBy("cat")
           .agg(F.sum("q_n").alias("qty_n"), F.sum("q_1").alias("qty_1"),
                F.sum("r_n").alias("revenue_n"), F.sum("r_1").alias("revenue_1"),
                F.sum(sku_price).alias("price_eff"))
           .filter(F.col("revenue_n").isNotNull() & F.col("revenue_1").isNotNull()))
    total = F.col("revenue_n") - F.col("revenue_1")
    volume = (F.col("qty_n") - F.col("qty_1")) * safe_div(F.col("revenue_1"), F.col("qty_1"))
    price = F.coalesce(F.col("price_eff"), F.lit(0.0))
    return (cat.select("cat", dround(total, 0).alias("total_var"), rnd(volume, 0).alias("volume"),
                       rnd(price, 0).alias("price"),
                       no_negative_zero(rnd(total - volume - price, 0)).alias("mix"),
                       F.abs(total).alias("_order"))
               .orderBy(F.col("_order").desc()).drop("_order"))

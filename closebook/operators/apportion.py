"""G8 on any axes: a budget in whole cents that adds up to its target on every level.

Largest-remainder apportionment: each cell gets the whole cents of its share
and the cents left over go to the cells with the largest remainders, ties by
key. Done level by level (year, month, channel, product bucket, product), the
ranking of a level runs inside the groups of the level above, so no window
holds more than one level's fan-out; products are first dealt to ``buckets``
by a stable expression, which bounds the last level. All arithmetic is on whole
numbers (DECIMAL(38,0)).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.functions.dates import in_years
from closebook.functions.numeric import agg_exact

WHOLE = "decimal(38,0)"
BUCKETS = 64


def apportion(cells: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """Columns by, keys and ``cents`` of each cell: ``target`` of its group, shared by ``weight``.

    ``cells``: by, keys (naming a cell in its group), target (whole, the same in
    a group) and weight (whole, not negative). The cents of a group add up to
    its target; cells without weight get none, and a group without any weight
    shares nothing.
    """
    group = Window.partitionBy(*by)
    shared = (cells.filter("weight > 0").withColumn("_all", F.sum("weight").over(group).cast(WHOLE))
              .withColumn("_whole", F.expr("target * weight div _all").cast(WHOLE))
              .withColumn("_rest", (F.col("target") * F.col("weight") % F.col("_all")).cast(WHOLE)))
    left = F.col("target") - F.sum("_whole").over(group)
    turn = F.row_number().over(group.orderBy(F.col("_rest").desc(), *keys))
    return shared.select(*by, *keys, (F.col("_whole") + F.when(turn <= left, 1).otherwise(0)).cast(WHOLE).alias("cents"))


def budget_revenue_sku(mart: DataFrame, year: int, growth: float = K.GROWTH_N, bucket: Column | None = None,
                       buckets: int = BUCKETS) -> DataFrame:
    """Revenue budget of ``year`` per month x channel x product: (yr, mo, ch, sku, amount), exact to the cent.

    Target: N-1 revenue x (1 + growth), rounded to cents; months by the
    seasonal coefficients, channels and products by their N-1 revenue. Lines
    without channel count for the target but get no budget of their own.
    Products that sold nothing in N-1 have no row. Amounts are DECIMAL(38,2).
    """
    units = lambda c: (F.col(c) * F.lit(Decimal(10_000))).cast(WHOLE)
    before = agg_exact(mart.filter(in_years("order_date", year - 1)), ["ch", "sku"], revenue=("money", "revenue"))
    pairs = before.filter(F.col("ch").isNotNull() & F.col("sku").isNotNull())
    deal = F.pmod(F.xxhash64("sku"), F.lit(buckets)) if bucket is None else bucket
    products = pairs.select("ch", deal.cast("int").alias("bucket"), "sku", units("revenue").alias("weight"))
    rise = F.lit(Decimal(str(round(1.0 + growth, 6))))
    target = before.agg(F.round(F.sum("revenue") * rise, 2).alias("t")).select((F.col("t") * 100).cast(WHOLE).alias("target"))

    coefs = F.array(*[F.struct(F.lit(m).alias("mo"), F.lit(Decimal(str(K.SEASONALITY[m])) * 100).cast(WHOLE).alias("weight"))
                      for m in range(1, 13)])
    months = apportion(target.select("target", F.explode(coefs).alias("c")).select("target", "c.mo", "c.weight"), [], ["mo"])
    levels = [([], ["ch"]), (["ch"], ["bucket"]), (["ch", "bucket"], ["sku"])]
    done, by = months, ["mo"]
    for above, keys in levels:
        weights = products.groupBy(*above, *keys).agg(F.sum("weight").cast(WHOLE).alias("weight"))
        targets = done.withColumnRenamed("cents", "target")
        cells = targets.join(weights, above) if above else weights.withColumn(
            "mo", F.explode(F.sequence(F.lit(1), F.lit(12)))).join(targets, "mo")
        done = apportion(cells, [*by], keys)
        by = [*by, *keys]
    return done.select(F.lit(year).alias("yr"), "mo", "ch", "sku",
                       (F.col("cents") * F.lit(Decimal("0.01"))).cast("decimal(38,2)").alias("amount"))

"""Marts: enriched sales (M1), monthly cube (M2), collections (M3), KPI mart (M4/M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.functions.dates import month_key, month_parts, month_of, quarter_of, year_month, year_of
from closebook.functions.numeric import agg_exact, dround, pct, rnd

CUBE_KEYS = ["ym", "yr", "mo", "ch", "cat"]


def sales_mart(fact: DataFrame, products: DataFrame | None = None,
               channels: DataFrame | None = None) -> DataFrame:
    """M1: sales lines LEFT JOIN product (sku) LEFT JOIN channel (channel_id).

    Unknown SKUs / channels keep their line with NULL labels (left joins).
    Adds the month key, calendar parts, gross margin and margin rate (2 dp).
    When the fact carries no cost, cost = qty * product unit cost. A dimension
    left out (``None``) is not joined at all: reports that need neither
    category nor cost, or no channel, skip those joins.
    """
    df = fact
    if products is not None:
        prod = products
        if "cost" in fact.columns and "unit_cost" in prod.columns:
            prod = prod.drop("unit_cost")
        df = df.join(prod, "sku", "left")
    if channels is not None:
        df = df.join(channels, "channel_id", "left")
    if "cost" not in df.columns and "unit_cost" in df.columns:
        df = df.withColumn("cost", F.col("qty") * F.col("unit_cost"))
    keys = [c for c in fact.columns
            if c not in ("order_date", "sku", "channel_id", "ch", "qty", "revenue", "cost")]
    labels = [c for c in ("cat", "collection", "ch") if c in df.columns]
    money = [F.col("revenue")]
    if "cost" in df.columns:
        margin = F.col("revenue") - F.col("cost")
        money += [F.col("cost"), margin.alias("margin"),
                  pct(margin, F.col("revenue"), 2).alias("margin_pc")]
    return df.select(
        *keys, "order_date",
        year_month("order_date").alias("ym"), year_of("order_date").alias("yr"),
        month_of("order_date").alias("mo"), quarter_of("order_date").alias("qtr"),
        "sku", *labels, "qty", *money)


def monthly_cube(mart: DataFrame) -> DataFrame:
    """M2: SUM qty / revenue / cost / margin by (ym, yr, mo, ch, cat), margin % at 2 dp.

    Money sums are exact DECIMAL(28,4) (see ``functions.numeric``); being
    exact, the margin sum equals revenue sum - cost sum, so it is derived
    instead of aggregated a third time.

    Lines are collapsed per task (map-side) to at most months x channels x
    categories rows before any exchange, so hot keys never reach a shuffle as
    raw rows; money is summed with ``agg_exact``. Lines are grouped on the month-start
    date; the 'yyyy-MM' label is formatted on the aggregated rows only.
    """
    agg = agg_exact(mart, [month_key("order_date").alias("_m"), "ch", "cat"],
                    qty=("sum", "qty"), revenue=("money", "revenue"), cost=("money", "cost"))
    return agg.select(*month_parts("_m"), "ch", "cat", "qty", "revenue", "cost",
                      (F.col("revenue") - F.col("cost")).alias("margin"),
                      pct(F.col("revenue") - F.col("cost"), F.col("revenue"), 2).alias("margin_pc"))


def collections_mart(collections: DataFrame, order_lookup: DataFrame | None) -> DataFrame:
    """M3: collections LEFT JOIN the order -> channel lookup; month key of the order date.

    Both sides are large; the join is a sort-merge (or shuffled hash) join on
    ``order_id``. When the collections were built by a join on the same key
    the left side is already hash-partitioned and is not shuffled again.
    ``order_lookup=None``: the collections carry their channel already.
    """
    joined = collections if order_lookup is None else collections.join(order_lookup, "order_id", "left")
    return joined.withColumn("ym", year_month("order_date"))


def kpi_mart(cube: DataFrame, budget: DataFrame, year: int) -> DataFrame:
    """M4: monthly cube LEFT JOIN revenue budget on (mo, ch, cat).

    The budget key has no year: budget columns are masked to NULL for every
    year other than ``year``. ``budget`` is V1's output (mo, ch, cat,
    budget_revenue, budget_margin); it is a post-aggregate table, so AQE
    broadcasts it from its measured size.
    """
    b = budget.select("mo", "ch", "cat", "budget_revenue", "budget_margin")
    j = cube.join(b, ["mo", "ch", "cat"], "left")
    in_year = F.col("yr") == F.lit(year)
    var = F.col("revenue") - F.col("budget_revenue")
    return j.select(
        "ym", "yr", "mo", "ch", "cat", "qty",
        dround("revenue", 0).alias("revenue"), dround("cost", 0).alias("cost"),
        dround("margin", 0).alias("margin"),
        pct(F.col("margin"), F.col("revenue"), 1).alias("margin_pc"),
        F.when(in_year, rnd("budget_revenue", 0)).alias("budget_revenue"),
        F.when(in_year, rnd("budget_margin", 0)).alias("budget_margin"),
        F.when(in_year, rnd(var, 0)).alias("var_revenue"),
        F.when(in_year, pct(var, F.col("budget_revenue"), 1)).alias("var_pc")
    ).orderBy(*[F.col(c).asc_nulls_last() for c in ["ym", "ch", "cat"]])


def kpi_mart_preview(kpi: DataFrame, n: int = 10) -> DataFrame:
    """M5: first ``n`` rows of the KPI mart in key order (a top-k, not a scan cap)."""
    return kpi.orderBy(*[F.col(c).asc_nulls_last() for c in ["ym", "ch", "cat"]]).limit(n)


"""Drift detection with a trailing z-score.

The baseline of a month is the mean and sample standard deviation of the
previous ``window`` rows of its series (the current row excluded). Windows
are positional (ROWS frames): a missing month shifts the baseline, as in the
reference. They run on the monthly aggregate: one row per month per series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions import constants as K
from closebook.functions.dates import month_key
from closebook.functions.numeric import agg_exact, dround, pct, rnd, safe_div


def charges_monthly(charges: DataFrame) -> DataFrame:
    """A1: SUM of charges by (month, cost centre, nature)."""
    agg = agg_exact(charges, [month_key("charge_date").alias("_m"), "cc_id", "nature"],
                    amount=("money", "amount"))
    return agg.select(F.date_format("_m", "yyyy-MM").alias("ym"), "cc_id", "nature", "amount")


def trailing_baseline(df: DataFrame, keys: list[str], order: str, value: str,
                      window: int = 12) -> DataFrame:
    """A2 / generic: mean and stddev_samp over ROWS ``window`` PRECEDING .. 1 PRECEDING.

    Statistics are computed in DOUBLE. Both aggregates share one window spec,
    so Spark sorts each partition once.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-window, -1)
    x = F.col(value).cast("double")
    return df.select("*", F.avg(x).over(w).alias("mean12"),
                     F.stddev_samp(x).over(w).alias("std12"))


def severity(z: Column, labels: dict[str, str] = K.SEVERITY_LABELS) -> Column:
    return (F.when(F.abs(z) > F.lit(K.Z_MAJOR), F.lit(labels["major"]))
             .when(F.abs(z) > F.lit(K.Z_SIGNIFICANT), F.lit(labels["significant"]))
             .otherwise(F.lit(labels["normal"])))


def zscore(df: DataFrame, keys: list[str], order: str, value: str,
           window: int = 12) -> DataFrame:
    """Generic trailing z-score: adds mean12, std12 and z = (x - mean) / NULLIF(std, 0)."""
    b = trailing_baseline(df, keys, order, value, window)
    return b.withColumn("z", safe_div(F.col(value) - F.col("mean12"), F.col("std12")))


def charge_zscores(monthly: DataFrame, cost_centres: DataFrame, window: int = 12) -> DataFrame:
    """A3: z-score and severity per (month, cost centre, nature) with the cost-centre label.

    The label join is a LEFT JOIN USING (cc_id) against the cost-centre
    dimension; AQE broadcasts it when its measured size allows.
    """
    z = zscore(monthly, ["cc_id", "nature"], "ym", "amount", window)
    z = z.join(cost_centres.select("cc_id", "cc_name"), "cc_id", "left")
    return z.select(
        "ym", "cc_id", "cc_name", "nature",
        dround("amount", 0).alias("amount"), rnd("mean12", 0).alias("mean"),
        rnd(F.col("amount") - F.col("mean12"), 0).alias("var_value"),
        pct(F.col("amount") - F.col("mean12"), F.col("mean12"), 1).alias("var_pc"),
        rnd("z", 2).alias("z"), severity(F.col("z")).alias("severity"),
        F.col("mean12").alias("_mean"), F.col("z").alias("_z"))


def charge_alerts(zs: DataFrame, top: int = 20, with_status: bool = True) -> DataFrame:
    """A4: alerts (baseline present and |z| > 2), latest month first, largest |z| first.

    A top-k report: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge). Ties are broken by cost centre
    and nature so the cut is deterministic.
    """
    a = zs.filter(F.col("_mean").isNotNull() & (F.abs(F.col("_z")) > F.lit(K.Z_SIGNIFICANT)))
    cols = ["ym", "cc_id", "cc_name", "nature", "amount", "mean"]
    cols += ["var_value", "var_pc", "z", "severity"] if with_status else ["var_pc", "z"]
    return (a.orderBy(F.col("ym").desc(), F.abs(F.col("z")).desc(), F.col("cc_id"), F.col("nature"))
             .limit(top).select(*cols))


def revenue_zscores(cube: DataFrame, window: int = 12) -> DataFrame:
    """X5 (extension): the same trailing z-score on the revenue of each channel x category."""
    z = zscore(cube.select("ym", "ch", "cat", "revenue"), ["ch", "cat"], "ym", "revenue", window)
    return z.select("ym", "ch", "cat", dround("revenue", 0).alias("revenue"),
                    rnd("mean12", 0).alias("mean"), rnd("z", 2).alias("z"),
                    severity(F.col("z")).alias("severity"))

"""M2, incremental: the monthly cube from stored partial sums, refreshed month by month.

Partials are exact sums (DECIMAL money) per month, channel and category, in
folders ``month=yyyy-MM/batch=<name>``. Sums of disjoint sets of lines add up,
so late lines are one more batch of the months they belong to, written with
dynamic partition overwrite: only folders that the batch has rows for are
replaced, a batch written twice replaces itself, and no other file is touched.
Corrections of lines that were counted before recompute their months from the
lines. The cube is the sum over the batches, a few rows a cell.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions.dates import month_key
from closebook.functions.numeric import agg_exact, pct
from closebook.sources import storage

BASE = "base"
NO_MONTH = "none"
_SCHEMA = ("_m date, ch string, cat string, qty double, revenue decimal(38,4), cost decimal(38,4), month string, batch string")


def partials(mart: DataFrame) -> DataFrame:
    """Exact sums per (month start, channel, category); NULL months and labels are cells of their own."""
    return agg_exact(mart, [month_key("order_date").alias("_m"), "ch", "cat"],
                     qty=("sum", "qty"), revenue=("money", "revenue"), cost=("money", "cost"))


def add_lines(mart: DataFrame, path: str, batch: str = BASE) -> None:
    """Store the partials of ``mart``'s lines as ``batch``; lines of no other batch may be among them."""
    month = F.coalesce(F.date_format("_m", "yyyy-MM"), F.lit(NO_MONTH))
    (partials(mart).withColumn("qty", F.col("qty").cast("double")).withColumn("month", month).withColumn("batch", F.lit(batch))
     .repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch").parquet(path))


def _in_month(month: str) -> Column:
    if month == NO_MONTH:
        return F.col("order_date").isNull()
    start = F.lit(f"{month}-01").cast("date")
    return (F.col("order_date") >= start) & (F.col("order_date") < F.add_months(start, 1))


def recompute_months(mart: DataFrame, path: str, months: Iterable[str]) -> None:
    """Rebuild these months ('yyyy-MM', or ``none``) from all lines ``mart``, as their only batch.

    Their old folders go first, so a job that dies leaves them missing, not
    counted twice; running it again completes it. A month without lines stays
    out. The date ranges reach the scan.
    """
    spark, months = mart.sparkSession, sorted(set(months))
    if not months:
        return
    for month in months:
        storage.remove(spark, f"{path.rstrip('/')}/month={month}")
    add_lines(mart.filter(reduce(Column.__or__, map(_in_month, months))), path)


def cube_from_partials(spark: SparkSession, path: str) -> DataFrame:
    """The monthly cube (as ``marts.monthly_cube``) of all batches."""
    stored = spark.read.schema(_SCHEMA).parquet(path)
    total = stored.groupBy("_m", "ch", "cat").agg(
        F.sum("qty").alias("qty"), *(F.sum(c).cast("decimal(38,4)").alias(c) for c in ("revenue", "cost")))
    margin = F.col("revenue") - F.col("cost")
    return total.select(F.date_format("_m", "yyyy-MM").alias("ym"), F.year("_m").alias("yr"), F.month("_m").alias("mo"),
                        "ch", "cat", "qty", "revenue", "cost", margin.alias("margin"),
                        pct(margin, F.col("revenue"), 2).alias("margin_pc"))

"""Calendar-exact monthly series: gap filling and frames by month distance (extension of R2-R4, A2).

The reports' windows count rows, so a closed month shifts "12 months ago" to
13. Here a series gets a row for every month between its own first and last
one, and frames are RANGE frames over a month index, so a month is compared
with the month that lies that far back or with nothing.

Filling needs no calendar join and no cross join: each row stands for the
months up to the next row of its series (a bounded ``sequence``), with one
window over the monthly aggregate, whose partitioning the frames use again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions.numeric import rnd
from closebook.operators.receivables import dso_monthly

MONTH = "month"


def with_month(df: DataFrame, ym: str = "ym") -> DataFrame:
    """Adds the month as its first day; rows without a month belong to no calendar and go."""
    return df.filter(F.col(ym).isNotNull()).withColumn(MONTH, F.to_date(F.concat(F.col(ym), F.lit("-01"))))


def fill_months(monthly: DataFrame, keys: list[str], values: dict[str, Column | None]) -> DataFrame:
    """A row for every month from a series' first to its last; added rows have ``filled`` and the given values.

    ``monthly``: keys, ``month`` (first days, one row a month and series; null
    keys are a series too) and the columns of ``values`` (None: NULL in added
    rows). Columns not named are dropped.
    """
    following = F.lead(MONTH).over(Window.partitionBy(*keys).orderBy(MONTH))
    until = F.greatest(F.col(MONTH), F.coalesce(F.add_months("_next", -1), F.col(MONTH)))
    spread = monthly.withColumn("_next", following).withColumn(
        "_m", F.explode(F.sequence(F.col(MONTH), until, F.expr("INTERVAL 1 MONTH"))))
    filled = F.col("_m") != F.col(MONTH)
    types = dict(monthly.dtypes)
    kept = [F.when(filled, F.lit(None) if v is None else v).otherwise(F.col(c)).cast(types[c]).alias(c) for c, v in values.items()]
    return spread.select(*keys, F.col("_m").alias(MONTH), F.date_format("_m", "yyyy-MM").alias("ym"), filled.alias("filled"), *kept)


def month_index() -> Column:
    return F.year(MONTH) * 12 + F.month(MONTH)


def months_back(keys: list[str], first: int, last: int) -> Window:
    """The frame from ``first`` to ``last`` months before the current month (0: itself)."""
    return Window.partitionBy(*keys).orderBy(month_index()).rangeBetween(-first, -last)


def value_months_ago(column: str, keys: list[str], months: int) -> Column:
    """The value of the month that lies exactly so far back, NULL without one."""
    return F.max(column).over(months_back(keys, months, months))


def dso_report_dense(cmart: DataFrame) -> DataFrame:
    """R2-R4 by the calendar: DSO, average of three calendar months, change to last month and to the same month last year.

    A month without invoices has a row with NULL figures; averages leave it out.
    """
    keys = ["ch"]
    dense = fill_months(with_month(dso_monthly(cmart)), keys, {"dso_days": None})
    return dense.select(
        "ym", "ch", "filled", "dso_days", rnd(F.avg("dso_days").over(months_back(keys, 2, 0)), 1).alias("dso_avg3"),
        (F.col("dso_days") - value_months_ago("dso_days", keys, 1)).alias("mom"),
        rnd(F.col("dso_days") - value_months_ago("dso_days", keys, 12), 1).alias("yoy")).orderBy(
            F.col("ch").asc_nulls_last(), "ym")


def baseline_dense(monthly: DataFrame, keys: list[str], value: str, months: int = 12) -> DataFrame:
    """A2 by the calendar: mean and deviation of the ``months`` calendar months before; a month without a booking counts as 0."""
    dense = fill_months(with_month(monthly), keys, {value: F.lit(0)})
    frame, x = months_back(keys, months, 1), F.col(value).cast("double")
    return dense.select("ym", *keys, "filled", value, F.avg(x).over(frame).alias("mean12"), F.stddev_samp(x).over(frame).alias("std12"))

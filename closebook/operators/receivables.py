"""Receivables: collection delays and DSO with window functions.

All windows run on the (month x channel) aggregate, never on raw lines, so
each window partition holds one row per month of one channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.functions import constants as K
from closebook.functions.dates import month_key
from closebook.functions.numeric import agg_exact, rnd, thousands


def collection_delay(df: DataFrame, raw_delay: str = "raw_delay") -> DataFrame:
    """Delay clipped at >= 0 days; settlement date = order date + delay."""
    delay = F.greatest(F.col(raw_delay), F.lit(0))
    return (df.withColumn("delay_days", delay.cast("int"))
              .withColumn("settle_date", F.date_add(F.col("order_date"), F.col("delay_days")))
              .drop(raw_delay))


def dso_monthly(cmart: DataFrame) -> DataFrame:
    """Per (month, channel): invoices, DSO (avg delay, 1 dp), collected amount (k, 0 dp).

    The month key is the order month ('yyyy-MM' of the order date, NULL dates
    excluded); lines are grouped on the month-start date and labelled after.
    """
    agg = agg_exact(cmart.filter(F.col("order_date").isNotNull()),
                    [month_key("order_date").alias("_m"), "ch"],
                    n=("count", None), _dsum=("sum", F.col("delay_days").cast("long")),
                    _dn=("count", "delay_days"), amount=("money", "amount"))
    avg_delay = F.col("_dsum") / F.nullif(F.col("_dn"), F.lit(0))
    return agg.select(F.date_format("_m", "yyyy-MM").alias("ym"), "ch", "n",
                      rnd(avg_delay, 1).alias("dso_days"),
                      thousands(F.col("amount"), 0).alias("collected_k"), "amount")


def _w(frame=None):
    w = Window.partitionBy("ch").orderBy("ym")
    return w if frame is None else w.rowsBetween(*frame)


def dso_report(cmart: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """R1-R5 in one pass: moving average over the *rounded* DSO (rows -2..0),
    month-over-month change (unrounded), positional year-over-year change
    (LAG 12 rows, rounded) and the per-channel threshold alert.

    The three windows share one partition/order spec, so Spark sorts once.
    """
    d = dso_monthly(cmart)
    out = d.select(
        "ym", "ch", "n", "dso_days", "collected_k", "amount",
        rnd(F.avg("dso_days").over(_w((-2, 0))), 1).alias("dso_avg3"),
        (F.col("dso_days") - F.lag("dso_days", 1).over(_w())).alias("mom"),
        rnd(F.col("dso_days") - F.lag("dso_days", 12).over(_w()), 1).alias("yoy"))
    if rules is not None:
        out = dso_alerts(out, rules)
    return out.orderBy(F.col("ch").asc_nulls_last(), "ym")


def alert_rules(spark: SparkSession, rules=K.DSO_ALERT_RULES) -> DataFrame:
    """Threshold table (ch, threshold, label); a fixed, tiny literal table."""
    schema = T.StructType([T.StructField("ch", T.StringType()),
                           T.StructField("threshold", T.DoubleType()),
                           T.StructField("label", T.StringType())])
    return spark.createDataFrame([(c, float(t), lab) for c, t, lab in rules], schema)


def dso_alerts(dso: DataFrame, rules: DataFrame) -> DataFrame:
    """Alert label when the channel's DSO exceeds its threshold, else NULL.

    Spark broadcasts the rules when their size allows it.
    """
    j = dso.join(rules.select("ch", "threshold", "label"), "ch", "left")
    alert: Column = F.when(F.col("dso_days") > F.col("threshold"), F.col("label"))
    return j.withColumn("alert", alert).drop("threshold", "label")


def dso_channel_check(cmart: DataFrame, channel: str, from_month: str,
                      threshold: float) -> DataFrame:
    """One channel from a month on (string compare on 'yyyy-MM'), breach marker."""
    start = F.lit(f"{from_month}-01").cast("date")
    return (cmart.filter((F.col("ch") == F.lit(channel)) & (F.col("order_date") >= start))
            .groupBy(month_key("order_date").alias("_m"))
            .agg(rnd(F.avg("delay_days"), 1).alias("dso_days"))
            .select(F.date_format("_m", "yyyy-MM").alias("ym"), "dso_days")
            .withColumn("breach", F.col("dso_days") > F.lit(threshold))
            .orderBy("ym"))


def working_capital_impact(dso: DataFrame, days_in_month: float = 30.0) -> DataFrame:
    """X3 (extension): cash tied up by the DSO change = change x average daily collections."""
    return dso.select("ym", "ch", "dso_days", "mom",
                      rnd(F.col("mom") * F.col("amount") / F.lit(days_in_month), 2).alias("impact"))

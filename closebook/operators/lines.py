"""Line-level sequence operators: running-total cutoff (G3) and surrogate keys.

Both need an order over raw lines, and neither sorts the lines in one task:
lines are split into key ranges (buckets or range partitions) whose totals
(a small table, the only thing windowed as a whole) give each range its
offset, and only then are rows numbered or summed inside a range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions.numeric import agg_exact, dec, money
from closebook.session import cut_lineage


def _prefix(df: DataFrame, part: list[str], order: str, total: str, target: Column) -> DataFrame:
    """Add the exact total of the earlier pieces of each ``part`` and the
    piece class: entirely kept (running total stays below the target),
    crossing (holds the first line that reaches it) or entirely dropped."""
    w = Window.partitionBy(*part).orderBy(order)
    before = F.coalesce(F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)), dec(0))
    d = df.select("*", before.alias("_before"), target.alias("_target"))
    full = F.col("_before") + F.col(total) < F.col("_target")
    crossing = (F.col("_before") < F.col("_target")) & ~full
    return d.withColumn("_class", F.when(full, F.lit("full"))
                        .when(crossing, F.lit("crossing")).otherwise(F.lit("after")))


def _same(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL (lines without a month are a group too)."""
    renamed = small.withColumnsRenamed({k: f"_{k}_of" for k in keys})
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}_of")) for k in keys])
    return df.join(renamed, on).drop(*(f"_{k}_of" for k in keys))


def bucket_width(keys: DataFrame, key: str) -> Column:
    """Key-range bucket width ~ key range / sqrt(rows), as a scalar subquery over ``keys``.

    A group then has about sqrt(n) bucket rows (what its first window sorts)
    and a bucket about sqrt(n) / groups lines: both grow with the square root
    of the data, e.g. under 1e6 at 6e11 lines. An empty table gives NULL.
    """
    span = (F.max(key) - F.min(key) + F.lit(1)).cast("double")
    return keys.agg(F.greatest(F.lit(1), F.ceil(span / F.sqrt(F.count(F.lit(1))))).alias("width")).scalar()


def running_cutoff(lines: DataFrame, group: str, order: list[str], value: str,
                   share: float | None = None, target: float | None = None,
                   width: int | None = None, keys: DataFrame | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Per group, keep lines in ``order`` until the running total reaches
    the target (a fixed ``target``, or ``share`` x group total), the crossing
    line included.

    A line is kept when the sum of the values *before* it is below the
    target. Values must be non-negative (monotone running total); they are
    summed exactly (DECIMAL), so the cut does not depend on partitioning.
    ``order`` must be a total order (unique per group); ``order[0]`` numeric.
    A NULL group is a group like any other.

    No group is ever sorted as a whole and no task receives a whole group:
      1. key-range buckets, floor(order[0] / width) (default width from
         ``bucket_width`` over ``keys``, a table with the same keys, or the lines): per
         (group, bucket) totals come from a partial + final aggregate; a window over
         that small table classifies buckets as kept, crossing or dropped. The table is
         checkpointed (small) so every later use sees the same classes. Kept
         buckets count from it; dropped ones are never touched again.
      2. only the crossing bucket of each group goes on. The lines' keys are first
         filtered to the crossing buckets (a semi join on the bucket number, which the
         optimizer moves below the joins that built the lines). They are
         range-partitioned on (group, order) - bounds sampled from
         the full unique order, so even one hot key is split across tasks -,
         checkpointed, partition totals classify the partitions the same way,
         and only the one crossing partition per group is numbered.
    The two checkpoints run when the operator is called.
    Output: (group, kept_rows, kept_value, target).
    """
    spark = lines.sparkSession
    w = F.lit(width) if width is not None else bucket_width(lines if keys is None else keys, order[0])
    src = lines.select(group, *order, value).withColumn("_b", F.floor(F.col(order[0]) / w))
    bt = agg_exact(src, [group, "_b"], _t=("money", value), _n=("count", None))
    tgt = (dec(target) if target is not None
           else F.sum("_t").over(Window.partitionBy(group)) * dec(share))
    bt = cut_lineage(_prefix(bt, [group], "_b", "_t", tgt))

    def kept(df: DataFrame, rows_col: str, val_col: str) -> DataFrame:
        return (df.filter(F.col("_class") == "full").groupBy(group)
                  .agg(F.sum(rows_col).alias("_rows"), F.sum(val_col).alias("_val")))

    whole = bt.groupBy(group).agg(F.max("_target").alias("target"))
    cross_b = bt.filter(F.col("_class") == "crossing").select(group, "_b", "_before", "_target")
    near = src.join(cross_b.select("_b").distinct(), "_b", "left_semi").withColumn(value, money(value))
    rows = _same(near, cross_b, [group, "_b"])
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(rows.repartitionByRange(n, group, *order)
                           .withColumn("_p", F.spark_partition_id()))
    pt = (rows.groupBy(group, "_p")
              .agg(F.sum(value).alias("_t"), F.count(F.lit(1)).alias("_n"),
                   F.first("_before").alias("_b0"), F.first("_target").alias("_tg")))
    pt = _prefix(pt, [group], "_p", "_t", F.col("_tg") - F.col("_b0"))
    cross_p = pt.filter(F.col("_class") == "crossing").select(
        group, "_p", (F.col("_b0") + F.col("_before")).alias("_off"))
    last = _same(rows.drop("_before"), cross_p, [group, "_p"])
    wr = (Window.partitionBy(group, "_p").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, -1))
    run = F.col("_off") + F.coalesce(F.sum(value).over(wr), dec(0))
    parts = [kept(bt, "_n", "_t"), kept(pt, "_n", "_t"),
             last.withColumn("_run", run).filter(F.col("_run") < F.col("_target"))
                 .groupBy(group).agg(F.count(F.lit(1)).alias("_rows"), F.sum(value).alias("_val"))]
    agg = reduce(DataFrame.unionByName, parts).groupBy(group).agg(
        F.sum("_rows").alias("_rows"), F.sum("_val").alias("_val")).withColumnRenamed(group, "_of")
    res = whole.join(agg, F.col(group).eqNullSafe(F.col("_of")), "left")
    return res.select(group, F.coalesce(F.col("_rows"), F.lit(0)).cast("long").alias("kept_rows"),
                      F.coalesce(F.col("_val"), dec(0)).alias("kept_value"), "target")


def surrogate_keys(df: DataFrame, key: str | list[str], fmt: str, partitions: int | None = None) -> DataFrame:
    """Sequential codes (``fmt`` % position, 1-based) in the order of one or more key columns.

    Range-partition and sort by key, tag every row with its partition and
    its monotonically increasing id, checkpoint (so every use sees the same
    rows even after an executor loss; this job runs when the operator is
    called), then turn per-partition counts - one row per partition, a table
    bounded by the partition count - into offsets. ``key`` must be unique.
    """
    spark = df.sparkSession
    key = [key] if isinstance(key, str) else key
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.select(*key).repartitionByRange(n, *key).sortWithinPartitions(*key)
           .select(*key, F.spark_partition_id().alias("_p"),
                   F.monotonically_increasing_id().alias("_id")))
    s = cut_lineage(s)
    counts = s.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_p", "_first", F.coalesce(before, F.lit(0)).alias("_off"))
    pos: Column = F.col("_off") + (F.col("_id") - F.col("_first")) + F.lit(1)
    return (s.join(F.broadcast(offsets), "_p")
             .select(*key, F.format_string(fmt, pos).alias("code")))


def stable_keys(known: DataFrame | None, df: DataFrame, key: str | list[str], fmt: str) -> DataFrame:
    """G13 over reloads: (key columns, seq, code); keys that ``known`` (key columns, seq) holds keep their position.

    Keys that are new - found by an anti-join, repeated rows count once - are
    numbered in key order after the last position given out; keys that are gone
    keep theirs, so no code is ever used again. Store the result and pass it as
    ``known`` next time. Key columns must not be NULL.
    """
    key = [key] if isinstance(key, str) else key
    fresh, last = df.select(*key).distinct(), 0
    if known is not None:
        fresh = fresh.join(known.select(*key), key, "left_anti")
        last = known.agg(F.max("seq")).first()[0] or 0
    numbered = surrogate_keys(fresh, key, "%d").select(*key, (F.col("code").cast("long") + F.lit(last)).alias("seq"))
    whole = numbered if known is None else known.select(*key, "seq").unionByName(numbered)
    return whole.withColumn("code", F.format_string(fmt, F.col("seq")))

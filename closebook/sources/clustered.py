"""S2 for slices on any axis: a fact written along a Z-order curve.

Month folders serve date slices only. Here each axis is cut into ranges of its
own values, the ranges' numbers are interleaved bit by bit, and the rows are
range-partitioned and sorted on the result. Every file and row group then
covers a small range of *each* axis, and the min/max statistics in the Parquet
footers let a slice on date, channel, product or several of them skip most of
the file. The layout changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
MAX_BITS = 10  # an axis has at most 1023 bounds: collected, and literals of one expression
ROW_GROUP = 32 * 1024 * 1024


def axis_bounds(df: DataFrame, axis: str, bits: int = BITS) -> list:
    """At most ``2 ** bits - 1`` ascending values that cut the axis' distinct values into ranges of like number.

    The distinct values (partial aggregation: a hot value travels once a task) are
    range-partitioned, and only the least value of each range is collected.
    """
    if not 1 <= bits <= MAX_BITS:
        raise ValueError(f"bits: 1 to {MAX_BITS}")
    values = df.filter(F.col(axis).isNotNull()).select(F.col(axis).alias("v")).distinct()
    least = (values.repartitionByRange(2 ** bits, "v").groupBy(F.spark_partition_id().alias("range"))
             .agg(F.min("v").alias("v")).select("v"))
    return sorted(r.v for r in least.collect())[1:]


def _spread(number: int, at: int, axes: int, bits: int) -> int:
    """The bits of ``number``, ``axes`` places apart, from place ``at`` on."""
    return sum((number >> b & 1) << (b * axes + at) for b in range(bits))


def _place(c: Column, bounds: list, at: int, axes: int, bits: int) -> Column:
    """The spread number of the range ``c`` falls into, by halving the bounds (null: the first range).

    Numbers are stretched over all ``bits``, so an axis of few values weighs as much as the others.
    """
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(_spread(lo * 2 ** bits // (len(bounds) + 1), at, axes, bits)).cast("long")
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(bounds[mid]), among(mid + 1, hi)).otherwise(among(lo, mid))
    return F.when(c.isNull(), F.lit(0).cast("long")).otherwise(among(0, len(bounds)))


def z_value(df: DataFrame, axes: tuple[str, ...], bits: int = BITS) -> Column:
    """The place of a row of ``df`` on the Z-order curve over ``axes``."""
    if bits * len(axes) > 62:
        raise ValueError("bits times axes: at most 62")
    places = [_place(F.col(a), axis_bounds(df, a, bits), i, len(axes), bits) for i, a in enumerate(axes)]
    return sum(places[1:], places[0])


def write_clustered(df: DataFrame, path: str, axes: tuple[str, ...], bits: int = BITS, files: int | None = None,
                    row_group: int = ROW_GROUP) -> None:
    """Write ``df`` as Parquet along the Z-order curve over ``axes`` (overwritten, same columns).

    Spark samples the ranges of the files, so they hold like numbers of rows; a cell of the
    curve that holds much of the data is cut further by the axes and then by a hash of the row.
    ``files``: their number; without it, adaptive execution makes files of the advisory size.
    """
    columns = df.columns
    placed = df.withColumn("_z", z_value(df, axes, bits)).withColumn("_row", F.xxhash64(*(F.col(c) for c in columns)))
    keys = ["_z", *axes, "_row"]
    dealt = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    (dealt.sortWithinPartitions("_z", *axes).select(*columns)
     .write.mode("overwrite").option("parquet.block.size", row_group).parquet(path))

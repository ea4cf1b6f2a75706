"""Operator 9: reproducible shuffle and shards by a Feistel permutation (DataFrame functions only).

Rows get global row numbers in the order of their ids without a global sort:
the slim rows are dealt by range, written once, numbered inside each range
partition and shifted by the partition's offset. A Feistel network over
``Z_a x Z_b`` with ``a * b`` just above the row count permutes the numbers;
the few values beyond the count walk on along their cycle. Position ``p`` goes
to shard ``p mod shards``, slot ``p div shards``, so anyone who knows the row
count and the seed can compute where a row number went.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize

ROUNDS = 4
WALK = 64  # steps of the cycle walk; see feistel()


def row_numbers(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """``df`` with 0, 1, 2, ... in the order of the columns ``order``.

    Rows equal in all of ``order`` are numbered in any order; a random extra
    key splits them over range partitions, so a key with very many rows does
    not land in one task. The table written holds all columns of ``df``; pass
    slim rows. The window runs over one row a partition.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = (df.withColumn("spread", spread).repartitionByRange(*keys, "spread")
              .sortWithinPartitions(*keys, "spread").drop("spread")
              .withColumn("part", F.spark_partition_id())
              .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = materialize(ranged, "ranges")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return ranged.join(offsets, "part").withColumn(name, F.col("offset") + F.col("at")).drop("part", "at", "offset")


def feistel(number: Column, count: int, seed: int) -> Column:
    """Position of row ``number`` (0 <= number < count) in the shuffle named by ``seed``.

    A value leaves the range with a chance below ``1 / sqrt(count)`` a step and
    at most ``a - 1`` values lie beyond it, so 64 steps always do for counts up
    to 4096 and beyond all odds above; a row that still walked would raise.
    """
    a = max(1, math.isqrt(count))
    a += a * a < count
    b = max(1, -(-count // a))

    def step(x: Column) -> Column:
        left = F.pmod(x, F.lit(a))
        right = ((x - left) / F.lit(a)).cast("long")
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(i)), F.lit(a)), F.lit(a))
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(i)), F.lit(b)), F.lit(b))
        return right * F.lit(a) + left

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(number),
                       lambda x, _: F.when(x < count, x).otherwise(step(x)))
    return F.when(walk < count, walk).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))


def assign_shards(docs: DataFrame, shards: int = 40, seed: int = 20, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number of every row.

    Law ``rows``: shards hold equally many rows, at most one apart; slots of a
    shard run from 0 without gaps; ``grown_shard`` is null. ``size``: UTF-8
    bytes of the text (null: none) plus 16. ``text_crc32``: CRC-32 of those
    bytes, unsigned (null text: 0, as of no bytes). The result depends on the
    rows alone, not on their files or partitions: rows are numbered by doc_id
    (null first), size and crc, and rows equal in those are interchangeable.
    Repeated rows get slots each. An empty table gives an empty result. Other
    columns are not read.
    """
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    slim = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    numbered = row_numbers(slim, ["doc_id", "size", "text_crc32"])
    count = numbered.count()
    at = feistel(F.col("row_number"), count, seed)
    return numbered.withColumn("at", at).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("at", F.lit(shards)).cast("int").alias("shard"),
        ((F.col("at") - F.pmod("at", F.lit(shards))) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")

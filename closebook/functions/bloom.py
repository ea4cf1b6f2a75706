"""Semi-join reduction: a Bloom filter built as an aggregate and probed in a scan.

Spark's own runtime filter is off for large build sides; here the number of
bits is a parameter. The filter is a scalar subquery (an array of ``bits / 64``
longs), made once per job by partial aggregation (``bit_or`` of words) and
probed by built-in expressions next to the scan, so rows without a partner are
not shuffled. It passes every row that has a partner and a few others, so the
join that follows stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20
MAX_BITS = 1 << 27  # 16 MB of words: what a driver and every task may hold


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.bitwiseAND(F.lit(63)).cast("int"))


def _word(position: Column) -> Column:
    return F.shiftright(position, 6).cast("int")


def bloom_filter(keys: DataFrame, key: str, bits: int = BITS, hashes: int = 3) -> Column:
    """The filter over the non-null values of ``key``, as a scalar subquery."""
    if bits % 64 or not 64 <= bits <= MAX_BITS:
        raise ValueError(f"bits: a multiple of 64 up to {MAX_BITS}")
    at = keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits, hashes))).alias("at"))
    words = at.groupBy(_word(F.col("at")).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("set"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("set"))
    dense = words.unionByName(every).groupBy("word").agg(F.bit_or("set").alias("set"))
    listed = F.array_sort(F.collect_list(F.struct("word", "set")))
    return dense.agg(F.transform(listed, lambda w: w["set"]).alias("words")).scalar()


def may_contain(words: Column, key: Column, bits: int = BITS, hashes: int = 3) -> Column:
    """False only for keys that are not in the filter (null keys are not)."""
    found = key.isNotNull()
    for at in _positions(key, bits, hashes):
        found = found & (F.get(words, _word(at)).bitwiseAND(_bit(at)) != 0)
    return found


def reduce_by_keys(rows: DataFrame, key: str, keys: DataFrame, other: str, bits: int = BITS, hashes: int = 3) -> DataFrame:
    """``rows`` without those whose ``key`` cannot be among ``keys[other]``.

    With ``hashes`` = 3 and n keys a row without a partner passes with a chance
    of (1 - exp(-3 n / bits)) ** 3: 1 % at 12 bits a key, 5 % at 7. Give about
    10 bits a key; past ``MAX_BITS / 2`` keys a filter of this kind saves nothing
    and the plain join should be used.
    """
    return rows.filter(may_contain(bloom_filter(keys, other, bits, hashes), F.col(key), bits, hashes))

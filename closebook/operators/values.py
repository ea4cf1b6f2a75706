"""P6 without a shuffle of the lines: which values of a dimension occur among the facts.

A filter list needs to know that a value has a line, not which lines it has.
A few keys of each value are looked up in the facts (a broadcast of proven
size, no shuffle); a value none of whose keys is found is decided by the
join, on its own keys only. The answer is exact either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.functions.bloom import reduce_by_keys

MAX_VALUES = 10_000  # a list to choose from; also bounds what is broadcast and collected
KEYS = 16


def values_in_use(dim: DataFrame, key: str, value: str, facts: DataFrame, fact_key: str,
                  keys_a_value: int = KEYS, max_values: int = MAX_VALUES) -> DataFrame:
    """The distinct non-null ``dim[value]`` that a fact refers to, as rows of one column ``value``.

    More than ``max_values`` values raise. Facts without a partner in ``dim`` and null
    keys count for no value. Runs a job over ``dim`` and one over the facts' key column
    when called, and a join for the values not found so.
    """
    known = dim.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value"))
    slot = F.pmod(F.xxhash64("key"), F.lit(keys_a_value))
    some = known.groupBy("value", slot.alias("slot")).agg(F.min("key").alias("key")).select("value", "key")
    kept = some.limit(max_values * keys_a_value + 1).collect()  # bounded; the next lines check the bound
    candidates = {r.value for r in kept}
    if len(candidates) > max_values or len(kept) > max_values * keys_a_value:
        raise ValueError(f"{value}: more than {max_values} values")
    spark, schema = dim.sparkSession, some.schema
    lookup = F.broadcast(spark.createDataFrame(kept, schema))  # at most max_values * keys_a_value rows
    lines = facts.select(F.col(fact_key).alias("fact"))
    found = {r.value for r in lines.join(lookup, F.col("fact") == F.col("key")).select("value").distinct().collect()}
    shown = spark.createDataFrame([(v,) for v in found], f"value {schema['value'].dataType.simpleString()}")
    rest = sorted(candidates - found)
    if not rest:
        return shown
    open_keys = known.filter(F.col("value").isin(rest))
    return shown.unionByName(
        open_keys.join(reduce_by_keys(lines, "fact", open_keys, "key"), F.col("key") == F.col("fact"), "left_semi")
        .select("value").distinct())

"""Bounded, reproducible samples of labelled rows for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


MAX_CLASSES = 100_000  # classes whose counts may be broadcast


def id_fold(col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % folds


def sample_by_class(df: DataFrame, label: str, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows of each value of ``label``, those first by a hash of ``key``.

    The classes are counted first, and a class thinned by hash to about twice
    ``rows`` before it is ranked, so that no window holds a whole class. Rows
    are thinned where they are read: the counts are broadcast (more than
    ``MAX_CLASSES`` classes raise), so no row of a class is dealt by its label
    but those of the sample. A class whose thinned sample is short by chance
    stays short.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("class_rows"))
    classes = counts.count()
    if classes > MAX_CLASSES:
        raise ValueError(f"{classes} classes; a sample by class takes {MAX_CLASSES} at most")
    spread = F.pmod(F.xxhash64(key, F.lit(10)), F.lit(1 << 30))
    thin = (df.withColumn("spread", spread).join(F.broadcast(counts), label)
            .filter(F.col("spread") / F.lit(float(1 << 30)) * F.col("class_rows") <= 2 * rows + 20))
    first = W.partitionBy(label).orderBy("spread", key)
    return thin.withColumn("turn", F.row_number().over(first)).filter(F.col("turn") <= rows).drop("class_rows")

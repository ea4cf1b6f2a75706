"""Operator 3: mixing sources to target weights (DataFrame functions only).

A source's target is met by whole copies of all its documents plus one more
copy of those whose hash lies below a cut. The cut comes from histograms, not
from a sort: words are summed by source and by the leading digits of the hash,
the digit at which the running sum crosses the budget is found, and only the
documents of that boundary bucket are summed by their next digits, until the
digits are used up. Then one filter on the hash takes the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, packed

WORD = r"[^\x20\x09-\x0D]+"
DIGITS, LEVELS = 3, 5  # hexadecimal digits a level: 4096 buckets; 60 bits in all
BUCKETS = 16 ** DIGITS
HEAD = 9  # hexadecimal digits of the hash that come from id and text


def document_hash(carried: list[Column], id_col: str = "doc_id", text_col: str = "text") -> Column:
    """60 bits: 36 of an MD5 of id and text, 24 of ``carried``, the columns a result shows.

    Rows of one hash are thus equal in what the result shows, and which of
    them is taken makes no difference to it.
    """
    text, name = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("string")
    named = F.coalesce(F.concat(F.length(name), F.lit(":"), name, text), F.concat(F.lit("t"), text))
    first = F.conv(F.substring(F.md5(named.cast("binary")), 1, HEAD), 16, 10).cast("long")
    rest = 16 ** (DIGITS * LEVELS - HEAD)
    return first * rest + F.pmod(F.xxhash64(*carried), F.lit(rest))


def _comparable(docs: DataFrame) -> list[Column]:
    """All columns of ``docs`` in a form that can be hashed (maps as JSON)."""
    return [F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name]
            for f in docs.schema.fields]


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target of each source from (source, size) rows.

    Sources in code-point order (null last) weigh ``weights``, repeating. They
    share all words by weight; a target stops at ``most`` times its source's
    size and the excess goes to the others by weight until none is above. In
    closed form: with sources in the order of their limit per weight, the
    water level is what remains after the limits of those before, per weight
    of the rest; a source is at its limit if that lies below its level.
    One row a source goes through the windows.
    """
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(W.orderBy(F.col("source").cast("binary").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    full = (named.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
            .withColumn("ratio", F.col("limit") / F.col("weight")))
    everything = W.partitionBy(F.lit(1))
    below = everything.orderBy("ratio", "weight", "source_size", "source").rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("limit").over(below), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))))
    capped = full.withColumn("level", level).withColumn("at_limit", F.col("ratio") <= F.col("level"))
    common = F.max(F.when(~F.col("at_limit"), F.col("level"))).over(everything)
    return capped.select("source", "source_size",
                         F.when(F.col("at_limit"), F.col("limit")).otherwise(F.col("weight") * common).alias("target"))


def _cuts(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """source, copies, cut, quota, ties: every document gets ``copies``, those with a hash below ``cut`` one more.

    Of the ``ties`` documents whose hash is the cut (equal rows, mostly one)
    ``quota`` get one more: as many as bring the source nearest to its target.
    Where whole copies meet the target there is no cut; a source without words
    keeps each row once.
    """
    budget = (targets.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(F.lit(1)).cast("long"))
              .withColumn("left", F.col("target") - F.col("copies") * F.col("source_size"))
              .withColumn("prefix", F.lit(0).cast("long")).withColumn("done", F.lit(0).cast("long")))
    bounds = materialize(budget.select("source", "copies", "left", "prefix", "done"), "bounds")
    rows = slim
    for level in range(LEVELS):
        width = 16 ** (DIGITS * (LEVELS - 1 - level))
        digit = F.pmod(F.shiftright("hash", (width.bit_length() - 1)), F.lit(BUCKETS))
        sums = rows.groupBy("source", digit.alias("digit")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("ties"))
        b = bounds.select(F.col("source").alias("of"), "left", "done")
        run = W.partitionBy("source").orderBy("digit")
        through = (sums.join(b, F.col("source").eqNullSafe(F.col("of")))
                   .withColumn("after", F.col("done") + F.sum("size").over(run)))
        before = F.col("after") - F.col("size")
        first = (through.filter(F.col("after") > F.col("left")).groupBy("source")
                 .agg(F.min(F.struct("digit", before.alias("before"), "size", "ties")).alias("cross")))
        f = first.withColumnRenamed("source", "crossed")
        # only a source without words has no crossing bucket
        bounds = materialize(
            bounds.select("source", "copies", "left", "prefix", "done").join(
                f, F.col("source").eqNullSafe(F.col("crossed")), "left").select(
                "source", "copies", "left", "cross.size", "cross.ties",
                (F.col("prefix") * BUCKETS + F.coalesce("cross.digit", F.lit(BUCKETS))).alias("prefix"),
                F.coalesce("cross.before", "done").alias("done")), "bounds")
        if level < LEVELS - 1:
            b = bounds.select(F.col("source").alias("of"), F.col("prefix").alias("inside"))
            rows = slim.join(b, F.col("source").eqNullSafe(F.col("of")) & (
                F.shiftright("hash", width.bit_length() - 1) == F.col("inside"))).select("source", "size", "hash")
    each = F.col("size") / F.col("ties")
    quota = F.least("ties", F.floor((F.col("left") - F.col("done")) / each + 0.5))
    cut = F.col("left") > 0
    return bounds.select("source", "copies", F.when(cut, F.col("prefix")).otherwise(F.lit(0)).alias("cut"),
                         F.when(cut, quota).otherwise(F.lit(0)).cast("long").alias("quota"),
                         F.when(cut, F.col("ties")).otherwise(F.lit(0)).cast("long").alias("ties"))


def _extra(rows: DataFrame) -> DataFrame:
    """``rows`` (named, every, hash, cut, quota, tag, ...) with their ``copies``.

    Rows at the cut are counted by ``tag`` (the task that wrote them) and
    numbered within it, so that a group of any size is spread over tasks.
    """
    edge = F.col("hash") == F.col("cut")
    plain = rows.filter(~edge).withColumn("copies", F.col("every") + (F.col("hash") < F.col("cut")).cast("long"))
    tied = rows.filter(edge)
    before = W.partitionBy("of").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    tasks = (tied.groupBy(F.col("named").alias("of"), F.col("tag").alias("at")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    nth = F.row_number().over(W.partitionBy("named", "tag").orderBy("hash")) + F.col("ahead")
    counted = (tied.join(tasks, F.col("named").eqNullSafe(F.col("of")) & (F.col("tag") == F.col("at")))
               .withColumn("nth", nth))
    return plain.unionByName(
        counted.withColumn("copies", F.col("every") + (F.col("nth") <= F.col("quota")).cast("long"))
        .drop("of", "at", "ahead", "nth"))


def mixture(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source, hash, source_size, target, copies, taken of every row of ``docs``.

    ``size``: words ``[^\\x20\\x09-\\x0D]+`` of the text (null: 0). ``copies``:
    how often the mix takes the row (at most ``ceil(most)`` times), ``taken``:
    its words times that. A null source is a source of its own. Of equal rows
    at the cut as many are taken as the target wants, so a source differs from
    its target by at most half of one row; reruns agree whatever the files or
    partitions. Texts without words have size and taken 0. An empty table
    gives an empty result. Other columns are not read.
    """
    carried = [F.col(c) for c in (id_col, text_col, source_col)]
    slim = _sizes(docs, document_hash(carried, id_col, text_col), id_col, text_col, source_col)
    return (_extra(slim.join(_plan(slim, weights, most), F.col("source").eqNullSafe(F.col("named"))))
            .select("doc_id", "size", "source", "hash", "source_size", "target", "copies")
            .withColumn("taken", F.col("size") * F.col("copies")))


def _sizes(docs: DataFrame, key: Column, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        key.alias("hash"), F.spark_partition_id().alias("tag")), "sizes")


def _plan(slim: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """One row a source: named, source_size, target, every (whole copies), cut, quota, ties."""
    targets = materialize(source_targets(slim.select("source", "size"), weights, most), "targets")
    cuts = _cuts(slim, targets).select(F.col("source").alias("named"), F.col("copies").alias("every"), "cut",
                                       "quota", "ties")
    return targets.join(cuts, F.col("source").eqNullSafe(F.col("named"))).drop("source")


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``docs`` (doc_id, text, source and any other columns) with each row as often as the mix takes it.

    Rows are filtered and repeated by their hash and their source's cut alone.
    Where rows equal in all columns stand at a cut, the rows are written once
    with the task that wrote them, to be counted; columns with maps are compared as JSON.
    """
    key = document_hash(_comparable(docs))
    plan = materialize(_plan(_sizes(docs, key, "doc_id", "text", "source"), weights, most).select(
        "named", "every", "cut", "quota", "ties"), "plan")
    rows = packed(docs, F.col("source").cast("string").alias("source"), key.alias("hash")).join(
        plan, F.col("source").eqNullSafe(F.col("named")))
    if plan.filter("ties > 1").isEmpty():
        taken = rows.withColumn("copies", F.col("every") + (
            (F.col("hash") < F.col("cut")) | ((F.col("hash") == F.col("cut")) & (F.col("quota") > 0))).cast("long"))
    else:
        wanted = rows.filter((F.col("every") > 0) | (F.col("hash") <= F.col("cut")))
        taken = _extra(materialize(wanted.withColumn("tag", F.spark_partition_id()), "wanted"))
    return (taken.filter("copies > 0")
            .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*"))

"""S1 with a list of rejects: lines that fit their schema are loaded, the others are listed with file, line and reason.

``read_star`` stops at the first bad value. Here one pass over the files parses
every line and writes it, tagged with its outcome, into a staging folder; valid
rows and rejects are read from there, so both come from the same parse. Line
numbers need no sequential reader: each task numbers its lines, and the lines
of the blocks before (one row a block) are added.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from closebook.sources.schemas import STAR_SCHEMAS, STAR_TABLES
from closebook.sources.star import _path, check_inputs, with_star_types

CORRUPT = "_corrupt_record"
BOM = "\ufeff"
SHOWN = 5  # files named in an error


class TypedLoad(NamedTuple):
    """``valid``: the schema's columns; ``rejects``: file, line, reason, text; ``counts``: file, lines, headers, blank,
    valid, rejected (the last four add up to ``lines``)."""

    valid: DataFrame
    rejects: DataFrame
    counts: DataFrame


def _ddl(schema: T.StructType, *more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), *more])


def _reason(schema: T.StructType, required: tuple[str, ...]) -> Column:
    """Why the parsed line (``typed``, and ``texts`` with one field more than the schema) is rejected, else null."""
    names = schema.fieldNames()
    misfits = F.array_compact(F.array(*(
        F.when(F.col("texts")[f"t{i}"].isNotNull() & F.col("typed")[n].isNull(), F.lit(n)) for i, n in enumerate(names))))
    absent = F.array_compact(F.array(*(F.when(F.col("typed")[n].isNull(), F.lit(n)) for n in required))) if required else F.array()
    return (F.when(F.col("texts")[f"t{len(names)}"].isNotNull(), F.lit("fields"))
            .when(F.col("typed")[CORRUPT].isNotNull() & (F.size(misfits) > 0), F.concat(F.lit("type: "), F.array_join(misfits, ", ")))
            .when(F.col("typed")[CORRUPT].isNotNull(), F.lit("fields"))
            .when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", "))))


def load_typed(spark: SparkSession, path: str, schema: T.StructType, staging: str, required: tuple[str, ...] = (),
               sep: str = ";") -> TypedLoad:
    """Parse the delimited files with a header under ``path`` once, into the folder ``staging`` (overwritten).

    A line is rejected for ``fields`` (more or fewer than the schema), ``type: a, b`` (values that do not fit
    their columns), ``missing: a`` (an empty ``required`` column) or ``header`` (a header line inside a file).
    Blank lines are no records. A file whose first line is not the schema's header fails the load, as with
    ``read_star``: its columns may stand in another order. A record is one line (no line breaks in quotes).
    """
    options = {"sep": sep, "mode": "PERMISSIVE"}
    texts = ", ".join(f"t{i} string" for i in range(len(schema.fields) + 1))
    value = F.ltrim(F.col("value"), F.lit(BOM))
    kind = (F.when(value == sep.join(schema.fieldNames()), F.lit("header"))
            .when(F.trim("value") == "", F.lit("blank")).when(F.col("reason").isNotNull(), F.lit("reject")).otherwise(F.lit("valid")))
    lines = (spark.read.text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("at"))
             .withColumn("typed", F.from_csv("value", _ddl(schema, f"`{CORRUPT}` string"), {**options, "columnNameOfCorruptRecord": CORRUPT}))
             .withColumn("texts", F.from_csv("value", texts, options))
             .withColumn("reason", _reason(schema, tuple(required)))
             .withColumn("kind", kind))
    good, bad = F.col("kind") == "valid", F.col("kind") == "reject"
    (lines.select("kind", "file", "block", "at", F.when(bad, F.col("reason")).alias("reason"),
                  F.when(good, F.struct(*(F.col("typed")[n].alias(n) for n in schema.fieldNames()))).alias("row"),
                  F.when(~good, F.col("value")).alias("text"))
     .write.mode("overwrite").partitionBy("kind").parquet(staging))

    staged_schema = T.StructType().add("file", "string").add("block", "long").add("at", "long").add("reason", "string") \
        .add("row", schema).add("text", "string").add("kind", "string")
    staged = spark.read.schema(staged_schema).parquet(staging)
    blocks = staged.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    # only a file's lines in its first block can be its first line
    heads = (staged.filter("block = 0").groupBy("file").agg(F.min_by("kind", "at").alias("kind"))
             .filter("kind <> 'header'").select("file").limit(SHOWN).collect())
    if heads:
        raise ValueError("header differs from the schema in " + ", ".join(r.file for r in heads))
    named = (staged.filter(F.col("kind").isin("reject", "header")).join(offsets, ["file", "block"])
             .withColumn("line", F.col("at") + F.col("shift")))
    rejects = (named.filter((F.col("kind") == "reject") | (F.col("line") > 1))
               .select("file", "line", F.coalesce("reason", F.lit("header")).alias("reason"), "text"))

    def number(which: str) -> Column:
        return F.count_if(F.col("kind") == which)
    counts = staged.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.least(number("header"), F.lit(1)).alias("headers"), number("blank").alias("blank"),
        number("valid").alias("valid"), (number("reject") + F.greatest(number("header") - 1, F.lit(0))).alias("rejected"))
    return TypedLoad(staged.filter("kind = 'valid'").select("row.*"), rejects, counts)


def load_star(spark: SparkSession, base: str, staging: str, tables=STAR_TABLES,
              required: dict[str, tuple[str, ...]] | None = None) -> dict[str, TypedLoad]:
    """The star's CSV files through ``load_typed``, each table into its own folder of ``staging``."""
    check_inputs(spark, base, tables)
    out = {}
    for t in tables:
        load = load_typed(spark, _path(base, t), STAR_SCHEMAS[t], f"{staging.rstrip('/')}/{t}", (required or {}).get(t, ()))
        out[t] = load._replace(valid=with_star_types(t, load.valid))
    return out

"""Star-schema sources and sinks (semicolon CSV with header, UTF-8).

S1 ``read_star``      typed read of the twelve CSV tables
S2 ``write_star``     idempotent persist (overwrite), facts partitioned by month;
   ``save_star_tables`` catalog tables with facts bucketed on the order id
S3 ``check_inputs``   missing input -> error before anything is read
S4 ``table_row_counts`` one row per table
S5 ``write_csv``      semicolon CSV sink

The ``*_view`` adapters rename the star columns to the canonical columns the
operators work on (listed in ``closebook.sources``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions.dates import year_month
from closebook.sources.schemas import MONTH_PARTITIONED, STAR_SCHEMAS, STAR_TABLES

CSV_OPTIONS = {"sep": ";", "header": "true", "encoding": "UTF-8"}
#: A value that does not fit its type, a missing field or a header that differs from the schema is an error.
STRICT = {"mode": "FAILFAST", "enforceSchema": "false"}


def _path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}.csv"


def check_inputs(spark: SparkSession, base: str, tables=STAR_TABLES) -> None:
    """S3: fail before loading when an input file is missing (Hadoop FS, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for t in tables:
        p = jvm.org.apache.hadoop.fs.Path(_path(base, t))
        if not p.getFileSystem(conf).exists(p):
            missing.append(_path(base, t))
    if missing:
        raise FileNotFoundError("missing star input(s): " + ", ".join(missing))


def read_star(spark: SparkSession, base: str, tables=STAR_TABLES,
              check: bool = True) -> dict[str, DataFrame]:
    """Typed, lazy read of the star CSV files.

    Strict: a malformed value or a header whose names or order differ from the
    declared schema fails the job that reads it, instead of giving NULLs or
    swapped columns.
    """
    if check:
        check_inputs(spark, base, tables)
    out = {}
    for t in tables:
        df = spark.read.options(**CSV_OPTIONS, **STRICT).schema(STAR_SCHEMAS[t]).csv(_path(base, t))
        out[t] = with_star_types(t, df)
    return out


def with_star_types(table: str, df: DataFrame) -> DataFrame:
    """The budget's nullable ids are written as doubles."""
    if table == "fact_budget":
        return (df.withColumn("canal_id", F.col("canal_id").cast("int"))
                  .withColumn("categorie_id", F.col("categorie_id").cast("int")))
    return df


def write_star(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> None:
    """Drop-and-recreate each table; month-partitioned facts prune by month.

    Facts are dealt by month with a REBALANCE: adaptive execution splits a month
    that holds much of the data over several tasks (files of about the advisory
    partition size) and merges small ones.
    """
    for name, df in tables.items():
        w = df
        part_col = MONTH_PARTITIONED.get(name)
        writer = None
        if part_col is not None:
            w = df.withColumn("annee_mois", year_month(part_col))
            writer = w.hint("rebalance", "annee_mois").write.partitionBy("annee_mois")
        else:
            writer = w.write
        writer.mode("overwrite").format(fmt).save(f"{base.rstrip('/')}/{name}")


def save_star_tables(tables: dict[str, DataFrame], database: str, location: str | None = None,
                     buckets: int = 64, bucket_keys: dict[str, str] | None = None) -> None:
    """S2 variant for repeated reporting: catalog tables, facts bucketed and sorted
    on their order id so the collections -> sales join (M3) reads both sides
    co-partitioned (no exchange); small dimensions are plain tables.
    ``buckets`` should give ~128-512 MB files per bucket at the target size.
    """
    keys = bucket_keys or {"fact_ventes": "commande_id", "fact_encaissements": "commande_id"}
    spark = next(iter(tables.values())).sparkSession
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name, df in tables.items():
        w = df.write.mode("overwrite").format("parquet")
        if name in keys:
            w = w.bucketBy(buckets, keys[name]).sortBy(keys[name])
        w.saveAsTable(f"{database}.{name}")


def write_csv(df: DataFrame, path: str) -> None:
    """Semicolon CSV with header, UTF-8, overwrite."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``COUNT(*)`` of every table as (table_name, n)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------------------
# adapters: star columns -> canonical operator columns
# ---------------------------------------------------------------------------

def sales_fact_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_ventes"].select(
        F.col("commande_id").alias("order_id"), F.col("date_cmd").alias("order_date"),
        "client_id", F.col("prix_unit_ht").alias("unit_price"),
        "sku", F.col("canal_id").alias("channel_id"),
        F.col("quantite").cast("double").alias("qty"),
        F.col("ca_ht").alias("revenue"), F.col("cout_achat_ht").alias("cost"))


def products_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["dim_produit"].select(
        "sku", F.col("categorie").alias("cat"), "collection",
        F.col("prix_achat_ht").alias("unit_cost"))


def channels_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["dim_canal"].select("canal_id", "canal").withColumnsRenamed(
        {"canal_id": "channel_id", "canal": "ch"})


def collections_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_encaissements"].select(
        F.col("commande_id").alias("order_id"), F.col("date_cmd").alias("order_date"),
        F.col("date_encaissement").alias("settle_date"),
        F.col("delai_jours").alias("delay_days"), F.col("montant_ht").alias("amount"))


def order_channel_view(t: dict[str, DataFrame]) -> DataFrame:
    """Collections find their channel through the sale line (commande_id -> canal).

    A channel dimension below the broadcast threshold is broadcast by Spark, and
    the sales side keeps its own partitioning (bucketed on the order id when
    persisted with ``save_star_tables``) into the M3 join.
    """
    return (t["fact_ventes"].select(F.col("commande_id").alias("order_id"), "canal_id")
            .join(t["dim_canal"].select("canal_id", "canal"), "canal_id", "left")
            .select("order_id", F.col("canal").alias("ch")))


def charges_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_charges"].select(
        F.col("date_charge").alias("charge_date"), "cc_id",
        F.col("nature_charge").alias("nature"), F.col("montant_ht").alias("amount"))


def cost_centres_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["dim_centre_cout"].select(
        "cc_id", F.col("centre_cout").alias("cc_name"),
        F.col("masse_salariale_mens").cast("double").alias("payroll_base"))


def payroll_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_paie"].select(F.col("date_paie").alias("pay_date"), "cc_id",
                                 F.col("masse_salariale_ht").alias("amount"))


def budget_view(t: dict[str, DataFrame]) -> DataFrame:
    """Budget rows with channel / category labels resolved (LEFT JOIN dims)."""
    b = t["fact_budget"]
    ch = t["dim_canal"].select("canal_id", F.col("canal").alias("ch"))
    cat = t["dim_categorie"].select("categorie_id", F.col("categorie").alias("cat"))
    return (b.join(ch, "canal_id", "left")
             .join(cat, "categorie_id", "left")
             .select(F.col("annee").alias("yr"), F.col("mois").alias("mo"), "type", "ch", "cat",
                     "cc_id", F.col("montant_budget").alias("amount"),
                     F.col("marge_budget_pc").alias("margin_pc")))


def purchases_view(t: dict[str, DataFrame]) -> DataFrame:
    return t["fact_achats"].select(
        year_month("date_facture").alias("ym"), "sku",
        F.col("quantite").cast("long").alias("qty"),
        F.col("montant_marchandises_ht").alias("goods"),
        F.col("montant_transport_ht").alias("freight"),
        F.col("montant_total_ht").alias("total"))

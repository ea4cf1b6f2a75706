"""Binding of the star model to the driver's TPC-H-like parquet tables.

| star concept          | testdata expression                                      |
|-----------------------|----------------------------------------------------------|
| sale line             | lineitem LEFT JOIN (orders LEFT JOIN customer)            |
| order date            | to_date(o_orderdate)                                      |
| channel               | c_mktsegment                                              |
| product / category    | l_partkey / p_type, collection p_brand                     |
| quantity, revenue     | l_quantity, l_extendedprice * (1 - l_discount)            |
| purchase cost         | l_quantity * p_retailprice                                |
| line identity         | (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) |
| collection            | one per line: settle on l_shipdate, amount l_extendedprice |
| charge                | month of l_shipdate, cost centre = supplier nation,        |
|                       | nature = l_returnflag, amount = l_extendedprice * l_tax    |
| cost centre           | nation: cc_id 'CCnn', label n_name, payroll base = sum of  |
|                       | its suppliers' s_acctbal                                   |

Channels are resolved while building the fact (orders join customer before
the big lineitem join), so the line-level data is shuffled once on the order
key and once on the part key. Catalyst prunes every scan to the columns used
and AQE picks broadcast or sort-merge per join from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.functions.bloom import BITS, reduce_by_keys
from closebook.functions.dates import as_date, in_years

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


class TestData:
    """Lazy accessor for ``{base}/{table}.parquet``.

    Each table's reader (file listing + footer schema) is created once per
    accessor and reused; the DataFrames stay lazy, so every query still
    scans the files when it runs.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self.memo: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.base}/{name}.parquet")
        return self._tables[name]

    # -- dimensions ---------------------------------------------------------
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku"), F.col("p_type").alias("cat"),
            F.col("p_brand").alias("collection"), F.col("p_retailprice").alias("unit_cost"))

    def order_channels(self) -> DataFrame:
        """(order_id, order_date, ch): orders LEFT JOIN customer."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.table("customer").select("c_custkey", "c_mktsegment")
        return (o.join(c, o.o_custkey == c.c_custkey, "left")
                 .select(F.col("o_orderkey").alias("order_id"),
                         as_date("o_orderdate").alias("order_date"),
                         F.col("c_mktsegment").alias("ch")))

    def cost_centres(self) -> DataFrame:
        n = self.table("nation").select("n_nationkey", "n_name")
        pay = (self.table("supplier").groupBy("s_nationkey")
               .agg(F.sum("s_acctbal").alias("payroll_base")))
        return (n.join(pay, n.n_nationkey == pay.s_nationkey, "left")
                 .select(F.format_string("CC%02d", F.col("n_nationkey")).alias("cc_id"),
                         F.col("n_name").alias("cc_name"),
                         F.coalesce(F.col("payroll_base"), F.lit(0.0)).alias("payroll_base")))

    # -- facts --------------------------------------------------------------
    def order_dates(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_orderdate")
        return o.select(F.col("o_orderkey").alias("order_id"), as_date("o_orderdate").alias("order_date"))

    def sales_fact(self, with_channel: bool = True) -> DataFrame:
        """Line-level sales with order date (and channel); cost comes from the product.

        Without the channel, the customer join is left out entirely: at scale
        orders x customer is a sort-merge join a query should not pay for a
        column it never reads (Catalyst cannot drop a left join by itself).
        """
        l = self.table("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount")
        oc = self.order_channels() if with_channel else self.order_dates()
        ch = ["ch"] if with_channel else []
        return (l.join(oc, l.l_orderkey == oc.order_id, "left")
                 .select(*LINE_KEYS, "order_date", *ch,
                         F.col("l_partkey").alias("sku"),
                         F.col("l_quantity").alias("qty"),
                         (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("revenue")))

    def sales_of_years(self, first: int, last: int | None = None, with_channel: bool = False, bits: int = BITS) -> DataFrame:
        """``sales_fact`` of the orders of these years only.

        The order keys of the years make a Bloom filter that lineitem is probed
        with before its shuffle; the inner join then decides.
        """
        oc = (self.order_channels() if with_channel else self.order_dates()).filter(in_years("order_date", first, last))
        wanted = self.order_dates().filter(in_years("order_date", first, last))
        l = self.table("lineitem").select(*LINE_KEYS, "l_quantity", "l_discount")
        l = reduce_by_keys(l, "l_orderkey", wanted, "order_id", bits)
        return (l.join(oc, l.l_orderkey == oc.order_id)
                 .select(*LINE_KEYS, "order_date", *(["ch"] if with_channel else []),
                         F.col("l_partkey").alias("sku"), F.col("l_quantity").alias("qty"),
                         (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("revenue")))

    def collections(self, with_channel: bool = False) -> DataFrame:
        """One collection per line: (order_id, keys, order_date, raw delay, amount[, ch]).

        Date and channel come from one join with orders (x customer).
        """
        l = self.table("lineitem").select(*LINE_KEYS, "l_shipdate")
        oc = self.order_channels() if with_channel else self.order_dates()
        ch = ["ch"] if with_channel else []
        return (l.join(oc, l.l_orderkey == oc.order_id, "left")
                 .select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_partkey",
                         "l_suppkey", "order_date",
                         F.datediff(as_date("l_shipdate"), F.col("order_date")).alias("raw_delay"),
                         F.col("l_extendedprice").alias("amount"), *ch))

    def charges(self) -> DataFrame:
        l = self.table("lineitem").select("l_suppkey", "l_shipdate", "l_returnflag",
                                          "l_extendedprice", "l_tax")
        # the cost-centre code is formatted once per supplier, not once per line
        s = self.table("supplier").select(
            "s_suppkey", F.format_string("CC%02d", F.col("s_nationkey")).alias("cc_id"))
        return (l.join(s, l.l_suppkey == s.s_suppkey, "left")
                 .select(as_date("l_shipdate").alias("charge_date"), "cc_id",
                         F.col("l_returnflag").alias("nature"),
                         (F.col("l_extendedprice") * F.col("l_tax")).alias("amount")))

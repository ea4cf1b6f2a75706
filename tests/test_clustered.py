"""A fact along a Z-order curve: same rows, and slices on any axis skip most row groups."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from closebook.plans import catalog as C
from closebook.sources.clustered import _spread, axis_bounds, write_clustered, z_value

SF = "/root/testdata/sf0.001"
AXES = ("day", "ch", "sku")


@pytest.fixture(scope="module")
def fact(spark):
    h = lambda i: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1 << 30)).cast("int")
    return spark.range(200_000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), h(1) % 730).alias("day"),
        F.concat(F.lit("channel-"), (h(2) % 16).cast("string")).alias("ch"),
        F.format_string("SKU%05d", h(3) % 3000).alias("sku"), F.col("id").cast("double").alias("amount")).coalesce(4)


def read_share(path, **slices):
    """Share of the row groups whose footer statistics do not exclude the values ``column=(low, high)``."""
    kept = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(meta.schema.names.index(c)).statistics for c in slices}
            total += 1
            kept += all(stats[c] is None or not stats[c].has_min_max or (stats[c].min <= high and stats[c].max >= low)
                        for c, (low, high) in slices.items())
    return kept / total, total


def test_slices_on_every_axis_skip_most_row_groups(spark, fact, tmp_path):
    plain, clustered = f"{tmp_path}/plain", f"{tmp_path}/z"
    fact.repartition(64).write.parquet(plain)
    write_clustered(fact, clustered, AXES, files=64)
    axes = {"day": (dt.date(2024, 5, 1), dt.date(2024, 5, 31)), "ch": ("channel-3",) * 2, "sku": ("SKU00100",) * 2}
    for column, values in axes.items():  # 64 files: four ranges an axis, and files that reach into a second one
        assert read_share(plain, **{column: values})[0] == 1.0
        share, groups = read_share(clustered, **{column: values})
        assert groups >= 64 and share <= 0.5, (column, share)
    assert read_share(clustered, day=axes["day"], ch=axes["ch"])[0] <= 0.25  # the slice of P7
    assert read_share(clustered, **axes)[0] <= 0.125
    again = spark.read.parquet(clustered)
    assert again.columns == fact.columns
    assert again.exceptAll(fact).count() == 0 and fact.exceptAll(again).count() == 0


def test_z_value_interleaves_ascending_ranges(spark, fact):
    for axis in AXES:
        bounds = axis_bounds(fact, axis, 4)
        assert bounds == sorted(bounds) and len(bounds) <= 15
    assert [_spread(n, 1, 3, 3) for n in range(8)] == [0, 2, 16, 18, 128, 130, 144, 146]
    one = fact.select("day", z_value(fact, ("day",), 5).alias("z")).groupBy("day").agg(F.min("z").alias("a"), F.max("z").alias("b")).orderBy("day").collect()
    assert all(r.a == r.b for r in one) and [r.a for r in one] == sorted(r.a for r in one) and 20 < one[-1].a < 32


def test_nulls_hot_cells_and_an_empty_table(spark, tmp_path):
    """A third of the rows in one cell is spread over files; nulls stay."""
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 > 0, F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 365).cast("int"))).alias("day"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 5).cast("string")).alias("ch"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 100).cast("string")).alias("sku"), F.col("id").alias("amount"))
    write_clustered(rows, f"{tmp_path}/hot", AXES, files=12)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/hot/*.parquet")]
    assert sum(sizes) == 90_000 and max(sizes) < 20_000
    assert spark.read.parquet(f"{tmp_path}/hot").filter("day is null").count() == 30_000
    write_clustered(rows.limit(0), f"{tmp_path}/none", AXES)
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError, match="bits"):
        write_clustered(rows, f"{tmp_path}/no", AXES, bits=11)


def test_the_slice_is_pushed_to_the_clustered_files(spark):
    df = C.QUERIES["pnl_channel_slice_clustered"](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x and "ch" in x][0]
    assert "EqualTo(ch,BUILDING)" in pushed and "GreaterThanOrEqual(order_date,2000-01-01)" in pushed
    assert "lineitem" not in plan

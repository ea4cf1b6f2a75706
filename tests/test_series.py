"""Gap filling, month frames, Bloom reduction and grains against values worked out in plain Python."""

import random
import statistics

from pyspark.sql import functions as F

from closebook.functions.bloom import bloom_filter, may_contain, reduce_by_keys
from closebook.operators import controls, series
from closebook.plans import catalog as C
from closebook.sources.testdata import TestData

from .test_plans import formatted

SF = "/root/testdata/sf0.001"


def ym(i):
    return f"{i // 12:04d}-{i % 12 + 1:02d}"


def monthly(seed):
    """{series: {month index: value}} with gaps, one-month series and a NULL key."""
    r = random.Random(seed)
    out = {}
    for key in ["a", "b", "c", None]:
        first = 2000 * 12 + r.randrange(12)
        out[key] = {first + i: round(r.uniform(1, 99), 1) for i in range(40) if i in (0, 39) or r.random() < 0.6}
    out["one"] = {24005: 7.0}
    return out


def test_gaps_are_filled_between_a_series_own_ends(spark):
    data = monthly(1)
    df = spark.createDataFrame([(k, ym(i), v) for k, s in data.items() for i, v in s.items()] + [("a", None, 5.0)],
                               "ch string, ym string, v double")
    got = series.fill_months(series.with_month(df), ["ch"], {"v": None}).select("ch", "ym", "filled", "v").collect()
    want = [(k, ym(i), i not in s, s.get(i)) for k, s in data.items() for i in range(min(s), max(s) + 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_frames_follow_the_calendar(spark):
    data = monthly(2)
    df = spark.createDataFrame([(k, ym(i), v) for k, s in data.items() for i, v in s.items()], "ch string, ym string, v double")
    dense = series.fill_months(series.with_month(df), ["ch"], {"v": None})
    got = {(r.ch, r.ym): (r.ago, r.back) for r in dense.select(
        "ch", "ym", series.value_months_ago("v", ["ch"], 12).alias("ago"),
        F.sum("v").over(series.months_back(["ch"], 2, 0)).alias("back")).collect()}
    for k, s in data.items():
        for i in range(min(s), max(s) + 1):
            ago, back = got[k, ym(i)]
            near = [s[j] for j in (i - 2, i - 1, i) if j in s]
            assert ago == s.get(i - 12)
            assert (back is None) == (not near) and (not near or abs(back - sum(near)) < 1e-9)


def test_baseline_counts_a_month_without_booking_as_zero(spark):
    data = monthly(3)
    df = spark.createDataFrame([(k, ym(i), v) for k, s in data.items() for i, v in s.items()], "cc string, ym string, v double")
    rows = {(r.cc, r.ym): r for r in series.baseline_dense(df, ["cc"], "v").collect()}
    for k, s in data.items():
        for i in range(min(s), max(s) + 1):
            before = [s.get(j, 0.0) for j in range(max(min(s), i - 12), i)]
            r = rows[k, ym(i)]
            assert r.v == s.get(i, 0.0)
            assert (r.mean12 is None) == (not before) and (not before or abs(r.mean12 - statistics.mean(before)) < 1e-9)
            if len(before) > 1:
                assert abs(r.std12 - statistics.stdev(before)) < 1e-9


def test_positional_and_calendar_year_on_year_differ_only_across_a_gap(spark):
    cmart = C._cmart(C._td(spark, SF))
    closed = cmart.filter(F.date_format("order_date", "yyyy-MM") != "1999-05")
    dense = {(r.ch, r.ym): r for r in series.dso_report_dense(closed).collect()}
    plain = {(r.ch, r.ym): r.dso_days for r in series.dso_report_dense(cmart).collect()}
    channel = next(k for k in dense if k[1] == "1999-05")[0]
    assert dense[channel, "1999-05"].filled and dense[channel, "1999-05"].dso_days is None
    assert dense[channel, "2000-05"].yoy is None and dense[channel, "1999-06"].mom is None
    for (ch, month), r in dense.items():
        past = (ch, f"{int(month[:4]) - 1}{month[4:]}")
        if r.yoy is not None:
            assert abs(r.yoy - (plain[ch, month] - plain[past])) < 0.06 and past[1] != "1999-05"


def test_dense_series_need_no_calendar_join(spark):
    p = formatted(spark, "dso_yoy_dense")
    assert p.split("Generate")[0].count("SortMergeJoin") <= 2 and "CartesianProduct" not in p


def test_bloom_filter_keeps_every_partner(spark):
    keys = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    rows = spark.range(30_000).selectExpr("id", "IF(id % 1000 = 1, NULL, id) AS k")
    got = {r.id for r in reduce_by_keys(rows, "k", keys, "k", bits=1 << 17).collect()}
    partners = {i for i in range(0, 30_000, 3) if i % 1000 != 1}
    assert partners <= got and len(got - partners) < 0.03 * 20_000
    none = spark.createDataFrame([], "k long")
    assert reduce_by_keys(rows, "k", none, "k", bits=64).count() == 0
    assert rows.filter(may_contain(bloom_filter(keys, "k", 64), F.col("k"), 64)).count() == 29_970  # full: passes all keys


def test_year_slice_reduces_the_lines_before_the_shuffle(spark):
    td = TestData(spark, SF)
    every, wanted = td.sales_fact(with_channel=False), td.sales_of_years(2000)
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "revenue"]
    want = every.filter(F.year("order_date") == 2000).select(cols)
    assert sorted(map(tuple, wanted.select(cols).collect())) == sorted(map(tuple, want.collect()))
    dates = td.order_dates().filter(F.year("order_date") == 2000)
    passed = reduce_by_keys(td.table("lineitem"), "l_orderkey", dates, "order_id").count()
    assert want.count() <= passed < 1.05 * want.count() < 0.5 * every.count()
    p = formatted(spark, "category_split_reduced")
    assert "Subquery" in p and "xxhash64(l_orderkey" in p


def test_control_pack_reads_the_fact_once_and_equals_the_controls(spark):
    p = formatted(spark, "control_pack")
    assert p.count("lineitem.parquet") == 1 and "Expand" in p
    mart = C._mart(C._td(spark, SF))
    pack = controls.control_pack(mart, 2000).collect()
    years = {r.key: r for r in pack if r.grain == "year"}
    for r in controls.control_by_year(mart).collect():
        assert (r.revenue_m, r.margin_m, r.margin_pc) == tuple(years[str(r.yr)][c] for c in ("revenue_m", "margin_m", "margin_pc"))
    for r in controls.control_growth(mart).collect():
        assert r.growth_pc == years[str(r.yr)].growth_pc
    for grain, rows, axis in (("channel", controls.control_channel_mix(mart, 2000), "ch"),
                              ("category", controls.control_category_mix(mart, 2000), "cat")):
        assert ({(r[axis], r.revenue_m, r.share_pc) for r in rows.collect()}
                == {(r.key, r.revenue_m, r.share_pc) for r in pack if r.grain == grain})

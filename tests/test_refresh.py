"""Refreshing the cube month by month, publishing a star as a whole, codes that survive a reload."""

import datetime as dt
import os
import random

import pytest

from closebook.operators import lines, marts, refresh
from closebook.sources import publish, star
from pyspark.sql import functions as F

from . import star_fixture

MART = "order_date date, ch string, cat string, qty double, revenue double, cost double"


def sold(seed, n, months=range(1, 13)):
    r = random.Random(seed)
    return [(dt.date(2024, r.choice(list(months)), r.randrange(1, 28)), r.choice(["web", "shop", None]), r.choice(["hats", "bags"]),
             float(r.randrange(9)), r.randrange(10 ** 6) / 100, r.randrange(10 ** 6) / 100) for _ in range(n)]


def cube(df):
    return sorted((tuple(r) for r in df.select("ym", "ch", "cat", "qty", "revenue", "cost", "margin", "margin_pc").collect()), key=repr)


def stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_late_and_corrected_lines_equal_a_full_rebuild(spark, tmp_path):
    path = str(tmp_path / "cube")
    first = sold(1, 400) + [(None, "web", "hats", 1.0, 2.5, 1.25)]
    late = sold(2, 60, (3, 4))
    frame = lambda rows: spark.createDataFrame(rows, MART)
    refresh.add_lines(frame(first), path)
    before = stamps(path)
    refresh.add_lines(frame(late), path, "late-1")
    refresh.add_lines(frame(late), path, "late-1")  # written twice, counted once
    assert {f: t for f, t in stamps(path).items() if f in before} == before
    assert cube(refresh.cube_from_partials(spark, path)) == cube(marts.monthly_cube(frame(first + late)))
    whole = first + late
    fixed = [(*r[:4], r[4] + 1, r[5]) if r[0] and r[0].month == 3 else r for r in whole if not r[0] or r[0].month != 7]
    refresh.recompute_months(frame(fixed), path, ["2024-03", "2024-07"])
    after = stamps(path)
    assert {f: t for f, t in before.items() if "2024-03" not in f and "2024-07" not in f}.items() <= after.items()
    assert not any("2024-07" in f for f in after)
    assert cube(refresh.cube_from_partials(spark, path)) == cube(marts.monthly_cube(frame(fixed)))


def test_a_load_killed_between_two_tables_leaves_the_old_star(spark, tmp_path):
    base, tables = str(tmp_path / "star"), star_fixture.build(spark)
    with pytest.raises(FileNotFoundError):
        publish.published(spark, base)
    one = publish.publish_star(tables, base)
    counts = {t: df.count() for t, df in publish.published(spark, base).items()}
    assert counts == {t: df.count() for t, df in tables.items()}
    broken = dict(tables)
    broken["dim_canal"] = tables["dim_canal"].limit(1)
    broken["fact_ventes"] = tables["fact_ventes"].withColumn("quantite", F.raise_error(F.lit("killed")).cast("int"))
    with pytest.raises(Exception, match="killed"):
        publish.publish_star(broken, base)
    assert {t: df.count() for t, df in publish.published(spark, base).items()} == counts
    reader = publish.published(spark, base)
    less = {t: df.limit(1) for t, df in tables.items()}
    two = publish.publish_star(less, base)
    assert {df.count() for df in publish.published(spark, base).values()} == {1}
    assert reader["fact_ventes"].count() == counts["fact_ventes"]  # resolved before, still readable
    assert len(publish.drop_unreachable(spark, base)) == 1  # the killed load
    three = publish.publish_star(less, base)
    assert publish.drop_unreachable(spark, base) == [one] and len({one, two, three}) == 3
    mart = marts.sales_mart(*(v(publish.published(spark, base)) for v in (star.sales_fact_view, star.products_view, star.channels_view)))
    assert mart.count() == 1


def test_codes_survive_a_reload(spark):
    load = lambda keys: spark.createDataFrame([(k,) for k in keys], "k long")
    first = lines.stable_keys(None, load([30, 10, 20, 10]), "k", "C%03d")
    assert {r.k: r.code for r in first.collect()} == {10: "C001", 20: "C002", 30: "C003"}
    second = lines.stable_keys(first, load([5, 30, 25, 10, 40]), "k", "C%03d")  # a row in front, one gone
    assert {r.k: r.code for r in second.collect()} == {
        10: "C001", 20: "C002", 30: "C003", 5: "C004", 25: "C005", 40: "C006"}
    third = lines.stable_keys(second, load([20, 1]), "k", "C%03d")
    assert {r.k: r.code for r in third.collect()}[1] == "C007" and third.count() == 7
    assert lines.stable_keys(third, load([]), "k", "C%03d").count() == 7

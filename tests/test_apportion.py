"""Largest remainders against a plain version, and budgets that add up to the cent."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from closebook.operators.apportion import apportion, budget_revenue_sku
from closebook.plans import catalog as C

SF = "/root/testdata/sf0.001"


def plain(target, weights):
    whole = sum(weights.values())
    out = {k: target * w // whole for k, w in weights.items() if w}
    for k in sorted(out, key=lambda k: (-(target * weights[k] % whole), k))[:target - sum(out.values())]:
        out[k] += 1
    return out


def test_shares_are_largest_remainders(spark):
    r = random.Random(1)
    groups = {g: (r.randrange(10 ** r.randrange(1, 13)), {f"k{i}": r.choice((0, 1, 1, 7, r.randrange(10 ** 14))) for i in range(1 + 9 * g)})
              for g in range(6)}
    groups[6] = (5, {"a": 0, "b": 0})
    rows = [(g, k, Decimal(t), Decimal(w)) for g, (t, ws) in groups.items() for k, w in ws.items()]
    cells = spark.createDataFrame(rows, "g int, k string, target decimal(38,0), weight decimal(38,0)")
    got = {(x.g, x.k): int(x.cents) for x in apportion(cells, ["g"], ["k"]).collect()}
    assert got == {(g, k): v for g, (t, ws) in groups.items() if any(ws.values()) for k, v in plain(t, ws).items()}


def test_the_budget_adds_up_to_the_cent_on_every_level(spark):
    mart = C._mart_no_product(C._td(spark, SF))
    total = mart.filter("yr = 1999").agg(F.sum(F.col("revenue").cast("decimal(18,4)"))).first()[0]
    for growth in (0.06, 0.0, 0.123456):
        budget = budget_revenue_sku(mart, 2000, growth)
        target = (total * Decimal(str(1 + growth))).quantize(Decimal("0.01"), "ROUND_HALF_UP")
        assert budget.agg(F.sum("amount")).first()[0] == target
    assert budget.groupBy("mo", "ch", "sku").count().filter("count > 1").count() == 0
    assert budget_revenue_sku(mart, 2000, buckets=1).agg(F.sum("amount")).first()[0] == budget_revenue_sku(
        mart, 2000, buckets=500).agg(F.sum("amount")).first()[0]


def test_lines_without_channel_and_years_without_sales(spark):
    rows = [(dt.date(1999, 5, 1), "web", 1, 10.0), (dt.date(1999, 6, 1), None, 2, 5.0), (dt.date(2000, 1, 1), "web", 3, 9.0)]
    mart = spark.createDataFrame(rows, "order_date date, ch string, sku long, revenue double")
    got = budget_revenue_sku(mart, 2000, 0.0)
    assert {(r.ch, r.sku) for r in got.collect()} == {("web", 1)} and got.agg(F.sum("amount")).first()[0] == Decimal("15.00")
    assert budget_revenue_sku(mart, 1990).count() == 0

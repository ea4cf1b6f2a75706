"""Star-schema path: CSV sink/source round trip (S1-S5) and the five planted signals."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closebook.functions import constants as K
from closebook.operators import drift, marts, purchasing, pvm, receivables, variance
from closebook.sources import star
from tests import star_fixture
from tests.conftest import rows


@pytest.fixture(scope="module")
def star_dir(spark):
    base = tempfile.mkdtemp(prefix="closebook-star-")
    for name, df in star_fixture.build(spark).items():
        star.write_csv(df.coalesce(1), f"{base}/{name}.csv")
    return base


@pytest.fixture(scope="module")
def tables(spark, star_dir):
    return star.read_star(spark, star_dir)


@pytest.fixture(scope="module")
def mart(tables):
    return marts.sales_mart(star.sales_fact_view(tables), star.products_view(tables),
                            star.channels_view(tables)).cache()


def test_round_trip_types_and_counts(spark, tables):
    built = star_fixture.build(spark)
    for name, df in built.items():
        assert tables[name].count() == df.count(), name
    b = dict((f.name, f.dataType) for f in tables["fact_budget"].schema.fields)
    assert isinstance(b["canal_id"], T.IntegerType) and isinstance(b["categorie_id"], T.IntegerType)
    d = dict((f.name, f.dataType) for f in tables["dim_date"].schema.fields)
    assert isinstance(d["annee_mois"], T.StringType)


def test_csv_is_semicolon_with_header(star_dir):
    part = [p for p in os.listdir(f"{star_dir}/dim_canal.csv") if p.endswith(".csv")][0]
    with open(f"{star_dir}/dim_canal.csv/{part}", encoding="utf-8") as fh:
        assert fh.readline().strip() == "canal_id;canal;part_ca_cible;marge_cible"


def test_missing_input_fails_before_load(spark, star_dir):
    with pytest.raises(FileNotFoundError, match="fact_ventes"):
        star.check_inputs(spark, star_dir, ["dim_canal", "fact_ventes_missing".replace("_missing", "") + "_x"])


def _csv(folder, name, *text):
    os.makedirs(f"{folder}/{name}.csv")
    with open(f"{folder}/{name}.csv/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write("\n".join(text) + "\n")


def test_malformed_value_fails(spark):
    base = tempfile.mkdtemp(prefix="closebook-bad-")
    _csv(base, "dim_canal", "canal_id;canal;part_ca_cible;marge_cible", "1;Web;1 200,50;0.4")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        star.read_star(spark, base, ["dim_canal"])["dim_canal"].collect()


def test_columns_in_another_order_fail(spark):
    base = tempfile.mkdtemp(prefix="closebook-bad-")
    _csv(base, "dim_canal", "canal;canal_id;part_ca_cible;marge_cible", "1;2;0.5;0.4")
    with pytest.raises(Exception, match="(?i)header"):
        star.read_star(spark, base, ["dim_canal"])["dim_canal"].collect()


def test_a_month_with_most_of_the_data_is_written_by_many_tasks(spark):
    from closebook.sources.schemas import STAR_SCHEMAS
    hot = spark.range(400_000).select(
        F.format_string("CMD%08d", "id").alias("commande_id"),
        F.when(F.col("id") % 10 < 6, F.lit("2025-03-05")).otherwise(F.lit("2025-04-07")).cast("date").alias("date_cmd"))
    for f in STAR_SCHEMAS["fact_ventes"].fields:
        if f.name not in hot.columns:
            hot = hot.withColumn(f.name, F.pmod(F.xxhash64("commande_id", F.lit(f.name)), F.lit(100_000)).cast(f.dataType))
    out = tempfile.mkdtemp(prefix="closebook-hot-")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        star.write_star({"fact_ventes": hot}, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(f"{out}/fact_ventes/annee_mois=2025-03") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(f"{out}/fact_ventes").count() == 400_000


def test_full_join_keeps_budget_cells_without_sales(spark):
    budget = spark.createDataFrame([(1, "Web", "Hats", 15.0, 5.0), (2, "Web", "Hats", 9.0, 3.0)],
                                   "mo int, ch string, cat string, budget_revenue double, budget_margin double")
    acts = spark.sql("SELECT 1 AS mo, 'Web' AS ch, 'Hats' AS cat, CAST(10 AS DECIMAL(18,4)) AS actual_revenue, "
                     "CAST(4 AS DECIMAL(18,4)) AS actual_margin")
    left = variance.budget_variance(None, budget, 2025, actuals=acts)
    full = variance.budget_variance(None, budget, 2025, actuals=acts, how="full")
    assert rows(left, "mo", "actual_revenue") == [(1, 10.0)]
    assert rows(full, "mo", "actual_revenue") == [(1, 10.0), (2, None)]


def test_row_counts_and_persist(spark, tables):
    counts = dict(rows(star.table_row_counts(tables)))
    assert counts["dim_canal"] == 3 and counts["fact_ventes"] == 24 * 3 * 8
    out = tempfile.mkdtemp(prefix="closebook-persist-")
    sub = {k: tables[k] for k in ("dim_canal", "fact_ventes")}
    star.write_star(sub, out)
    star.write_star(sub, out)  # idempotent: overwrite
    back = spark.read.parquet(f"{out}/fact_ventes")
    assert back.count() == tables["fact_ventes"].count()
    assert back.select("annee_mois").distinct().count() == 24


def test_sales_mart_on_star(mart):
    assert mart.filter(F.col("ch").isNull() | F.col("cat").isNull()).count() == 0
    r = rows(mart.filter("yr = 2025").agg(F.sum("revenue"), F.sum("margin")))[0]
    assert r[0] > r[1] > 0


def test_signal_price_up_volume_down(mart):
    got = {r[0]: r[1:] for r in rows(pvm.pvm_ratios(mart, 2025), "cat", "price_pc", "volume_pc")}
    assert got["Bags"][0] == pytest.approx(30.0, abs=0.2)
    # quantities 10/11/12 x 0.8 rounded to 8/9/10: 27 / 33 - 1 = -18.2 %
    assert got["Bags"][1] == -18.2
    assert abs(got["Knitwear"][0]) < 0.5


def test_signal_september_markdown(mart):
    drift_ = purchasing.margin_drift(marts.monthly_cube(mart))
    gap = {r[0]: r[1] for r in rows(drift_.filter("cat = 'Coats'"), "ym", "gap")}
    # PE lines (half of the category) go from 50 % to (0.85 - 0.5) / 0.85 = 41.2 % margin
    assert gap["2025-09"] < -3.0
    assert all(abs(v) < 1.0 for k, v in gap.items() if k not in ("2025-09", "2025-10") and v is not None
               and k > "2024-02")


def test_signal_marketplace_dso(spark, tables):
    cm = marts.collections_mart(star.collections_view(tables), star.order_channel_view(tables))
    rules = receivables.alert_rules(spark)
    d = receivables.dso_report(cm, rules).filter("ch = 'Marketplace'")
    got = {r[0]: (r[1], r[2]) for r in rows(d, "ym", "dso_days", "alert")}
    assert got["2025-03"] == (45.0, None)
    assert got["2025-04"] == (60.0, "Marketplace DSO degraded")
    check = rows(receivables.dso_channel_check(cm, "Marketplace", "2025-01", 55.0), "ym", "breach")
    assert [b for _, b in check] == [False] * 3 + [True] * 9


def test_signal_marketing_spike(tables):
    z = drift.charge_zscores(drift.charges_monthly(star.charges_view(tables)),
                             star.cost_centres_view(tables))
    alerts = rows(drift.charge_alerts(z, 20), "ym", "nature", "z")
    flagged = {(ym, nat) for ym, nat, zz in alerts if zz > 2}
    assert ("2025-04", "Marketing Marketplaces") in flagged
    assert all(nat == "Marketing Marketplaces" for _, nat in flagged)


def test_signal_freight_step(tables):
    f = purchasing.freight_ratio_trend(star.purchases_view(tables))
    got = {r[0]: (r[1], r[2]) for r in rows(f, "ym", "ratio_pc", "change_pts")}
    assert got["2025-05"][0] == pytest.approx(3.0, abs=0.01)
    assert got["2025-06"][0] == pytest.approx(3.45, abs=0.01)
    assert got["2025-06"][1] == pytest.approx(0.45, abs=0.01)


def test_budget_on_star_labels(tables, mart):
    cells = variance.resolve_budget(star.budget_view(tables), 2025)
    assert cells.count() == 12 * 3 * 4
    v = variance.budget_variance(mart, cells, 2025)
    assert v.filter(F.col("budget_revenue").isNull()).count() == 0
    statuses = {r[0] for r in rows(v, "status")}
    assert statuses <= set(K.STATUS_LABELS.values())


def test_bucketed_star_joins_without_exchange(spark, tables):
    # between the channel dimension's size and the facts': Spark broadcasts the dimension by its size
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    db = "closebook_" + os.path.basename(tempfile.mkdtemp()).replace("tmp", "").lower()
    try:
        names = ("dim_canal", "fact_ventes", "fact_encaissements")
        star.save_star_tables({k: tables[k] for k in names}, db,
                              location=tempfile.mkdtemp(prefix="closebook-db-"), buckets=4)
        t = {k: spark.table(f"{db}.{k}") for k in names}
        cm = marts.collections_mart(star.collections_view(t), star.order_channel_view(t))
        plan = spark._jvm.PythonSQLUtils.explainString(cm._jdf.queryExecution(), "formatted")
        smj = plan.split("\n(")[0]
        assert "SortMergeJoin" in smj, plan
        # both sides read co-bucketed on the order id: no shuffle, only the tiny dim broadcast
        assert "Exchange" not in smj.replace("BroadcastExchange", ""), plan
        assert cm.count() == tables["fact_encaissements"].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_sql_surface_over_views(spark, tables):
    from closebook.operators import pnl
    from closebook.plans.views import register_star_views
    names = register_star_views(spark, tables, 2025)
    assert {"v_ventes", "v_pnl_mensuel", "v_encaissements", "v_dashboard_kpis"} <= set(names)
    # an analyst query written against the views, run by Spark SQL
    sql = spark.sql("""
        WITH base AS (
          SELECT annee_mois, canal, categorie, SUM(ca_ht) AS ca, SUM(marge_brute_ht) AS marge
          FROM v_ventes GROUP BY annee_mois, canal, categorie)
        SELECT annee_mois, canal, categorie, ROUND(ca, 0) AS ca,
               ROUND(ca / SUM(ca) OVER (PARTITION BY annee_mois) * 100, 1) AS mix
        FROM base""")
    m = marts.sales_mart(star.sales_fact_view(tables), star.products_view(tables),
                         star.channels_view(tables))
    ref = {(r[0], r[1], r[2]): (r[3], r[4]) for r in rows(pnl.pnl_monthly(marts.monthly_cube(m)),
                                                          "ym", "ch", "cat", "revenue", "mix_share_pc")}
    got = {(r[0], r[1], r[2]): (r[3], r[4]) for r in rows(sql)}
    assert got.keys() == ref.keys()
    assert all(abs(got[k][0] - ref[k][0]) <= 1 and abs(got[k][1] - ref[k][1]) <= 0.1 for k in ref)
    assert spark.sql("SELECT COUNT(*) FROM v_encaissements WHERE canal IS NULL").first()[0] == 0
    dash = spark.sql("SELECT COUNT(*) FROM v_dashboard_kpis WHERE annee = 2024 AND ca_budget IS NOT NULL")
    assert dash.first()[0] == 0
    assert spark.sql("SELECT COUNT(*) FROM v_pnl_mensuel").first()[0] == 24 * 3 * 4

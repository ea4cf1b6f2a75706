"""SQL surface: the star tables and the marts as temporary views.

Analysts who query the reporting views with SQL keep doing so through
``spark.sql``: the twelve star tables are registered under their own names
and the four marts under the view names and column names of the original
reporting layer, computed by the DataFrame operators of this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.operators import marts, variance
from closebook.sources import star


def _double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def sales_view(t: dict[str, DataFrame]) -> DataFrame:
    """``v_ventes``: sales lines with product and channel labels, month, margin."""
    m = marts.sales_mart(star.sales_fact_view(t), star.products_view(t), star.channels_view(t))
    return m.select(
        F.col("order_id").alias("commande_id"), F.col("order_date").alias("date_cmd"),
        F.col("ym").alias("annee_mois"), F.col("yr").alias("annee"), F.col("mo").alias("mois"),
        F.col("qtr").alias("trimestre"), "client_id", "sku", F.col("cat").alias("categorie"),
        "collection", F.col("ch").alias("canal"), F.col("qty").cast("int").alias("quantite"),
        F.col("unit_price").alias("prix_unit_ht"), F.col("revenue").alias("ca_ht"),
        F.col("cost").alias("cout_achat_ht"), F.col("margin").alias("marge_brute_ht"),
        F.col("margin_pc").alias("taux_marge_pc"))


def pnl_view(t: dict[str, DataFrame]) -> DataFrame:
    """``v_pnl_mensuel``: the monthly cube (month x channel x category)."""
    m = marts.sales_mart(star.sales_fact_view(t), star.products_view(t), star.channels_view(t))
    c = marts.monthly_cube(m)
    return _double(c.select(
        F.col("ym").alias("annee_mois"), F.col("yr").alias("annee"), F.col("mo").alias("mois"),
        F.col("ch").alias("canal"), F.col("cat").alias("categorie"),
        F.col("qty").alias("qte_vendue"), F.col("revenue").alias("ca_ht"),
        F.col("cost").alias("cout_achat_ht"), F.col("margin").alias("marge_brute_ht"),
        F.col("margin_pc").alias("taux_marge_pc")), "ca_ht", "cout_achat_ht", "marge_brute_ht")


def collections_view(t: dict[str, DataFrame]) -> DataFrame:
    """``v_encaissements``: collections with the channel of their sale and the order month."""
    cm = marts.collections_mart(star.collections_view(t), star.order_channel_view(t))
    return cm.select(
        F.col("order_id").alias("commande_id"), F.col("order_date").alias("date_cmd"),
        F.col("settle_date").alias("date_encaissement"), F.col("delay_days").alias("delai_jours"),
        F.col("amount").alias("montant_ht"), F.col("ch").alias("canal"),
        F.col("ym").alias("annee_mois"))


def dashboard_view(t: dict[str, DataFrame], year: int) -> DataFrame:
    """``v_dashboard_kpis``: the KPI mart, budget columns filled for ``year`` only."""
    m = marts.sales_mart(star.sales_fact_view(t), star.products_view(t), star.channels_view(t))
    k = marts.kpi_mart(marts.monthly_cube(m), variance.resolve_budget(star.budget_view(t), year), year)
    return k.select(
        F.col("ym").alias("annee_mois"), F.col("yr").alias("annee"), F.col("mo").alias("mois"),
        F.col("ch").alias("canal"), F.col("cat").alias("categorie"), F.col("qty").alias("qte"),
        F.col("revenue").alias("ca_ht"), F.col("cost").alias("cout_achat_ht"),
        F.col("margin").alias("marge_brute_ht"), F.col("margin_pc").alias("taux_marge_pc"),
        F.col("budget_revenue").alias("ca_budget"), F.col("budget_margin").alias("marge_budget"),
        F.col("var_revenue").alias("ecart_ca"), F.col("var_pc").alias("ecart_ca_pc"))


def register_star_views(spark: SparkSession, tables: dict[str, DataFrame], year: int) -> list[str]:
    """Register the star tables and the four reporting views as temporary views (lazy)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    views = {"v_ventes": sales_view(tables), "v_pnl_mensuel": pnl_view(tables),
             "v_encaissements": collections_view(tables),
             "v_dashboard_kpis": dashboard_view(tables, year)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(tables) + sorted(views)

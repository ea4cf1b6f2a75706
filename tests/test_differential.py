"""Every catalog query against its DuckDB oracle on the same parquet files (exact match)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from closebook.plans.catalog import QUERIES
from closebook.plans.oracle import SQL
from tools.compare import TABLES, key_rows

SF = os.environ.get("CLOSEBOOK_DIFF_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_duckdb(spark, con, key):
    df = QUERIES[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    idx = [dcols.index(c) for c in df.columns]
    drows = [tuple(r[i] for i in idx) for r in cur.fetchall()]
    assert len(srows) == len(drows)
    assert key_rows(srows) == key_rows(drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ym", "ch", "cat", "qty", "revenue", "cost", "margin", "margin_pc",
                          "mix_share_pc"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", ["sales_mart", "pnl_monthly", "kpi_mart", "budget_variance",
                                 "pvm_mix_by_sku", "collections_mart", "dso_alerts",
                                 "charge_alerts_top20", "running_cutoff", "purchase_costing",
                                 "pnl_operating", "surrogate_keys"])
def test_matches_duckdb_with_sort_merge_joins(spark, con, no_broadcast, key):
    """Cluster-like plans (no join small enough to broadcast) give the same answer."""
    test_matches_duckdb(spark, con, key)

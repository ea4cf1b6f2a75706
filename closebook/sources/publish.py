"""S2, atomic: a star is loaded into a folder of its own and becomes visible as a whole.

``publish_star`` writes all tables under ``versions/<id>`` and then replaces
the one manifest file; readers resolve the manifest. A job that dies between
two tables leaves the old star as it was, and a reader that has resolved a
version keeps reading its files until they are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from closebook.sources import storage
from closebook.sources.star import write_star

MANIFEST = "current.json"


def publish_star(tables: dict[str, DataFrame], base: str) -> str:
    """Write all tables, then make them the current star; returns the version's id."""
    spark, version = next(iter(tables.values())).sparkSession, uuid.uuid4().hex
    base = base.rstrip("/")
    before = storage.get_json(spark, f"{base}/{MANIFEST}")
    write_star(tables, f"{base}/versions/{version}")
    storage.put_json(spark, f"{base}/{MANIFEST}", {
        "version": version, "previous": before and before["version"], "tables": sorted(tables)})
    return version


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the current star."""
    base = base.rstrip("/")
    current = storage.get_json(spark, f"{base}/{MANIFEST}")
    if current is None:
        raise FileNotFoundError(f"no star has been published in {base}")
    return {t: spark.read.parquet(f"{base}/versions/{current['version']}/{t}") for t in current["tables"]}


def drop_unreachable(spark: SparkSession, base: str) -> list[str]:
    """Remove versions that are neither current nor the one before it (crashed loads too); returns their ids.

    Not to be called while a load is running.
    """
    base = base.rstrip("/")
    current = storage.get_json(spark, f"{base}/{MANIFEST}") or {"version": None, "previous": None}
    old = [v for v in storage.children(spark, f"{base}/versions") if v not in (current["version"], current["previous"])]
    for version in old:
        storage.remove(spark, f"{base}/versions/{version}")
    return old

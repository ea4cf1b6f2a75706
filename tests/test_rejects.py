"""Typed loads with a list of rejects, and value lists without a shuffle of the lines."""

import os

import pytest
from pyspark.sql import functions as F

from closebook.operators.values import values_in_use
from closebook.plans import catalog as C
from closebook.sources import rejects, star
from closebook.sources.schemas import STAR_SCHEMAS
from tests import star_fixture

HEADER = "canal_id;canal;part_ca_cible;marge_cible"
SF = "/root/testdata/sf0.001"


def csv(folder, name, *files):
    os.makedirs(f"{folder}/{name}.csv")
    for i, text in enumerate(files):
        with open(f"{folder}/{name}.csv/part-{i}.csv", "w", encoding="utf-8", newline="") as fh:
            fh.write(text)


def load(spark, tmp_path, *files, **more):
    csv(tmp_path, "dim_canal", *files)
    return rejects.load_typed(spark, f"{tmp_path}/dim_canal.csv", STAR_SCHEMAS["dim_canal"], f"{tmp_path}/staged", **more)


def listed(frame):
    return sorted((r.file.rsplit("/", 1)[1], r.line, r.reason, r.text) for r in frame.collect())


def test_bad_lines_are_listed_with_file_line_and_reason(spark, tmp_path):
    got = load(spark, tmp_path,
               f"﻿{HEADER}\n1;Web;0.5;0.4\n\n2;Kiosk;1 200,50;0.4\n3;Shop;0.1\n4;Shop;0.1;0.2;0.3\n",
               f"{HEADER}\r\nx;Web;y;0.4\r\n5;\"a;b\";0.5;\r\n{HEADER}\r\n;Web;0.5;0.4\r\n", required=("canal_id",))
    assert listed(got.rejects) == [
        ("part-0.csv", 4, "type: part_ca_cible", "2;Kiosk;1 200,50;0.4"), ("part-0.csv", 5, "fields", "3;Shop;0.1"),
        ("part-0.csv", 6, "fields", "4;Shop;0.1;0.2;0.3"), ("part-1.csv", 2, "type: canal_id, part_ca_cible", "x;Web;y;0.4"),
        ("part-1.csv", 4, "header", HEADER), ("part-1.csv", 5, "missing: canal_id", ";Web;0.5;0.4")]
    assert sorted(map(tuple, got.valid.collect())) == [(1, "Web", 0.5, 0.4), (5, "a;b", 0.5, None)]
    counts = {r.file.rsplit("/", 1)[1]: tuple(r)[1:] for r in got.counts.collect()}
    assert counts == {"part-0.csv": (6, 1, 1, 1, 3), "part-1.csv": (5, 1, 0, 1, 3)}
    assert star.table_row_counts({"dim_canal": got.valid}).collect()[0].n == sum(c[3] for c in counts.values())


def test_line_numbers_hold_across_blocks(spark, tmp_path):
    """A file of many blocks: every 97th line is bad and found at its place."""
    n = 20_000
    text = HEADER + "\n" + "".join(f"{i};Web;{'bad' if i % 97 == 0 else 0.5};0.4\n" for i in range(n))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = load(spark, tmp_path, text)
        assert got.rejects.select("line").distinct().count() == len(range(0, n, 97))
        assert {(r.line, r.text.split(";")[0]) for r in got.rejects.collect()} == {(i + 2, str(i)) for i in range(0, n, 97)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    staged = spark.read.parquet(f"{tmp_path}/staged")
    assert staged.select("block").distinct().count() > 10
    assert got.valid.count() == n - len(range(0, n, 97))


def test_another_header_and_missing_files_fail_and_empty_files_do_not(spark, tmp_path):
    with pytest.raises(ValueError, match="header differs.*part-0"):
        load(spark, tmp_path / "a", "canal;canal_id;part_ca_cible;marge_cible\n1;2;0.5;0.4\n")
    with pytest.raises(FileNotFoundError, match="dim_canal"):
        rejects.load_star(spark, f"{tmp_path}/nowhere", f"{tmp_path}/s", ["dim_canal"])
    got = load(spark, tmp_path / "b", "", HEADER + "\n")
    assert got.valid.count() == 0 and got.rejects.count() == 0
    assert [tuple(r)[1:] for r in got.counts.collect()] == [(1, 1, 0, 0, 0)]


def test_a_clean_star_loads_as_with_read_star(spark, tmp_path):
    names = ["dim_canal", "fact_budget", "fact_ventes"]
    built = star_fixture.build(spark)
    for t in names:
        star.write_csv(built[t], f"{tmp_path}/{t}.csv")
    strict = star.read_star(spark, str(tmp_path), names)
    loads = rejects.load_star(spark, str(tmp_path), f"{tmp_path}/staged", names)
    for t in names:
        assert loads[t].rejects.count() == 0
        assert loads[t].valid.schema == strict[t].schema
        assert loads[t].valid.exceptAll(strict[t]).count() == 0 and strict[t].exceptAll(loads[t].valid).count() == 0


def test_rejects_read_no_valid_rows(spark, tmp_path):
    got = load(spark, tmp_path, f"{HEADER}\n1;Web;0.5;0.4\n2;Web;x;0.4\n")
    plan = spark._jvm.PythonSQLUtils.explainString(got.rejects._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [kind" in plan and "canal:string" not in plan


def test_values_in_use_are_exact(spark):
    dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    dim = dim.unionByName(spark.createDataFrame([(9000, None), (None, "none"), (9001, "unused")], "k long, v string"))
    # value 3 is referred to by one key only, which is no looked-up key; nulls and unknown keys count for nothing
    facts = spark.range(5000).filter("id % 7 not in (3, 5) or id = 4994").select(F.col("id").alias("fk"))
    facts = facts.unionByName(spark.createDataFrame([(None,), (9000,), (77777,)], "fk long"))
    got = sorted(r.value for r in values_in_use(dim, "k", "v", facts, "fk", keys_a_value=2).collect())
    want = sorted(r.v for r in dim.join(facts, dim.k == facts.fk).select("v").filter("v is not null").distinct().collect())
    assert got == want and "3" in want and "5" not in want
    assert values_in_use(dim.limit(0), "k", "v", facts, "fk").count() == 0
    with pytest.raises(ValueError, match="more than 3"):
        values_in_use(dim, "k", "v", facts, "fk", max_values=3)


@pytest.mark.parametrize("key", ["filter_years_in_use", "filter_channels_in_use"])
def test_value_lists_shuffle_no_lines(spark, key):
    df = C.QUERIES[key](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "lineitem" not in plan  # the lines were looked up by broadcast, and every value was found


def test_row_counts_read_footers_only(spark):
    df = C.QUERIES["table_row_counts"](spark, SF)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert plan.count("ReadSchema: struct<>") == 7

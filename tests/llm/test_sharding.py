import zlib

import pytest
from pyspark.sql import functions as F

from closebook.llm.sharding import assign_shards, feistel

from . import cases


@pytest.mark.parametrize("count", [1, 2, 3, 5, 17, 1000, 4097])
def test_feistel_is_a_permutation(spark, count):
    got = [r.p for r in spark.range(count).select(feistel(F.col("id"), count, 7).alias("p")).collect()]
    assert sorted(got) == list(range(count))
    if count >= 1000:
        assert sum(abs(i - p) < count / 20 for i, p in enumerate(got)) < count / 4
        other = [r.p for r in spark.range(count).select(feistel(F.col("id"), count, 8).alias("p")).collect()]
        assert got != other


def check(df, rows, shards):
    got = df.collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(i, [])) for i in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert {r.law for r in got} <= {"rows"} and all(r.grown_shard is None for r in got)


def test_awkward_rows(spark):
    rows = cases.documents()
    check(assign_shards(cases.frame(spark, rows), 40), rows, 40)
    check(assign_shards(cases.frame(spark, rows), 7), rows, 7)


def test_a_third_of_all_rows_with_one_id(spark):
    rows = [(5 if i % 3 == 0 else i, "same", "en", "s") for i in range(600)]
    check(assign_shards(cases.frame(spark, rows, extra=False), 40), rows, 40)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    one, two = (sorted((r.doc_id, r.shard, r.slot) for r in assign_shards(d).collect()) for d in (docs, docs.repartition(11)))
    assert one == two


def test_empty_table(spark):
    assert assign_shards(cases.frame(spark, [])).count() == 0

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import topk
from closebook.llm.topk import block_topk, exact_topk, integer_vector

from . import cases


def brute(vectors, queries, k):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in vectors if ok(v) and i is not None]
    out = []
    for qid, q in sorted({(i, tuple(v)) for i, v in ints if queries(i)}):
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ints if i != qid and len(v) == len(q))
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def vectors():
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # one vector many times: ties
    rows += [(2000, None), (2001, [1.0] * 15 + [None]), (2002, [float("nan")] * 16), (2003, [float("inf")] + [0.0] * 15),
             (2004, []), (2100, []), (2005, [1.0, 2.0]), (2200, [0.5, -1.0]), (7, rows[7][1]), (None, rows[1][1])]
    return rows


@pytest.mark.parametrize("block", [8192, 60])
def test_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "'x' AS dim", "'y' AS q_block", "1 AS score").withColumn("vec", integer_vector(F.col("embedding")))
    got = exact_topk(df.filter("vec_id % 100 = 0"), df, 10)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, 10)


def test_testdata_matches_brute_force(spark):
    df = spark.read.parquet(f"{cases.SF}/embeddings.parquet").withColumn("vec", integer_vector(F.col("embedding")))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = exact_topk(df.filter("vec_id % 100 = 0"), df, 10)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 100 == 0, 10)


def test_integers_beyond_doubles_stay_exact():
    ids, x = np.arange(3), np.array([[2 ** 30 + 1, 1], [2 ** 30, 5], [2 ** 30, 4]])
    got = list(block_topk(np.array([9]), np.array([[2 ** 30 + 1, 1]]), ids, x, 2))
    assert got == [(0, 0, (2 ** 30 + 1) ** 2 + 1), (0, 1, 2 ** 30 * (2 ** 30 + 1) + 5)]


def test_fewer_candidates_and_empty_tables(spark):
    schema = "vec_id long, vec array<long>"
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, 4])], schema)
    assert list(map(tuple, exact_topk(df, df, 10).orderBy("query_id").collect())) == [(0, 1, 1, 11), (1, 1, 0, 11)]
    none = spark.createDataFrame([], schema)
    assert exact_topk(none, none).count() == 0 and exact_topk(df, none).count() == 0

from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from closebook.llm.common import materialize

from . import cases

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        steps[name] = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    first, second, third, last = steps.values()
    brute = cases.jaccard_brute(first, 5, 80, 100)
    assert sorted(r[0] for r in second) == sorted({c for _, n, c in brute if n} | {i for i, n, _ in brute if not n})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r[0] for r in cases.contamination_brute(second, items) if not r[5]]
    assert sorted(r[0] for r in third) == sorted(clean)
    copies = Counter(r[0] for r in last)
    assert set(copies) <= set(clean) and max(copies.values()) <= 3
    sizes = Counter()
    for r in third:
        sizes[r[3]] += len(cases.space_words(r[1]))
    taken = Counter()
    for r in last:
        taken[r[3]] += len(cases.space_words(r[1]))
    for source, target in cases.targets_brute(dict(sizes)).items():
        longest = max(len(cases.space_words(r[1])) for r in third if r[3] == source)
        assert abs(taken[source] - target) <= longest
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(copies.elements())


def test_quality_stage_keeps_most_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, sf).select("doc_id").collect()}
    rows = labels.collect()
    assert np.mean([r.doc_id in kept for r in rows if r.quality == 1]) > 0.97
    assert np.mean([r.doc_id in kept for r in rows if r.quality == 0]) < 0.2


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_awkward_rows_and_empty_tables(spark, stage):
    rows = [(*r, len(r[1] or "")) for r in cases.documents()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert stage(spark, spark.createDataFrame(rows, schema), SF).count() >= 0
    assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0

import numpy as np
import pytest

from closebook.llm.ngram_join import jaccard_components, keep_one_per_component
from closebook.llm.words import gram_hashes, texts_of, words_of

from . import cases


def found(df):
    return sorted(map(str, df.select("doc_id", "n_shingles", "component_id").collect()))


def expected(rows, k, num, den):
    from pyspark.sql import Row
    return sorted(str(Row(doc_id=a, n_shingles=b, component_id=c)) for a, b, c in cases.jaccard_brute(rows, k, num, den))


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
def test_components_match_brute_force(spark, k, num):
    rows = cases.documents()
    assert found(jaccard_components(cases.frame(spark, rows), k, (num, 100))) == expected(rows, k, num, 100)


def test_many_near_copies_that_link_only_in_chains(spark):
    """More copies than a token has hubs, each changed so much that only some pairs link."""
    base = cases.text(7, 150)
    rows = [(i, cases.changed(base, 1000 + i, 3), "en", "s") for i in range(150)]
    assert found(jaccard_components(cases.frame(spark, rows, extra=False), 4, (85, 100))) == expected(rows, 4, 85, 100)


def test_testdata_matches_brute_force(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(jaccard_components(docs, 4, (85, 100))) == expected(rows, 4, 85, 100)


def test_empty_table(spark):
    assert jaccard_components(cases.frame(spark, [])).count() == 0
    assert keep_one_per_component(cases.frame(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    kept = keep_one_per_component(docs)
    assert kept.columns == docs.columns
    brute = cases.jaccard_brute(rows, 5, 80, 100)
    blank = sum(n == 0 for _, n, _ in brute)
    groups = {c for _, n, c in brute if n}
    got = kept.select("doc_id", "text").collect()
    assert len(got) == blank + len(groups)
    assert {r.doc_id for r in got if cases.space_words(r.text)} == groups


def test_words_and_hashes_agree_with_regular_expressions():
    import pyarrow as pa
    texts = [r[1] for r in cases.documents()] + ["A" * 5_000_000, "x y " * 700_000, "é ß\tñ\x0bÉ"]
    for kind, split in (("space", cases.space_words), ("punct", cases.punct_words)):
        data, offs = texts_of(pa.array(texts))
        hashes, at = words_of(data, offs, kind)
        lists = [split(t) for t in texts]
        assert np.diff(at).tolist() == [len(x) for x in lists]
        seen = dict(zip((w for x in lists for w in x), hashes.tolist()))
        assert [seen[w] for x in lists for w in x] == hashes.tolist()
        assert len(set(seen.values())) == len(seen)
        one, _ = words_of(*texts_of(pa.array(texts[1:2])), kind)
        assert one.tolist() == hashes[at[1]:at[2]].tolist()
    assert len(gram_hashes(hashes[:3], 4)) == 0

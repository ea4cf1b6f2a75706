import hashlib
from collections import Counter, defaultdict

import pytest

from closebook.llm.mixing import mix_documents, mixture

from . import cases


def sizes_by_source(rows):
    out = defaultdict(int)
    for r in rows:
        out[r[3]] += len(cases.space_words(r[1]))
    return dict(out)


def taken_brute(rows, targets, sizes):
    """Copies by sorting each source's documents by hash and taking one after the other."""
    def key(r):
        name = f"{len(str(r[0]))}:{r[0]}" if r[0] is not None else "t"
        return hashlib.md5((name + (r[1] or "")).encode()).hexdigest()[:9]
    out = []
    for s in sizes:
        own = sorted((r for r in rows if r[3] == s), key=key)
        copies = int(targets[s] // sizes[s]) if sizes[s] else 1
        left, done = targets[s] - copies * sizes[s], 0
        for r in own:
            size = len(cases.space_words(r[1]))
            out.append((r, copies + (left > 0 and 2 * done + size <= 2 * left)))
            done += size
    return out


def check(spark, rows):
    sizes = sizes_by_source(rows)
    targets = cases.targets_brute(sizes)
    got = mixture(cases.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-9, abs=1e-9)
        assert r.taken <= 3 * r["size"] and r.copies <= 3
    brute = Counter((str(r[0]), len(cases.space_words(r[1])), c * len(cases.space_words(r[1])))
                    for r, c in taken_brute(rows, targets, sizes))
    assert Counter((str(r.doc_id), r["size"], r.taken) for r in got) == brute


def test_matches_sorting_and_repeated_sharing(spark):
    check(spark, cases.documents())


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, cases.text(i, 5 if i % 10 else 90), "en", ["a", "b", "c", "d", None][i % 5]) for i in range(300)]
    rows += [(1000 + i, cases.text(i, 3), "en", "zz") for i in range(4)]
    check(spark, rows)
    got = mixture(cases.frame(spark, rows, extra=False))
    by = {r.source: r for r in got.groupBy("source").agg({"target": "max", "taken": "sum", "source_size": "max", "size": "max"}).collect()}
    for r in by.values():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] / 2 + 1e-6
    assert by["zz"]["max(target)"] == 36.0


def test_testdata_and_reruns_with_other_partitions(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    one = sorted(map(tuple, mixture(docs).select("doc_id", "size", "target", "taken").collect()))
    two = sorted(map(tuple, mixture(docs.repartition(7)).select("doc_id", "size", "target", "taken").collect()))
    assert one == two


def test_rows_are_repeated_as_often_as_taken(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in mixture(docs).collect():
        copies[str(r.doc_id), r["size"]] += r.copies
    got = Counter((str(r.doc_id), len(cases.space_words(r.text))) for r in mixed.collect())
    assert got == +copies


def test_empty_table_and_texts(spark):
    assert mixture(cases.frame(spark, [])).count() == 0
    assert mix_documents(cases.frame(spark, [])).count() == 0
    got = mixture(cases.frame(spark, [(1, None, None, None), (2, "", "en", "a")])).collect()
    assert [(r["size"], r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


def test_a_hot_id_is_taken_in_part(spark):
    """200 rows of their own and 100 equal ones: the source meets its target to half a row."""
    rows = [(i, cases.text(i, 10), "en", "a") for i in range(200)] + [(7, "one two three four five six seven eight nine ten", "en", "a")] * 100
    rows += [(1000 + i, cases.text(i, 10), "en", "b") for i in range(300)]
    check(spark, rows)
    rows = [(7, "one two three four five six seven eight nine ten", "en", "a")] * 300
    rows += [(i, cases.text(i, 10), "en", s) for i in range(100) for s in ("b", "c")]
    docs = cases.frame(spark, rows).repartition(5)
    got = {r.source: (r[1], r[2]) for r in mixture(docs).groupBy("source").agg({"target": "max", "taken": "sum"}).collect()}
    assert all(abs(target - taken) <= 5 for taken, target in map(sorted, got.values())), got
    written = Counter(r.source for r in mix_documents(docs).collect())
    assert all(abs(10 * written[s] - max(got[s])) <= 10 for s in got), (written, got)
    assert written["a"] == 83  # a sixth of 5000 words, 10 a row


def test_rows_of_one_id_and_text_are_chosen_alike_whatever_the_partitions(spark):
    rows = [(7, "one two three four", f"l{i}", "a") for i in range(90)] + [(i, cases.text(i, 4), "en", "b") for i in range(90)]
    docs = cases.frame(spark, rows, extra=False)
    some = [sorted(map(str, mix_documents(docs.repartition(n)).collect())) for n in (2, 5)]
    assert some[0] == some[1] and 0 < sum("'l" in r for r in some[0]) < 90


def test_wordless_rows_of_a_source_at_its_limit_get_three_copies(spark):
    rows = [(i, "", "en", "z") for i in range(40)] + [(100, "a few words", "en", "z")]
    rows += [(200 + i, cases.text(i, 50), "en", "a") for i in range(40)]
    check(spark, rows)
    copies = {r.copies for r in mixture(cases.frame(spark, rows)).filter("source = 'z'").collect()}
    assert copies == {3}
    assert mix_documents(cases.frame(spark, rows)).filter("source = 'z'").count() == 41 * 3


def test_a_source_without_words_keeps_its_rows_once(spark):
    docs = cases.frame(spark, [(1, "", "en", "a"), (2, None, "en", "a"), (3, "some words", "en", "b")])
    assert sorted(r.doc_id for r in mix_documents(docs).filter("source = 'a'").collect()) == [1, 2]

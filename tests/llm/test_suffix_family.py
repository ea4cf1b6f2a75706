import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import suffix_family
from closebook.llm.suffix_family import HOT, SuffixFamily, blocks_of, remove_repeated_strings

from . import cases


def brute(rows, length):
    """(doc_id, n_bytes, spans, kept) of rows (doc_id, text); rows of one id have to be equal or short."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        hit = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            one = hashlib.blake2b(raw[i:i + length], digest_size=16).digest()
            if one in seen:
                hit[i:i + length] = True
            seen.add(one)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], hit)).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((doc_id, len(raw), spans, bytes(np.frombuffer(raw, np.uint8)[~hit[:-1]])))
    return out


def same(df, rows, length):
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, length)))


def pieced(seed, docs, letters, longest):
    """Documents put together from a few pieces, so that strings of all lengths repeat."""
    r = random.Random(seed)
    pieces = ["".join(r.choice(letters) for _ in range(r.randrange(1, 90))) for _ in range(30)]
    return [(i, "".join(r.choice(pieces) for _ in range(r.randrange(longest)))) for i in range(docs)]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("ord", "tie", "gen", "bin", "copy", "spans", "kind", "anchor", "block", "start", "reach", "kept", "several"):
        docs = docs.selectExpr("*", f"'clash' AS {name}")
    return docs


@pytest.mark.parametrize("length,gram,letters", [(20, 6, "abcdefgh"), (24, 24, "ab"), (9, 1, "abc"), (100, 32, "abcdeé日 ")])
def test_matches_brute_force(spark, length, gram, letters):
    rows = pieced(length, 120, letters, 12)
    rows += [(1000 + i, "x" * n) for i, n in enumerate((0, length - 1, length, length + 1, 5 * length))]
    rows += [(2000, "ab" * 200), (2001, "ab" * 150), (2002, None), (2003, ""), (None, "head " * 30), (2004, "head " * 30)]
    random.Random(1).shuffle(rows)
    same(remove_repeated_strings(frame(spark, rows).repartition(5), length, gram), rows, length)


def test_batches_do_not_change_the_result(spark):
    rows = pieced(7, 80, "abcdef", 10)
    docs = frame(spark, rows)
    for batches in (1, 3, 7):
        same(remove_repeated_strings(docs, 16, 5, batches), rows, 16)


def test_levels_merge_geometrically(spark):
    rows = pieced(8, 70, "abcdef", 8)
    family = SuffixFamily(spark, 16, 5)
    docs = spark.createDataFrame(rows, "ord long, text string").withColumn("tie", F.lit(0).cast("long"))
    sizes = []
    for i in range(7):
        family.add(docs.filter(F.col("ord").between(10 * i, 10 * i + 9)).select("ord", "tie", "text"))
        sizes.append([size for size, _, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    entries = [level.count() for _, _, level in family.levels]
    assert all(entries) and not set(family.levels[0][2].select("gen").distinct().toPandas()["gen"]) - {0, 1, 2, 3}
    found = family.removed(docs.withColumn("gen", (F.col("ord") / 10).cast("int")))
    got = {r["ord"]: {x for s in r.spans for x in range(s.start, s.start + s.reach)} for r in found.collect()}
    for doc_id, _, spans, _ in brute(rows, 16):
        assert got.get(doc_id, set()) == {x for a, b in spans for x in range(a, b)}


def test_common_passages_and_copies(spark):
    """A passage with other neighbours in every document (hot anchors), and many copies of one text."""
    passage, other = cases.text(1, 60), cases.text(2, 80)
    rows = [(i, f"{cases.text(100 + i, i % 7)} {passage} {cases.text(500 + i, 6)}") for i in range(8 * HOT)]
    rows += [(1000 + i, other) for i in range(150)]
    same(remove_repeated_strings(frame(spark, rows).repartition(3)), rows, 100)
    spread = frame(spark, rows).repartition(40)  # no batch of rows sees the anchors as hot
    same(remove_repeated_strings(spread), rows, 100)


def test_anchors_with_too_many_blocks_for_a_task(spark, monkeypatch):
    monkeypatch.setattr(suffix_family, "GROUP", 3)
    monkeypatch.setattr(suffix_family, "HOT", 10_000)
    rows = pieced(11, 150, "abcdef", 9)
    same(remove_repeated_strings(frame(spark, rows), 20, 6), rows, 20)


def test_repeated_ids(spark):
    text = cases.text(3, 50)
    rows = [(5, text)] * 40 + [(i, cases.text(i, 30)) for i in range(20) if i != 5] + [(None, None)] * 3 + [(7, "short")]
    same(remove_repeated_strings(frame(spark, rows).repartition(4)), rows, 100)


def test_long_texts(spark):
    long = cases.text(9, 70_000)
    rows = [(1, long), (2, cases.text(10, 20) + long[150_000:] + " end"), (3, "z" * 400_000), (4, long[262_000:262_200])]
    same(remove_repeated_strings(frame(spark, rows)), rows, 100)


def test_blocks_cover_every_window_once():
    r = np.random.default_rng(5)
    data = r.integers(97, 100, 5000).astype(np.uint8)
    offs = np.array([0, 30, 30, 1200, 1219, 4000, 5000])
    start, stop, anchor, block = blocks_of(data, offs, 20, 6)
    windows = np.concatenate([np.arange(a, b - 19) for a, b in zip(start, stop)])
    want = np.concatenate([np.arange(a, b - 19) for a, b in zip(offs, offs[1:]) if b - a >= 20])
    assert windows.tolist() == want.tolist()
    by = {}
    for a, b, x in zip(start, stop, block):
        assert by.setdefault(int(x), data[a:b].tobytes()) == data[a:b].tobytes()


def test_testdata_match_brute_force(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, 100)
    assert sum(bool(s) for _, _, s, _ in want) > 10
    same(remove_repeated_strings(docs), rows, 100)


def test_empty_table(spark):
    assert remove_repeated_strings(frame(spark, [])).collect() == []

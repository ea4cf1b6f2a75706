import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from closebook.llm.merkle import document_manifest, encoded, digest_of, merkle_manifest

from . import cases


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests: list[str], arity: int):
    """The root and each leaf's siblings, level by level."""
    proofs, nodes, owners = [[] for _ in digests], digests, [[i] for i in range(len(digests))]
    while len(nodes) > 1:
        runs = [range(lo, min(lo + arity, len(nodes))) for lo in range(0, len(nodes), arity)]
        for run in runs:
            for i in run:
                for o in owners[i]:
                    proofs[o].append((i - run[0], [nodes[j] for j in run if j != i]))
        owners = [[o for i in run for o in owners[i]] for run in runs]
        nodes = [h(*(nodes[i] for i in run)) for run in runs]
    return nodes[0], proofs


def fold(leaf, proof):
    for slot, sibs in proof:
        leaf = h(*sibs[:slot], leaf, *sibs[slot:])
    return leaf


def brute(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, text, lang, source, n_chars)."""
    def leaf_of(r, more=0):
        n = None if r[4] is None else r[4] + more
        return h(*map(enc, (r[0], r[3], r[2], n, r[1])))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    out, subroots, proofs = [], [], {}
    for lang in langs:
        mine = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        groups[lang] = mine
        sub, proofs[lang] = tree([leaf_of(r) for r in mine], arity)
        subroots.append(sub)
    if not rows:
        return []
    root, upper = tree(subroots, arity)
    for lang, sub, top in zip(langs, subroots, upper):
        for r, own in zip(groups[lang], proofs[lang]):
            proof = own + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = fold(leaf_of(r, int(bad)), proof)
            out.append((r[0], leaf_of(r), sub, root, h(*(s for _, sibs in proof for s in sibs)), folded, folded == root))
    return out


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("arity", [2, 3])
def test_awkward_rows_match_brute_force(spark, arity):
    rows = [(*r, None if r[1] is None else len(r[1])) for r in cases.documents()]
    rows += [(7 * i, "t", lang, None, None if i % 2 else 2 ** 63 - 1) for i, lang in enumerate(["é", "z", "", "Z", "日", "\U0001f600", "ﬀ"])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name in ("grp", "idx", "size", "digest", "slot", "parent", "sibs", "path", "leaf", "at", "key"):
        docs = docs.selectExpr("*", f"'clash' AS {name}")
    want = brute(rows, arity)
    assert any(not r[6] for r in want) and any(r[6] for r in want)
    same(document_manifest(docs, arity).collect(), want)


def test_testdata_match_brute_force(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()]
    got = document_manifest(docs).collect()
    same(got, brute(rows))
    bad = {r.doc_id for r in got if not r.verified}
    assert bad == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0}


def test_groups_of_every_shape_and_a_third_of_all_rows_equal(spark):
    sizes = [1, 2, 3, 4, 5, 8, 9, 16, 17]
    rows = [(100 * n + i, f"t{i}", f"l{n}", "s", i) for n in sizes for i in range(n)]
    rows += [(5, "same", "en", "s", 4)] * 40 + [(i, f"t{i}", "en", "s", None) for i in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same(document_manifest(docs).collect(), brute(rows))


def test_every_change_shows(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    leaves = docs.selectExpr("doc_id AS key", "lang AS grp_key", "text")
    roots = set()
    for text in ("text", "IF(key = 7, text || ' ', text)", "IF(key = 7, NULL, text)"):
        changed = leaves.selectExpr("key", "grp_key", f"{text} AS text")
        roots.add(merkle_manifest(changed.select("key", "grp_key", digest_of(encoded(F.col("key"), F.col("text"))).alias("leaf")))[1])
    assert len(roots) == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    got = document_manifest(docs)
    assert got.collect() == []
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

"""Operator 2: n-gram Jaccard join with prefix filters under several token orders.

Two texts link when the Jaccard similarity of their sets of word shingles
reaches a threshold. Under any global order of the tokens, two such sets share
a token among their first ``n - ceil(threshold * n) + 1`` ones (their prefix).

1. A histogram of shingle hashes over the whole corpus (fixed number of bins)
   gives the first order: rare bins first, so common passages come last.
2. Equal sets collapse into one *node*; its prefix under order one is dealt by
   token. Tokens with one node are dropped.
3. Every node of a token meets the token's hubs, about 64 of its nodes chosen by
   hash (all, if fewer): candidates stay linear in the rows, and large groups of
   near copies merge without listing their pairs. Length and position filters
   apply in the join.
4. Candidates must also share prefix tokens under two further (hash) orders;
   those left are verified on their whole sets, and linked nodes become
   components.
5. Tokens with more nodes that still lie in different components are joined
   with themselves across components only, then filtered and verified as
   before. After that no link between components is left out, so
   the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_histogram, materialize, packed, row_key
from .components import components
from .words import gram_hashes, mix, row_slices, texts_of, words_of

BINS = 1 << 20  # bins of the corpus histogram: 8 MB whatever the input
HUBS = 64  # expected hubs of a token; tokens of fewer nodes have all of them as hubs
ORDERS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)  # seeds of the further token orders


def shingle_hashes(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes with repeats) of each text; fewer words than ``k``: the sequence as one."""
    data, offs = texts_of(column)
    for lo, hi in row_slices(offs):
        words, at = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], "space")
        grams = gram_hashes(words, k)
        for i in range(hi - lo):
            a, b = int(at[i]), int(at[i + 1])
            yield lo + i, grams[a:b - k + 1] if b - a >= k else gram_hashes(words[a:b], b - a) if b > a else grams[:0]


def _prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def _signature(tokens: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits of a set; the first 64 name its node."""
    with np.errstate(over="ignore"):
        return (mix(np.array([tokens.sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64))[0],
                mix(tokens ^ np.uint64(ORDERS[0])).sum(dtype=np.uint64))


def _prefixes(docs: DataFrame, k: int, num: int, den: int, bins: np.ndarray) -> DataFrame:
    """Keys, n, node, sig and the prefix under order one of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(bins, (1 << 24) - 1).astype(np.uint32))

    def run(batches):
        counts = shared.value
        for batch in batches:
            n, node, sig, prefix = [], [], [], []
            for _, grams in shingle_hashes(batch.column(1), k):
                tokens = np.unique(grams)
                first = tokens[:0]
                if len(tokens):
                    rank = counts[(tokens >> np.uint64(44)).astype(np.int64)].astype(np.uint64) << np.uint64(40)
                    rank |= mix(tokens) >> np.uint64(24)
                    keep = _prefix_length(len(tokens), num, den)
                    first = tokens[np.argsort(rank, kind="stable")[:keep]]
                a, b = _signature(tokens)
                n.append(len(tokens))
                node.append(a)
                sig.append(b)
                prefix.append(first.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(n, pa.int64()), pa.array(np.array(node, np.uint64).view(np.int64)),
                 pa.array(np.array(sig, np.uint64).view(np.int64)),
                 _lists(prefix, np.int64)],
                names=["doc_id", "key_a", "key_b", "n", "node", "sig", "prefix"])

    return docs.mapInArrow(run, "doc_id long, key_a long, key_b int, n long, node long, sig long, "
                               "prefix array<long>")


def _smallest(ranks: np.ndarray, keep: int) -> np.ndarray:
    """Upper halves of the ``keep`` smallest ranks."""
    return (np.partition(ranks, keep - 1)[:keep] >> np.uint64(32)).astype(np.uint32)


def _lists(arrays: list[np.ndarray], kind: type) -> pa.Array:
    sizes = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([*arrays, np.zeros(0, kind)])))


def _whole_sets(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """node, n, the whole set (as bytes) and its prefixes under the further orders, of every text with words."""
    def run(batches):
        for batch in batches:
            sets = [np.unique(grams) for _, grams in shingle_hashes(batch.column(0), k) if len(grams)]
            orders = [[_smallest(mix(x ^ np.uint64(seed)), _prefix_length(len(x), num, den)).view(np.int32) for x in sets]
                      for seed in ORDERS]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(_signature(x)[0].astype(np.int64)) for x in sets], pa.int64()),
                 pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary()),
                 *(_lists(x, np.int32) for x in orders)], names=["node", "n", "tokens", "second", "third"])

    return texts.mapInArrow(run, "node long, n long, tokens binary, second array<int>, third array<int>")


def _verified(pairs: DataFrame, docs: DataFrame, table: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The candidate pairs (a, b) that pass the further orders and whose whole sets link.

    Sets are computed again, from one document of each candidate node.
    """
    pairs = materialize(pairs, "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = (table.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("rep_id"))
           .select("rep_id").distinct())
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi").select("text")
    sets = materialize(_whole_sets(texts, k, num, den).dropDuplicates(["node"]), "sets")
    side = lambda x: sets.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "tokens", "second", "third")))
    passed = (pairs.join(side("a"), "a").join(side("b"), "b")
              .filter((F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)
                      & F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
              .select("a", "b", "tokens_a", "tokens_b"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    return passed.mapInArrow(run, "a long, b long")


def _across(common: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of tokens that lie in more than one component, with their nodes' roots."""
    rooted = common.select("token", "node", "n", "pos").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    apart = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return rooted.join(apart.select("token"), "token", "left_semi")


def jaccard_components(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100),
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, component, key_a, key_b.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z lower-cased.
    Two rows link when ``den * |A & B| >= num * |A | B|`` for ``threshold =
    (num, den)`` on their sets of ``k``-word shingles. ``component_id`` is the
    smallest doc_id that links reach, the own one included; ``component`` names
    the component by the smallest set hash, also where ids are null; the keys
    identify the row by id and text (``common.row_key``).

    Null or empty texts, or texts without words: ``n_shingles`` 0 and linked
    with nothing (``component_id`` is the own doc_id, ``component`` null).
    Fewer than ``k`` words count as one shingle. A null doc_id takes part; its
    component_id is the component's smallest non-null id, or null. Repeated
    rows or ids give a row each. An empty table gives an empty result. Other
    columns of ``docs`` are not read.

    Sets are compared as 64-bit shingle hashes; nodes are named by 64-bit sums
    of them.
    """
    num, den = threshold
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = docs.select("*", *row_key(F.col("doc_id"), F.col("text")))

    def count(batch):
        for _, grams in shingle_hashes(batch.column(0), k):
            yield (grams >> np.uint64(44)).astype(np.int64)

    bins = bounded_histogram(docs.select("text"), count, BINS)
    table = materialize(_prefixes(keyed, k, num, den, bins), "prefixes")
    nodes = table.filter("n > 0").dropDuplicates(["node", "sig"])
    tokens = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("nodes")).filter("nodes > 1")
    common = materialize(tokens.join(counts, "token").withColumn(
        "hub", F.pmod(F.xxhash64("node"), F.lit(1 << 31)) * F.col("nodes") < HUBS << 31), "common")

    def candidates(rows, others, apart):
        one, two = rows.alias("one"), others.alias("two")
        c = lambda x: (F.col(f"one.{x}"), F.col(f"two.{x}"))
        left = [n - pos for n, pos in zip(c("n"), c("pos"))]
        return one.join(two, (F.col("one.token") == F.col("two.token")) & apart
                        & (F.least(*c("n")) * den >= F.greatest(*c("n")) * num)
                        & (F.least(*left) * (num + den) >= (F.col("one.n") + F.col("two.n")) * num)
                        ).select(F.least(*c("node")).alias("a"), F.greatest(*c("node")).alias("b")).distinct()

    once = ((F.col("one.node") < F.col("two.node"))
            | (~F.col("one.hub") & (F.col("one.node") != F.col("two.node"))))
    verify = lambda pairs: materialize(_verified(pairs, docs, table, k, num, den), "links")
    labels = components(verify(candidates(common, common.filter("hub"), once)))
    across = materialize(_across(common.filter(F.col("nodes") > HUBS), labels), "across")
    more = verify(candidates(across, across, F.col("one.root") < F.col("two.root")))
    labels = components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    members = table.select("doc_id", "n", "node", "key_a", "key_b").join(labels, "node", "left").withColumn(
        "component", F.when(F.col("n") > 0, F.coalesce("root", "node")))
    smallest = members.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return members.join(smallest, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
        "component", "key_a", "key_b")


def keep_one_per_component(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` (columns doc_id, text and any others) with one row of each component.

    The row with the smallest doc_id stays (null ids last; of equal ids the
    smallest text hash, of rows that repeat id and text any one). Rows without
    words all stay.
    """
    keyed = packed(docs, *row_key(F.col("doc_id"), F.col("text")))
    found = jaccard_components(docs, k, threshold)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key_a", "key_b")
    stay = (found.filter("component is not null").groupBy("component").agg(F.min(rank).alias("best"))
            .select("best.key_a", "best.key_b", F.lit(False).alias("blank"))
            .unionByName(found.filter("component is null").select("key_a", "key_b", F.lit(True).alias("blank"))
                         .distinct()))
    own = F.when(F.col("blank"), F.monotonically_increasing_id())
    return (keyed.join(stay, ["key_a", "key_b"]).withColumn("own", own)
            .dropDuplicates(["key_a", "key_b", "own"]).select("doc.*"))

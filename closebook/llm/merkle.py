"""Operator 13: Merkle manifest of a table, built with sibling-shift self-joins.

Rows are leaves, numbered inside their group (language) in the order of their
ids. On every level each node computes its siblings' indices (``index XOR 1``
in a binary tree, slot offsets otherwise) and finds them with an equijoin of
the level with itself; the rows of slot zero then hold all children of a run
and emit the parent. Levels shrink by the arity and are written once. The
groups' subroots are the leaves of one more tree of the same kind.

Proofs go the other way: a level's rows join their parents' paths, so a leaf
ends up with its siblings from its own level to the root. Every join key has at
most ``arity`` rows, whatever the groups' sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .sharding import row_numbers

BROADCAST_GROUPS = 100_000  # groups (a number, a digest) that may be broadcast; beyond, a join deals them

_PATH = "array<struct<slot:int,sibs:array<binary>>>"


def encoded(*values: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text; one after the other."""
    texts = [v.cast("string") for v in values]
    return F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _parent(digests: Column) -> Column:
    """The digest over an array of children's digests."""
    return digest_of(F.concat_ws("", F.transform(digests, hex_of)))


def _quotient(x: Column, arity: int) -> Column:
    return ((x - F.pmod(x, F.lit(arity))) / F.lit(arity)).cast("long")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (grp, idx, digest, ...) with slot, parent and ``sibs``: the other digests of their run, left to right."""
    slot = F.pmod("idx", F.lit(arity)).cast("int")
    out = nodes.withColumn("slot", slot).withColumn("parent", _quotient(F.col("idx"), arity))
    found = []
    for shift in range(1, arity):
        other = nodes.select(F.col("grp").alias("s_grp"), F.col("idx").alias("s_idx"), F.col("digest").alias(f"s{shift}"))
        there = F.pmod(F.col("slot") + shift, F.lit(arity))
        target = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("parent") * arity + there
        out = out.join(other, (F.col("grp") == F.col("s_grp")) & (target == F.col("s_idx")), "left").drop("s_grp", "s_idx")
        found.append(F.struct(there.cast("int").alias("slot"), F.col(f"s{shift}").alias("digest")))
    known = F.filter(F.array(*found), lambda s: s["digest"].isNotNull())
    sibs = F.transform(F.array_sort(known), lambda s: s["digest"])
    return out.withColumn("sibs", sibs).drop(*(f"s{i}" for i in range(1, arity)))


def _height(size: Column, arity: int, largest: int) -> Column:
    """Levels above a group's leaves: how often its nodes are put together until one is left."""
    powers, power = [], 1
    while power < largest:
        powers.append(power)
        power *= arity
    return sum(((size > p).cast("int") for p in powers), F.lit(0))


def climb(nodes: DataFrame, arity: int, largest: int, heights: set[int]) -> tuple[list[DataFrame], dict[int, DataFrame]]:
    """All levels of the groups' trees, and by height the single nodes left: the roots of the groups of that height.

    ``nodes``: grp, idx (from 0 without gaps), size (nodes in the group),
    digest and any other columns; ``largest``: the greatest size.
    """
    levels, tops = [], {}
    while True:
        if len(levels) in heights:
            tops[len(levels)] = nodes.filter("size = 1")
        if largest <= 1:
            return levels, tops
        level = materialize(_with_siblings(nodes.filter("size > 1"), arity), "level")
        levels.append(level)
        nodes = level.filter("slot = 0").select(
            "grp", F.col("parent").alias("idx"), _quotient(F.col("size") + (arity - 1), arity).alias("size"),
            _parent(F.concat(F.array("digest"), F.col("sibs"))).alias("digest"))
        largest = -(-largest // arity)


def descend(levels: list[DataFrame], tops: dict[int, DataFrame], start: DataFrame) -> DataFrame:
    """The first level's rows with ``path`` (their own level first) and ``subroot``.

    ``start``: grp, path and subroot of each group's root.
    """
    start = start.select(F.col("grp").alias("s_grp"), F.col("path"), "subroot")
    paths = None
    for height in range(len(levels), -1, -1):
        if paths is not None:
            above = paths.select(F.col("grp").alias("s_grp"), F.col("idx").alias("s_idx"), F.col("path").alias("above"), "subroot")
            paths = levels[height].join(above, (F.col("grp") == F.col("s_grp")) & (F.col("parent") == F.col("s_idx")))
            paths = paths.withColumn("path", F.concat(F.array(F.struct("slot", "sibs")), F.col("above"))).drop(
                "s_grp", "s_idx", "above", "slot", "sibs", "parent")
        if height in tops:
            roots = tops[height].join(start, F.col("grp") == F.col("s_grp")).drop("s_grp")
            paths = roots if paths is None else paths.unionByName(roots)
    return paths


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    def up(node: Column, step: Column) -> Column:
        left, right = F.slice(step["sibs"], F.lit(1), step["slot"]), F.slice(step["sibs"], step["slot"] + 1, F.size(step["sibs"]) + 1)
        return _parent(F.concat(left, F.array(node), right))
    return F.aggregate(path, leaf, up)


def merkle_manifest(leaves: DataFrame, arity: int = 2) -> tuple[DataFrame, bytes | None]:
    """Rows of ``leaves`` with ``subroot`` and ``path``, and the root (None for an empty table).

    ``leaves``: grp_key (the group; null is a group and comes first, others
    bytewise), key (order inside the group, null first), leaf (binary digest)
    and any further columns but those that this module adds (grp, idx, size,
    digest, slot, parent, sibs, path, subroot). Rows of one key are ordered by
    their leaf; equal rows are interchangeable and get a proof each. ``path``
    lists (slot, sibs) from the leaf's level up: the node's place in its run
    and the run's other digests. The driver receives one number, the largest
    group's size, and the root.
    """
    numbered = row_numbers(leaves, ["grp_key", "key", "leaf"], "place")
    groups = materialize(numbered.groupBy("grp_key").agg(F.min("place").alias("grp"), F.count("*").alias("size")), "groups")
    count, largest = groups.agg(F.count("*"), F.max("size")).first()
    if not count:
        return leaves.withColumn("subroot", F.lit(None).cast("binary")).withColumn("path", F.lit(None).cast(_PATH)), None
    heights = groups.agg(F.collect_set(_height(F.col("size"), arity, largest))).first()[0]  # one number a level at most
    sized = groups.select(F.col("grp_key").alias("g_key"), "grp", "size")
    sized = F.broadcast(sized) if count <= BROADCAST_GROUPS else sized
    nodes = numbered.join(sized, F.col("grp_key").eqNullSafe(F.col("g_key"))).drop("g_key")
    nodes = nodes.withColumn("idx", F.col("place") - F.col("grp")).drop("place").withColumn("digest", F.col("leaf"))
    levels, tops = climb(nodes, arity, largest, set(heights))

    subroots = None
    for top in tops.values():
        one = top.select(F.col("grp").alias("owner"), "digest")
        subroots = one if subroots is None else subroots.unionByName(one)
    ordered = row_numbers(subroots, ["owner"], "idx").select(
        F.lit(0).cast("long").alias("grp"), "idx", F.lit(count).cast("long").alias("size"), "digest", "owner")
    height = 0
    while arity ** height < count:
        height += 1
    upper, peak = climb(ordered, arity, count, {height})
    root = bytes(peak[height].select("digest").first()[0])
    whole = leaves.sparkSession.range(1).select(
        F.col("id").alias("grp"), F.array().cast(_PATH).alias("path"), F.lit(root).alias("subroot"))
    above = descend(upper, peak, whole).select(F.col("owner").alias("grp"), "path", F.col("digest").alias("subroot"))
    above = materialize(above, "subroots")
    return descend(levels, tops, above).drop("grp", "idx", "size", "digest"), root


def document_manifest(docs: DataFrame, arity: int = 2, divisor: int = 7) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``.

    A leaf hashes doc_id, source, lang, n_chars and text (``encoded``). Groups
    are languages. Where ``divisor`` divides the CRC-32 of the decimal doc_id,
    n_chars is raised by 1 (a null stays) after the manifest was made, and
    ``folded_root`` shows it: the root that the leaf as it is now and the
    original siblings give. ``verified``: it equals the root. Digests are
    lowercase hex; ``proof_sha256`` hashes the siblings from the leaf's level
    up, left to right in each run.

    Null ids come first in their language and are never tampered with; null
    languages are one group, the first; null texts, sources and counts are
    leaves of their own kind. Rows of one id are ordered by leaf, equal rows
    get a place and a proof each. Texts of any length are hashed where they are
    read and do not travel. An empty table gives no rows. Other columns are
    not read.
    """
    def leaf_of(n_chars: Column) -> Column:
        return digest_of(encoded(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")))

    n_chars = F.col("n_chars").cast("decimal(20,0)")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == 0
    leaves = docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("grp_key"), leaf_of(n_chars).alias("leaf"),
                         F.when(hit & n_chars.isNotNull(), leaf_of(n_chars + 1)).alias("changed"))
    proved, root = merkle_manifest(leaves, arity)
    root_hex = F.lit(root.hex() if root else None).cast("string")
    siblings = F.flatten(F.transform("path", lambda step: step["sibs"]))
    folded = hex_of(fold(F.coalesce("changed", "leaf"), F.col("path")))
    return proved.select(
        F.col("key").alias("doc_id"), hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"),
        root_hex.alias("root"), F.sha2(F.concat_ws("", F.transform(siblings, hex_of)), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))

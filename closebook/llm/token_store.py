"""Operator 6: token ids in binary shards with a minimal perfect hash index.

Files (Parquet as the container, so any store that Spark reads will do):

* ``blocks``: one row a block, in ascending order of keys: ``part``, ``block``,
  ``keys``, ``sizes`` (little-endian uint32, ids of each document with its end
  id), ``payload`` (the raw ids of all documents one after the other,
  little-endian, ``width`` bytes each). Blocks hold about ``BLOCK_IDS`` ids.
* ``index``: one row for each hash bucket of about ``BUCKET_KEYS`` keys. A
  minimal perfect hash numbers the bucket's keys without storing them; at that
  number stand the key's 32-bit fingerprint, its block and its ordinal there.

A key is (doc_id, nth): nth counts the rows that share an id from 0. A lookup
hashes the key, reads a few bits, compares the fingerprint and has the place of
the ids: constant time whatever the number of keys.
"""

from __future__ import annotations

import json
import os
import zlib
from itertools import compress
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import new_folder
from .words import mix

BLOCK_IDS = 1 << 20
BUCKET_KEYS = 50_000
CACHE = 1_000_000  # pieces whose ids a worker remembers (about 200 MB)
# fixed values: how the tokenizers that can be used piece by piece cut their texts, and the ASCII signs
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
GAMMA = 2.0  # slots a key on each level of the perfect hash


class Encoder:
    """Ids of texts, equal to the tokenizer's own; each distinct white-space separated piece is encoded once.

    This holds for tokenizers that compose (NFC), lower-case and blank out white
    space, cut at ``SPLIT`` and then encode each part by itself: they never join
    across white space, and cut between Latin letters or digits and the signs
    behind them. Latin letters alone go to a copy of the tokenizer without the
    steps that leave them as they are, many at once, as each word ends with
    the next token that closes one. Any other tokenizer gets whole texts, and so do
    texts with the control characters on which Python and the tokenizer differ
    about white space.
    """

    def __init__(self, tokenizer_json: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kind, self.cache = kind, {}
        self.by_piece = splits_at_blanks(tokenizer_json)
        if self.by_piece:
            self.of_words, letters = Tokenizer.from_str(tokenizer_json), ByteLevel(add_prefix_space=False, use_regex=False)
            self.of_words.normalizer, self.of_words.pre_tokenizer = None, WhitespaceSplit()
            self.bytewise = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _plain(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        out = []
        for lo in range(0, len(words), 2000):
            some = words[lo:lo + 2000]
            line = " ".join(some)
            line = line if line.isascii() else line.translate(self.bytewise)
            ids = np.array(self.of_words.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):  # a vocabulary that does not close words
                out += self._plain(some)
                continue
            raw, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of ``pieces``: Latin letters and the signs behind them are encoded each by themselves, others whole."""
        pieces = list(pieces)
        cores = [p.rstrip(SIGNS) for p in pieces]
        latin = [c.isalpha() and (c.isascii() or max(c) < "\u0100") for c in cores]
        others = [p for p, ok in zip(pieces, latin) if not ok]
        pieces, cores = list(compress(pieces, latin)), list(compress(cores, latin))
        tails = [p[len(c):] for p, c in zip(pieces, cores)]
        cores = [c.lower() for c in cores]
        cache, parts = self.cache, {"": b""}
        for some, encode in ((set(cores), self._words), (set(tails) - {""}, self._plain)):
            known = some - some.difference(cache)
            parts.update((x, cache[x]) for x in known)
            some = sorted(some - known, key=str.isascii)
            parts.update(zip(some, encode(some)))
        cache.update(zip(others, self._plain(others)))
        get = parts.__getitem__
        cache.update(zip(pieces, map(add, map(get, cores), map(get, tails))))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as raw bytes."""
        if not self.by_piece:
            return [self._plain([t])[0] for t in texts]
        odd = [any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        pieces, ends = [], [0]
        for t, o in zip(texts, odd):
            if not o:
                pieces += t.split()
            ends.append(len(pieces))
        ids = list(map(self.cache.get, pieces))
        missed = [i for i, x in enumerate(ids) if x is None]
        new = {pieces[i] for i in missed}
        if new:
            if len(self.cache) + len(new) > CACHE:  # keep what this batch uses
                self.cache = {p: x for p, x in zip(pieces, ids) if x is not None}
            self._learn(new)
            for i in missed:
                ids[i] = self.cache[pieces[i]]
        return [self._plain([t])[0] if o else b"".join(ids[i:j]) for t, i, j, o in zip(texts, ends, ends[1:], odd)]


def splits_at_blanks(tokenizer_json: str) -> bool:
    """Whether a tokenizer is of the kind whose pieces ``Encoder`` may encode one by one."""
    spec = json.loads(tokenizer_json)
    steps = lambda part, name: (part or {}).get(name) or [part or {}]
    normal, cuts = steps(spec.get("normalizer"), "normalizers"), steps(spec.get("pre_tokenizer"), "pretokenizers")
    model = spec.get("model") or {}
    return ([s.get("type") for s in normal] == ["NFC", "Replace", "Lowercase"]
            and normal[1].get("pattern") == {"Regex": r"\s+"} and normal[1].get("content") == " "
            and [s.get("type") for s in cuts] == ["Split", "ByteLevel"]
            and cuts[0].get("pattern") == {"Regex": SPLIT} and cuts[0].get("invert") is True and cuts[0].get("behavior") == "Removed"
            and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
            and model.get("type") == "BPE" and not model.get("dropout") and model.get("end_of_word_suffix") == "</w>"
            and not spec.get("truncation") and not spec.get("padding")
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or not any(map(str.isalnum, t["content"]))
                        or any(map(str.isspace, t["content"])) or t["content"].isalpha() for t in spec.get("added_tokens") or ()))


def _id_kind(tokenizer_json: str, end_id: int) -> str:
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(True), end_id + 1) <= 1 << 16 else "<u4"


def _pack(ordered: DataFrame, tokenizer_json: str, kind: str, end_id: int) -> DataFrame:
    # a worker keeps the broadcast dictionary, and so the encoder put into it, from task to task
    shared = ordered.sparkSession.sparkContext.broadcast({"json": tokenizer_json})

    def run(batches):
        from pyspark import TaskContext
        part, end, kept = TaskContext.get().partitionId(), np.array([end_id], kind).tobytes(), shared.value
        encode = kept.setdefault("encoder", None) or Encoder(kept["json"], kind)
        kept["encoder"] = encode
        width, block = len(end), 0
        keys, sizes, payload, held = [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([width], pa.int32()),
                 pa.array([held], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([np.array(sizes, "<u4").tobytes()]), pa.array([b"".join(payload)])],
                names=["part", "block", "width", "ids", "keys", "sizes", "payload"])

        for batch in batches:
            for lo in range(0, len(batch), 512):
                some = batch.slice(lo, 512)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for key, raw in zip(some.column(0).to_pylist(), encode(texts)):
                    keys.append(key)
                    sizes.append(len(raw) // width + 1)
                    payload += (raw, end)
                    held += sizes[-1]
                    if held >= BLOCK_IDS:
                        yield flush()
                        block, keys, sizes, payload, held = block + 1, [], [], [], 0
        if keys:
            yield flush()

    return ordered.mapInArrow(run, "part int, block int, width int, ids long, keys array<long>, sizes binary, payload binary")


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.withColumn("h", F.xxhash64("doc_id", "nth")).withColumn("mark", F.hash("nth", "doc_id", F.lit(6)))


def _slots(h: np.ndarray, mark: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = mix(np.array([level + 1], np.uint64))[0]
    return (mix(h ^ mix(mark.astype(np.uint64) ^ salt)) % np.uint64(size)).astype(np.int64)


def build_perfect_hash(h: np.ndarray, mark: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, all levels' bits, and the number of each key.

    On each level keys hash into twice as many slots as there are keys; those
    alone in their slot set its bit and are done, the others go on to the next
    level. A key's number is the count of bits set before its own.
    """
    sizes, bits, where = [], [], np.full(len(h), -1, np.int64)
    left, offset = np.arange(len(h)), 0
    while len(left):
        if len(sizes) > 200:
            raise ValueError("two keys share all 96 bits of their hash")
        size = max(64, int(GAMMA * len(left)))
        slot = _slots(h[left], mark[left], len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        done = alone[slot]
        where[left[done]] = offset + slot[done]
        sizes.append(size)
        bits.append(alone)
        left, offset = left[~done], offset + size
    flags = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(flags) - 1
    return sizes, flags, rank[where] if len(h) else where


def probe_perfect_hash(sizes: list[int], flags: np.ndarray, h: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The number of each key (of a key that is not in the index: any number, or -1)."""
    rank, out, offset = np.cumsum(flags) - 1, np.full(len(h), -1, np.int64), 0
    left = np.arange(len(h))
    for level, size in enumerate(sizes):
        at = offset + _slots(h[left], mark[left], level, size)
        found = flags[at]
        out[left[found]] = rank[at[found]]
        left, offset = left[~found], offset + size
    return out


_INDEX = "bucket int, buckets int, n int, levels array<int>, bits binary, marks binary, places binary, ordinals binary"


def _build_index(blocks: DataFrame) -> DataFrame:
    keys = blocks.select("part", "block", F.posexplode("keys").alias("ordinal", "doc_id"))
    order = W.partitionBy("doc_id").orderBy("part", "block", "ordinal")
    place = (F.col("part").cast("long") * F.lit(1 << 32) + F.col("block")).alias("place")
    keyed = _hashed(keys.select("doc_id", "ordinal", place, (F.row_number().over(order) - 1).alias("nth")))
    buckets = max(1, -(-(blocks.agg(F.sum(F.size("keys"))).first()[0] or 0) // BUCKET_KEYS))

    def run(key, table):
        h = table.column("h").to_numpy().view(np.uint64)
        mark = table.column("mark").to_numpy().view(np.uint32)
        sizes, flags, number = build_perfect_hash(h, mark)
        put = lambda x: np.asarray(x)[np.argsort(number)].tobytes()
        return pa.table({
            "bucket": pa.array([key[0].as_py()], pa.int32()), "buckets": pa.array([buckets], pa.int32()),
            "n": pa.array([len(h)], pa.int32()), "levels": pa.array([sizes], pa.list_(pa.int32())),
            "bits": [np.packbits(flags).tobytes()], "marks": [put(mark)],
            "places": [put(table.column("place").to_numpy())], "ordinals": [put(table.column("ordinal").to_numpy())]})

    dealt = keyed.select(F.pmod("h", F.lit(buckets)).cast("int").alias("bucket"), "h", "mark", "place", "ordinal")
    return dealt.groupBy("bucket").applyInArrow(run, _INDEX)


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every row of ``docs`` and write blocks and index; returns the folder.

    Rows stand in ascending order of doc_id (null first), rows with the same id
    in the order of their text's hash, each with its own nth. Null texts are
    encoded as empty: the end id alone. An empty table gives empty files. The
    tokenizer's file is read here and sent to the tasks (a few MB, whatever the
    corpus). Other columns are not read.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-store")
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer_json = f.read()
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(*keys).sortWithinPartitions(*keys))
    packed = _pack(ordered, tokenizer_json, _id_kind(tokenizer_json, end_id), end_id)
    packed.write.option("compression", "zstd").parquet(f"{path}/blocks")
    blocks = spark.read.schema(packed.schema).parquet(f"{path}/blocks")
    _build_index(blocks).write.parquet(f"{path}/index")
    return path


_BLOCKS = "part int, block int, width int, ids long, keys array<long>, sizes binary, payload binary"


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, nth, place, ordinal of the keys (doc_id, nth) that the index has, one row for each row of ``keys``."""
    index = spark.read.schema(_INDEX).parquet(f"{path}/index")
    buckets = (index.agg(F.max("buckets")).first()[0]) or 1
    asked = _hashed(keys.select("doc_id", F.col("nth").cast("int").alias("nth"))).withColumn(
        "bucket", F.pmod("h", F.lit(buckets)).cast("int"))
    schema = "doc_id long, nth int, place long, ordinal int"
    names = ["doc_id", "nth", "place", "ordinal"]

    def run(asked, index):
        if not len(asked) or not len(index):
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int32(), pa.int64(), pa.int32()))})
        get = lambda name, kind: np.frombuffer(index.column(name)[0].as_py(), kind)
        sizes = index.column("levels")[0].as_py()
        flags = np.unpackbits(get("bits", np.uint8))[:sum(sizes)].view(bool)
        mark = asked.column("mark").to_numpy().view(np.uint32)
        number = probe_perfect_hash(sizes, flags, asked.column("h").to_numpy().view(np.uint64), mark)
        ok = (number >= 0) & (get("marks", np.uint32)[np.maximum(number, 0)] == mark)
        some, number = asked.filter(pa.array(ok)), number[ok]
        return pa.table({"doc_id": some.column("doc_id"), "nth": some.column("nth"),
                         "place": pa.array(get("places", np.int64)[number]),
                         "ordinal": pa.array(get("ordinals", np.int32)[number])})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(run, schema)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    place = F.col("part").cast("long") * F.lit(1 << 32) + F.col("block")
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").withColumn("place", place)


def fetch(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, nth, ids (array<long>, with the end id) of the given keys through the index."""
    found = lookup(spark, path, keys).groupBy("place").agg(F.collect_list(F.struct("doc_id", "nth", "ordinal")).alias("want"))
    joined = _blocks(spark, path).join(found, "place").select("width", "sizes", "payload", "want")

    def run(batches):
        for batch in batches:
            for width, sizes, payload, want in zip(*(c.to_pylist() for c in batch.columns)):
                ids, ends = np.frombuffer(payload, f"<u{width}"), np.cumsum(np.frombuffer(sizes, "<u4"))
                for w in want:
                    end = ends[w["ordinal"]]
                    start = ends[w["ordinal"] - 1] if w["ordinal"] else 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([w["doc_id"]], pa.int64()), pa.array([w["nth"]], pa.int32()),
                         pa.array([ids[start:end].astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "nth", "ids"])

    return joined.mapInArrow(run, "doc_id long, nth int, ids array<long>")


def digests(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, nth of the given keys, from the files.

    Blocks are read in place and digested document by document; the index says
    which of these a key is. ``start``: ids of all documents before.
    """
    blocks = _blocks(spark, path)

    def run(batches):
        for batch in batches:
            for place, width, sizes, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(payload, f"<u{width}").astype("<u4")
                sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(crc), place)), pa.array(np.arange(len(crc), dtype=np.int32)),
                     pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["place", "ordinal", "inside", "n_tokens", "ids_crc32"])

    read = blocks.select("place", "width", "sizes", "payload").mapInArrow(
        run, "place long, ordinal int, inside long, n_tokens long, ids_crc32 long")
    # offsets: sums by part (few rows), then inside each part
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before(W.orderBy("part")).alias("part_start"))
    starts = blocks.select("part", "place", before(W.partitionBy("part").orderBy("block")).alias("block_start"), "ids").join(
        parts, "part").select("place", (F.col("part_start") + F.col("block_start")).alias("from"))
    return (lookup(spark, path, keys).join(read, ["place", "ordinal"]).join(starts, "place")
            .select("doc_id", (F.col("from") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "nth"))


def document_keys(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, nth) of every row."""
    w = W.partitionBy("doc_id").orderBy("doc_id")
    return docs.select(F.col(id_col).cast("long").alias("doc_id")).withColumn("nth", F.row_number().over(w) - 1)


def encode_and_read_back(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the store for ``docs`` and return doc_id, start, n_tokens, ids_crc32, nth of every row from its files."""
    path = write_store(docs, tokenizer_path, end_id)
    return digests(docs.sparkSession, path, document_keys(docs))

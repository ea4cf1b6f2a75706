"""Operator 5: benchmark decontamination by winnowing.

Documents and benchmark items keep the smallest hash of 5-word grams in every
run of 9 grams (the last one on ties). A span of 13 words shared by both holds
such a run, and both sides keep the same gram of it, so every shared span of 13
words has a common fingerprint. Items of fewer words are one gram of their own
length, of which documents keep all. Fingerprints are joined, and each hit is
extended by comparing the words around it on both sides, which hold every
window that the fingerprint can lie in; runs as long as a window count. Each
pair is a row of its own and is verified before anything is collected, so a gram
that stands in every item fills no list.

Documents keep only fingerprints that fall into bins which the benchmark uses,
a bit map of fixed size whatever the benchmark's size; the join is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_histogram, materialize, packed, row_key
from .words import gram_hashes, row_slices, texts_of, words_of

GRAM = 5
BINS = 1 << 22  # bit map of the benchmark's fingerprints: 512 KB
DOC_FILL, ITEM_FILL = 0, 1  # beyond the ends of a text: equal to nothing


def winnow(grams: np.ndarray, run: int) -> np.ndarray:
    """Positions of the smallest of every ``run`` consecutive grams, the last one on ties."""
    if len(grams) < run:
        return np.zeros(0, np.int64)
    back = np.lib.stride_tricks.sliding_window_view(grams, run)[:, ::-1]
    return np.unique(np.arange(len(back)) + run - 1 - back.argmin(axis=1))


def _item_fingerprints(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and their word positions of one benchmark item."""
    if not len(words):
        return words, np.zeros(0, np.int64)
    if len(words) < window:
        return gram_hashes(words, len(words)), np.zeros(1, np.int64)
    grams = gram_hashes(words, gram)
    at = winnow(grams, window - gram + 1)
    return grams[at], at


def contexts(words: np.ndarray, at: np.ndarray, window: int, gram: int, fill: int) -> np.ndarray:
    """The words around each position, one row each: any window that holds the gram there lies in
    ``window - gram`` words before it and ``window`` from it on. ``fill`` stands beyond the text's ends."""
    place = np.asarray(at, np.int64)[:, None] + np.arange(gram - window, window)
    inside = (place >= 0) & (place < len(words))
    return np.where(inside, words[np.where(inside, place, 0)] if len(words) else np.uint64(fill), np.uint64(fill))


def _raw_rows(table: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in table]


def _items(benchmark: DataFrame, window: int, gram: int) -> DataFrame:
    """item_id, number of words, and every fingerprint with the words around it."""
    def run(batches):
        for batch in batches:
            counts, marks = [], []
            data, offs = texts_of(batch.column(1))
            for lo, hi in row_slices(offs):
                all_words, at = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], "punct")
                for a, b in zip(at[:-1], at[1:]):
                    counts.append(int(b - a))
                    prints, places = _item_fingerprints(all_words[a:b], window, gram)
                    around = _raw_rows(contexts(all_words[a:b], places, window, gram, ITEM_FILL))
                    marks.append([{"print": int(p), "around": x} for p, x in zip(prints.view(np.int64), around)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int32()),
                 pa.array(marks, pa.list_(pa.struct([("print", pa.int64()), ("around", pa.binary())])))],
                names=["item_id", "n_words", "marks"])

    return benchmark.mapInArrow(run, "item_id string, n_words int, marks array<struct<print:long,around:binary>>")


def _documents(docs: DataFrame, used: np.ndarray, short: list[int], window: int, gram: int) -> DataFrame:
    """Every row with its word count and its fingerprints in used bins; the text only where there are any."""
    bits = docs.sparkSession.sparkContext.broadcast(np.packbits(used))

    def run(batches):
        taken = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            counts, marks, keep = [], [], []
            data, offs = texts_of(batch.column(3))
            for lo, hi in row_slices(offs):
                words, at = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], "punct")
                owner = np.repeat(np.arange(hi - lo), np.diff(at))
                found = []
                for length, span in [(gram, window)] + [(m, m) for m in short]:
                    grams = gram_hashes(words, length)
                    places = winnow(grams, window - gram + 1) if span == window else np.arange(len(grams))
                    # winnowing across texts only adds places; those of grams that cross texts go
                    places = places[taken[(grams[places] >> np.uint64(42)).astype(np.int64)]]
                    places = places[owner[places] == owner[places + length - 1]]
                    found += [(int(owner[p]), int(p - at[owner[p]]), int(grams[p].astype(np.int64))) for p in places]
                mine: dict[int, list] = {}
                for row, place, mark in found:
                    mine.setdefault(row, []).append({"print": mark, "at": place})
                counts += np.diff(at).tolist()
                marks += [mine.get(i, []) for i in range(hi - lo)]
                keep += [i in mine for i in range(hi - lo)]
            text = pa.compute.if_else(pa.array(keep, pa.bool_()), batch.column(3), pa.scalar(None, batch.column(3).type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(counts, pa.int64()), text,
                 pa.array(marks, pa.list_(pa.struct([("print", pa.int64()), ("at", pa.int32())])))],
                names=["doc_id", "key_a", "key_b", "n_words", "text", "marks"])

    return docs.mapInArrow(run, "doc_id long, key_a long, key_b int, n_words long, text string, "
                                "marks array<struct<print:long,at:int>>").withColumn(
        "row", F.monotonically_increasing_id())


def extend(doc: np.ndarray, item: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First column and length of the run of at least ``need`` equal words in each pair of contexts (length 0: none).

    A context has room for one such run only: it is shorter than two windows.
    """
    same = doc == item
    ahead, behind = np.zeros(same.shape, np.int64), np.zeros(same.shape, np.int64)
    last = same.shape[1] - 1
    for i in range(last + 1):
        ahead[:, i] = np.where(same[:, i], (ahead[:, i - 1] if i else 0) + 1, 0)
        j = last - i
        behind[:, j] = np.where(same[:, j], (behind[:, j + 1] if i else 0) + 1, 0)
    long = same & (ahead + behind - 1 >= need[:, None])
    return long.argmax(1), long.sum(1)


def _around(found: DataFrame, window: int, gram: int) -> DataFrame:
    """(row, print, at, around) from rows (row, text, marks)."""
    def run(batches):
        for batch in batches:
            for i, (row, marks) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                data, offs = texts_of(batch.column(1).slice(i, 1))
                words, _ = words_of(data, offs, "punct")
                for lo in range(0, len(marks), 10_000):
                    some = marks[lo:lo + 10_000]
                    at = [m["at"] for m in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(some), pa.int64()), pa.array([m["print"] for m in some], pa.int64()), pa.array(at, pa.int32()),
                         pa.array(_raw_rows(contexts(words, np.array(at), window, gram, DOC_FILL)), pa.binary())],
                        names=["row", "print", "at", "around"])

    return found.mapInArrow(run, "row long, print long, at int, around binary")


def _extended(pairs: DataFrame, window: int, gram: int) -> DataFrame:
    """(row, item_id, lo, hi) of the pairs (row, at, around, item_id, n_words, item_around) that share a window."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            doc, item = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(batch), -1) for c in (2, 5))
            first, size = extend(doc, item, np.minimum(batch.column(4).to_numpy(), window))
            lo = batch.column(1).to_numpy() + first - (window - gram)
            keep = pa.array(size > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(3).filter(keep), pa.array(lo.astype(np.int32)).filter(keep),
                 pa.array((lo + size).astype(np.int32)).filter(keep)], names=["row", "item_id", "lo", "hi"])

    return pairs.select("row", "at", "around", "item_id", "n_words", "item_around").mapInArrow(
        run, "row long, item_id string, lo int, hi int")


def _covered(spans: Column) -> Column:
    """How many places a sorted array of (lo, hi) spans covers."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda done, x: F.struct(
        (done["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], done["end"]))).cast("long").alias("n"),
        F.greatest(done["end"], x["hi"]).alias("end"))
    return F.aggregate(spans, start, step, lambda done: done["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, gram: int = GRAM,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, key_a, key_b of every row of ``docs``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A
    document word inside any occurrence of ``window`` consecutive words of an
    item (of the whole item, if it has fewer words) is hit; a row is
    contaminated if a word is hit and ``share * n_hit >= n_words``.
    ``items_sha256`` hashes the ids of the items found, sorted as strings and
    comma-joined (none: the hash of the empty string).

    Null texts have no words and no hits; items without words match nothing.
    An item with a null id counts, with an empty id. Repeated documents get a
    row each, repeated items count once by id. Empty tables give no rows, or
    rows without hits. Other columns are not read; the keys identify the row
    by id and text (``common.row_key``).
    """
    items = materialize(_items(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text"), window, gram), "items")
    marks = items.select("item_id", "n_words", F.explode("marks").alias("m")).select(
        "item_id", "n_words", "m.print", F.col("m.around").alias("item_around")).distinct()
    used = bounded_histogram(
        marks.select("print"), lambda batch: iter([(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(42)).astype(np.int64)]),
        BINS) > 0
    short = [r[0] for r in items.select(F.col("n_words").alias("n"))
             .filter((F.col("n") > 0) & (F.col("n") < window)).distinct().collect()]  # at most window - 1 numbers
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = keyed.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    table = materialize(_documents(keyed, used, sorted(short), window, gram), "fingerprints")

    shared = (table.select("row", F.explode("marks").alias("m")).select("row", "m.print", "m.at")
              .join(marks.select("print").distinct(), "print", "left_semi")
              .groupBy("row").agg(F.collect_list(F.struct("print", "at")).alias("marks")))  # at most the row's own
    around = _around(table.select("row", "text").join(shared, "row").select("row", "text", "marks"), window, gram)
    spans = _extended(around.join(marks, "print"), window, gram)
    ids = F.sort_array(F.collect_set(F.coalesce("item_id", F.lit(""))))
    found = spans.groupBy("row").agg(ids.alias("ids"), F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans")).select(
        "row", _covered(F.col("spans")).alias("n_hit"), F.size("ids").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return table.select("row", "doc_id", "n_words", "key_a", "key_b").join(found, "row", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"), "key_a", "key_b")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without contaminated rows."""
    bad = contamination(docs, benchmark).filter("contaminated").select("key_a", "key_b").distinct()
    keyed = packed(docs, *row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(bad, ["key_a", "key_b"], "left_anti").select("doc.*")

"""Operator 11: removal of long repeated byte strings with a logarithmic family of suffix arrays.

Batches of documents arrive in their order. Each batch gets a sorted array of
its suffixes, which is merge-scanned, in one pass over sorted runs, with those
of the levels that exist; levels of equal size merge into one of the next size
in the same pass, so a suffix is rewritten a logarithmic number of times.

The arrays are sparse. Every window of ``length`` bytes has an anchor: of its
``GRAM``-byte strings the one with the smallest hash, the first of equals, which
depends on the window's content alone. Neighbouring windows with one anchor are
a block, on average one for every 30 to 35 bytes, and an array's entry stands for
a block: it is sorted by the hash of the anchor, then by that of the whole block
(128 bits), then by position. Entries with equal blocks are long matches, and
all but the first position are removed whole. Windows can also agree where
blocks differ, but then their anchors agree: blocks of an anchor with several
different blocks are cut out of the texts, dealt by anchor, and their windows
compared one by one by their hashes, so no match of ``length`` bytes is lost. No
text is moved but those that hold such blocks.

Equal blocks are thinned where they are read: a task sends on one entry of each,
and the rest as removed spans. Anchors with ``HOT`` blocks or more in one batch
of rows leave a mark in the arrays, and their blocks' windows are dealt by their
own hashes instead, as are those of anchors with more than ``GROUP`` blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, new_folder
from .words import _tables, mix, row_slices, texts_of

LENGTH = 100
GRAM = 32
BATCHES = 4
PIECE = 1 << 17  # bytes hashed at a time; windows of longer texts are dealt over pieces
HOT = 16
GROUP = 20_000  # blocks of one anchor that a task compares; beyond, their windows are dealt
MARK = -(1 << 63)  # the block hash of a mark: first of its anchor
BINS = 1 << 20  # of the table of texts needed again, which is broadcast
REPEATED_IDS = 100_000  # ids on several rows that may be broadcast; beyond, a join deals them

ENTRY, SPAN, ASK = 0, 1, 2  # kinds of rows: array entries, removed spans, blocks whose windows are to be compared
_ROWS = "kind int, anchor long, block long, gen int, ord long, tie long, start int, reach int"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
_PLACE = 21  # low bits of a key that hold a position


def _sums(data: np.ndarray) -> tuple[np.ndarray, dict]:
    table = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table["byte"][data] * table["up"][:len(data)], out=sums[1:])
    return sums, table


def blocks_of(data: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """start, stop, anchor hash and block hash of all blocks of the texts in a buffer of at most 2^21 bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    sums, table = _sums(data)
    grams = len(data) - gram + 1
    hashes = mix((sums[gram:] - sums[:grams]) * table["down"][:grams])
    place = np.uint64((1 << _PLACE) - 1)
    least = (hashes & ~place) | np.arange(grams, dtype=np.uint64)
    run, span = length - gram + 1, 1
    while span * 2 <= run:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if run > span:
        least = np.minimum(least[:len(least) - (run - span)], least[run - span:])
    ends = np.repeat(offs[1:], np.diff(offs))[:len(least)]
    at = np.flatnonzero(np.arange(len(least)) + length <= ends)  # windows inside one text
    if not len(at):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    anchor = (least[at] & place).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))))
    start, stop, anchor = at[new], at[np.concatenate((new[1:] - 1, [len(at) - 1]))] + length, anchor[new]
    shape = ((anchor - start) << 32 | (stop - start)).astype(np.uint64)
    block = mix((sums[stop] - sums[start]) * table["down"][start] + mix(shape))
    return start, stop, hashes[anchor], np.where(block == np.uint64(1 << 63), np.uint64(1), block)


def windows_of(data: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Two hashes (n x 2) of the windows that begin at ``start``."""
    sums, table = _sums(data)
    plain = (sums[start + length] - sums[start]) * table["down"][start]
    return np.stack((mix(plain), mix(plain * np.uint64(0xD6E8FEB86659FD93) + np.uint64(length))), 1)


def _pieces(offs: np.ndarray, length: int):
    """(first row, last row, first byte, last byte): rows together, or one long row's windows cut into pieces."""
    for lo, hi in row_slices(offs, PIECE):
        a, b = int(offs[lo]), int(offs[hi])
        if b - a <= 2 * PIECE:
            yield lo, hi, a, b
        else:
            for x in range(a, max(a + 1, b - length + 1), PIECE):
                yield lo, hi, x, min(b, x + PIECE + length - 1)


def _batch(kind, anchor, block, doc, row, start, reach) -> pa.RecordBatch:
    whole = lambda x, t: pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x, t)
    return pa.RecordBatch.from_arrays(
        [whole(kind.astype(np.int32), pa.int32()), whole(anchor, pa.int64()), whole(block, pa.int64()),
         *(whole(x[row], t) for x, t in zip(doc, (pa.int32(), pa.int64(), pa.int64()))), whole(start.astype(np.int32), pa.int32()), whole(reach.astype(np.int32), pa.int32())],
        names=_NAMES)


def _merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (row, start, stop) put together where they touch."""
    if not len(row):
        return row, start, stop
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    base = row.astype(np.int64) << 33
    reach = np.maximum.accumulate(base + stop)
    new = np.concatenate(([True], base[1:] + start[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(row) - 1]))
    return row[new], start[new], reach[last] - base[last]


def _thinned(doc, row, start, reach, anchor, block, hot: int | None):
    """Rows of one batch of documents (gen, ord, tie): the first entry of each block, spans for the others, ASK and marks for hot anchors."""
    order = np.lexsort(doc[::-1])
    rank = np.empty(len(order), np.int64)  # place of the batch's rows in the order of documents; equal rows share one
    rank[order] = np.cumsum(np.concatenate(([True], np.any([x[order][1:] != x[order][:-1] for x in doc], axis=0)))) - 1
    placed = rank[row] << 32 | start
    if (np.diff(placed) < 0).any():
        order = np.argsort(placed, kind="stable")
        row, start, reach, anchor, block = (x[order] for x in (row, start, reach, anchor, block))
    order = np.lexsort((block, anchor))
    row, start, reach, anchor, block = (x[order] for x in (row, start, reach, anchor, block))
    same_anchor = np.concatenate(([False], anchor[1:] == anchor[:-1]))
    same = same_anchor & np.concatenate(([False], block[1:] == block[:-1]))
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(row))))
    again = same & ((rank[row] != rank[row[first]]) | (start != start[first]))  # not the same place of an equal row
    s_row, s_start, s_stop = _merged(row[again], start[again], start[again] + reach[again])
    yield _batch(np.full(len(s_row), SPAN), mix(s_row.astype(np.uint64) * np.uint64(PIECE) + s_start.astype(np.uint64)),
                 np.zeros(len(s_row), np.int64), doc, s_row, s_start, s_stop - s_start)
    keep = np.flatnonzero(~same)
    group = np.cumsum(~same_anchor[keep]) - 1
    kind = np.full(len(keep), ENTRY)
    if hot is not None and len(keep):
        many = np.bincount(group)[group] >= hot
        kind[many] = ASK
        marks = keep[many & np.concatenate(([True], group[1:] != group[:-1]))]
        yield _batch(np.full(len(marks), ENTRY), anchor[marks], np.full(len(marks), MARK, np.int64), doc, row[marks],
                     start[marks], reach[marks])
        block[keep[many]] = np.uint64(1 << 63)  # asked for as blocks of a marked anchor
    yield _batch(kind, anchor[keep], block[keep], doc, row[keep], start[keep], reach[keep])


def _suffixes(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Entries, spans and questions of documents (gen, ord, tie, text)."""
    def run(batches):
        for batch in batches:
            doc = [batch.column(i).to_numpy() for i in range(3)]
            data, offs = texts_of(batch.column(3))
            found = []
            for lo, hi, a, b in _pieces(offs, length):
                inner = np.clip(offs[lo:hi + 1], a, b) - a
                start, stop, anchor, block = blocks_of(data[a:b], inner, length, gram)
                row = np.searchsorted(inner, start, "right") - 1 + lo
                found.append((row, start + a - offs[row], stop - start, anchor, block))
            if found:
                yield from _thinned(doc, *(np.concatenate(x) for x in zip(*found)), HOT)

    return docs.select("gen", "ord", "tie", "text").mapInArrow(run, _ROWS)


_CUTS = _ROWS + ", bytes binary"


def _cut_out(asked: DataFrame, length: int) -> DataFrame:
    """Blocks asked for, with their bytes (kind ASK), and the windows of blocks of marked anchors (ENTRY, SPAN).

    ``asked``: gen, ord, tie, text, blocks (anchor, start, reach, spread).
    """
    def run(batches):
        for batch in batches:
            doc = [batch.column(i).to_numpy() for i in range(3)]
            data, offs = texts_of(batch.column(3))
            blocks = batch.column(4)
            row = np.repeat(np.arange(len(batch)), np.diff(blocks.offsets.to_numpy()))
            anchor, start, reach = (blocks.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            spread = blocks.flatten().field(3).to_numpy(zero_copy_only=False).astype(bool)
            lo, hi = offs[row] + start, offs[row] + start + reach
            raw = data.tobytes()
            plain = np.flatnonzero(~spread)
            out = _batch(np.full(len(plain), ASK), anchor[plain], np.zeros(len(plain), np.int64), doc, row[plain], start[plain], reach[plain])
            yield _with_bytes(out, [raw[i:j] for i, j in zip(lo[plain].tolist(), hi[plain].tolist())])
            some = np.flatnonzero(spread)
            if len(some):
                some = some[np.lexsort((start[some], row[some]))]
                window, of, first, second = _window_hashes([raw[i:j] for i, j in zip(lo[some].tolist(), hi[some].tolist())], length)
                where = some[of]
                for out in _thinned(doc, row[where], start[where] + window, np.full(len(of), length), first, second, None):
                    yield _with_bytes(out, [None] * len(out))

    return asked.select("gen", "ord", "tie", "text", "blocks").mapInArrow(run, _CUTS)


def _with_bytes(batch: pa.RecordBatch, raw: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*_NAMES, "bytes"])


def _window_hashes(blocks: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Of all windows of ``blocks``, in their order: place in the block, number of the block, two hashes."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    out, lo = [], 0
    step = max(1, PIECE // max(length, int(sizes.max(initial=1))))
    while lo < len(blocks):
        hi = min(len(blocks), lo + step)
        count = sizes[lo:hi] - length + 1
        begins = np.concatenate(([0], np.cumsum(sizes[lo:hi])[:-1]))
        of = np.repeat(np.arange(hi - lo), count)
        window = np.arange(len(of)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
        hashes = windows_of(np.frombuffer(b"".join(blocks[lo:hi]), np.uint8), begins[of] + window, length)
        out.append((window, of + lo, hashes[:, 0], hashes[:, 1]))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*out))


def _compared(blocks: DataFrame, length: int) -> DataFrame:
    """Spans of windows that stand earlier in another block of their anchor; windows of anchors with too many blocks."""
    def compare(anchor, doc, start, raw):
        window, of, first, second = _window_hashes(raw, length)
        order = np.lexsort((second, first, anchor[of]))  # stable: equal windows stay in the order of their places
        a, x, y = anchor[of][order], first[order], second[order]
        again = order[1:][(a[1:] == a[:-1]) & (x[1:] == x[:-1]) & (y[1:] == y[:-1])]
        at = start[of[again]] + window[again]
        row, lo, hi = _merged(of[again], at, at + length)
        return _batch(np.full(len(row), SPAN), mix(row.astype(np.uint64) + np.uint64(1)), np.zeros(len(row), np.int64), doc, row, lo, hi - lo)

    def windows(doc, start, raw):
        window, of, first, second = _window_hashes(raw, length)
        return _batch(np.full(len(of), ENTRY), first, second, doc, of, start[of] + window, np.full(len(of), length))

    def run(batches):
        held, over = [], None  # rows of the open anchor; the anchor whose windows are dealt
        for batch in batches:
            rows = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()
            if not rows:
                continue
            rows = rows[0]
            anchor = rows.column(0).to_numpy()
            doc, start = [rows.column(i).to_numpy() for i in (1, 2, 3)], rows.column(4).to_numpy().astype(np.int64)
            raw = rows.column(5).to_pylist()
            begins = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            ends = np.append(begins[1:], len(anchor))
            size = np.repeat(ends - begins, ends - begins)
            last = begins[-1]
            dealt = (size > GROUP) | (anchor == over if over is not None else False)
            done = (np.arange(len(anchor)) < last) & ~dealt
            if done.any():
                pick = np.flatnonzero(done)
                yield compare(anchor[pick], [x[pick] for x in doc], start[pick], [raw[i] for i in pick])
            if dealt.any():
                pick = np.flatnonzero(dealt)
                yield windows([x[pick] for x in doc], start[pick], [raw[i] for i in pick])
            over = anchor[-1] if dealt[-1] else None
            held = [] if dealt[-1] else [rows.slice(int(last))]
        if held:
            rows = held[0]
            yield compare(rows.column(0).to_numpy(), [rows.column(i).to_numpy() for i in (1, 2, 3)],
                          rows.column(4).to_numpy().astype(np.int64), rows.column(5).to_pylist())

    order = ["anchor", "gen", "ord", "tie", "start"]
    dealt = blocks.select(*order, "bytes").repartition("anchor").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _ROWS)


_SCANNED = "kind int, anchor long, block long, gen int, ord long, tie long, start int, reach int, asked boolean"
_SORTED = ["anchor", "kind", "block", "gen", "ord", "tie", "start"]


def _merge_scan(rows: DataFrame, now: int | None, since: int = 0) -> DataFrame:
    """One pass over entries of the batch ``now`` and of levels, dealt by anchor and merged by sorting.

    Input: kind, anchor, block, gen, ord, tie, start, reach, asked.
    Output: entries to keep (of batches from ``since`` on: the new ones and those
    of levels that merge), spans of later equal blocks, and blocks of anchors
    with several blocks (ASK, with MARK as block if the anchor is marked).
    Without ``now`` only the spans. A task keeps two rows beside its batch.
    """
    def run(batches):
        held = None  # the first rows of the open anchor and of the open block
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(9)]
            if held is not None:  # they go before the batch, to be compared only
                cols = [np.concatenate((x, col)) for x, col in zip(held, cols)]
            anchor, kind, block, gen, ord_, tie, start, reach, asked = cols
            asked = asked.astype(bool)
            here = np.arange(len(anchor)) >= len(anchor) - n
            entry = kind == ENTRY
            same_anchor = np.concatenate(([False], (anchor[1:] == anchor[:-1]) & entry[1:]))
            same = same_anchor & np.concatenate(([False], block[1:] == block[:-1]))
            number = np.arange(len(anchor))
            first = np.maximum.accumulate(np.where(same, 0, number))
            again = same & (block != MARK) & ((ord_ != ord_[first]) | (start != start[first]) | (gen != gen[first]) | (tie != tie[first]))
            rep = entry & ~same
            span = (again & here & ((now is None) | (gen == now))) | ((kind == SPAN) & here)
            none = np.zeros(0, np.int64)
            keep = ask = none
            if now is not None:
                # a block is asked for if its anchor has another one: before it, or after it
                later, reps = np.zeros(len(anchor), bool), np.flatnonzero(rep)
                later[reps[:-1]] = anchor[reps[1:]] == anchor[reps[:-1]]
                several = rep & (same_anchor | later) & ~asked & (block != MARK)
                marked = block[np.maximum.accumulate(np.where(same_anchor, 0, number))] == MARK
                asked = asked | several
                keep = np.flatnonzero(rep & here & (gen >= since))  # since > now: none
                ask = np.flatnonzero(several | ((kind == ASK) & here))
            pick = np.concatenate((keep, np.flatnonzero(span), ask))
            kinds = np.repeat(np.array([ENTRY, SPAN, ASK], np.int32), [len(keep), span.sum(), len(ask)])
            blocks = block[pick]
            if len(ask):
                blocks[-len(ask):] = np.where(marked[ask], MARK, block[ask])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(anchor[pick]), pa.array(blocks),
                 *(pa.array(x[pick]) for x in (gen, ord_, tie, start, reach, asked))],
                names=[c.split()[0] for c in _SCANNED.split(", ")])
            held = None
            if entry[-1]:
                some = sorted({int(np.searchsorted(anchor, anchor[-1])), int(first[-1])})
                held = [x[some] for x in (anchor, kind, block, gen, ord_, tie, start, reach, asked)]

    dealt = rows.select(*_SORTED, "reach", "asked").repartition("anchor").sortWithinPartitions(*_SORTED)
    return dealt.mapInArrow(run, _SCANNED)


class SuffixFamily:
    """Levels of suffix arrays that documents are added to batch by batch.

    After n batches there is a level for each bit of n, of that many batches.
    ``add`` takes documents (ord, tie, text; non-null ord and tie name a document
    and order the batch's documents), ``removed`` returns what stands earlier
    elsewhere: earlier batches come before later ones, then ord, tie and start
    count. Levels are Parquet files in the shared folder; one that has been
    merged is deleted once the merged one is written.
    """

    def __init__(self, spark, length: int = LENGTH, gram: int = GRAM):
        if not 1 <= gram <= length:
            raise ValueError("a window must hold at least one gram")
        self.spark, self.length, self.gram = spark, length, gram
        self.batches, self.levels, self.spans, self.asked = 0, [], [], []

    def add(self, docs: DataFrame, last: bool = False) -> None:
        """Add a batch. After the ``last`` one nothing is compared with the levels any more: none is written."""
        now, size, merging = self.batches, 1, []
        while self.levels and self.levels[-1][0] == size:
            merging.append(self.levels.pop())
            size *= 2
        rows = _suffixes(docs.withColumn("gen", F.lit(now)), self.length, self.gram).select(
            "*", F.lit(False).alias("asked"))
        for _, _, level in self.levels + merging:
            rows = rows.unionByName(level)
        path = new_folder(self.spark, "suffixes")
        scan = _merge_scan(rows, now, now + 1 if last else now + 1 - size)
        scan.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        scanned = self.spark.read.schema(_SCANNED).parquet(path)
        if last:
            merging, self.levels = merging + self.levels, []
        else:
            self.levels.append((size, f"{path}/kind={ENTRY}", scanned.filter(F.col("kind") == ENTRY)))
        self.spans.append(scanned.filter(F.col("kind") == SPAN).select("gen", "ord", "tie", "start", "reach"))
        self.asked.append(scanned.filter(F.col("kind") == ASK).select(
            "gen", "ord", "tie", "anchor", "start", "reach", (F.col("block") == MARK).alias("spread")))
        for _, old, _ in merging:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        self.batches += 1

    def removed(self, docs: DataFrame) -> DataFrame:
        """gen, ord, tie, spans (start, reach) of the documents ``docs`` (gen, ord, tie, text: all that were added)."""
        blocks, spans = self.asked[0], self.spans[0]
        for more, others in zip(self.asked[1:], self.spans[1:]):
            blocks, spans = blocks.unionByName(more), spans.unionByName(others)
        marked = blocks.filter("spread").select("anchor", F.lit(True).alias("marked")).distinct()
        blocks = blocks.drop("spread").distinct().join(marked, "anchor", "left")
        block = F.struct("anchor", "start", "reach", F.coalesce("marked", F.lit(False)).alias("spread"))
        asked = materialize(blocks.groupBy("gen", "ord", "tie").agg(F.collect_list(block).alias("blocks")), "asked")
        texts = docs.select("gen", "ord", "tie", "text", _bin()).join(_bins(asked), "bin", "left_semi").join(asked, ["gen", "ord", "tie"])
        cuts = materialize(_cut_out(texts, self.length), "cuts")
        compared = materialize(_compared(cuts.filter(F.col("kind") == ASK), self.length), "compared")
        windows = cuts.filter(F.col("kind") != ASK).drop("bytes").unionByName(compared.filter(F.col("kind") == ENTRY))
        dealt = _merge_scan(windows.withColumn("asked", F.lit(False)), None)
        for more in (compared.filter(F.col("kind") == SPAN), dealt):
            spans = spans.unionByName(more.select("gen", "ord", "tie", "start", "reach"))
        return spans.groupBy("gen", "ord", "tie").agg(F.collect_list(F.struct("start", "reach")).alias("spans"))


def _bin() -> Column:
    return F.pmod(F.xxhash64("gen", "ord", "tie"), F.lit(BINS)).cast("int").alias("bin")


def _bins(rows: DataFrame) -> DataFrame:
    """The bins of documents ``rows``: at most ``BINS`` numbers, broadcast to spare other texts a shuffle."""
    return F.broadcast(rows.select(_bin()).distinct())


_CUT = "doc_id long, copy boolean, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary"


def _cut(rows: DataFrame) -> DataFrame:
    """Texts without their spans (start, reach; null: none)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches):
        for batch in batches:
            texts, found = batch.column(2), batch.column(3)
            sizes, spans, kept = [], [], []
            for i in range(len(batch)):
                raw = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
                mine = found[i].values if found[i].is_valid else None
                out, pieces, done = [], [], 0
                if mine is not None and len(mine):
                    start, reach = (mine.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in (0, 1))
                    _, start, stop = _merged(np.zeros(len(start), np.int64), start, start + reach)
                    for a, b in zip(start.tolist(), stop.tolist()):
                        out.append({"start": a, "stop": b})
                        pieces.append(raw[done:a])
                        done = b
                sizes.append(len(raw))
                spans.append(out)
                kept.append(b"".join((*pieces, raw[done:])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "copy", "n_bytes", "spans", "kept"])

    return rows.select("doc_id", "copy", "text", "spans").mapInArrow(run, _CUT)


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, ord, tie, copy: ord and tie order different rows, copy marks all but one of equal rows."""
    lowest = -(1 << 63)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    plain = plain.withColumn("ord", F.coalesce("doc_id", F.lit(lowest)))
    several = plain.groupBy("ord").agg(F.count("*").alias("rows")).filter("rows > 1").select("ord", F.lit(True).alias("several"))
    count = several.count()
    if not count:
        return plain.withColumn("tie", F.lit(0).cast("long")).withColumn("copy", F.lit(False))
    tie = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2) + F.when(F.col("doc_id").isNull(), 0).otherwise(1 << 62)
    marked = plain.withColumn("mono", F.monotonically_increasing_id()).join(
        F.broadcast(several) if count <= REPEATED_IDS else several, "ord", "left")
    marked = marked.withColumn("tie", F.when(F.col("several"), tie).otherwise(F.lit(0)).cast("long"))
    equal = marked.filter("several").groupBy("ord", "tie").agg(F.min("mono").alias("one"), F.count("*").alias("rows")).filter("rows > 1")
    return marked.join(equal.select("ord", "tie", "one"), ["ord", "tie"], "left").withColumn(
        "copy", F.coalesce(F.col("one") != F.col("mono"), F.lit(False))).select("doc_id", "text", "ord", "tie", "copy")


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES,
                            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (start, stop), kept of every row of ``docs``.

    Texts are UTF-8 bytes. Each byte covered by a string of ``length`` bytes
    that also starts earlier (in a document before it, or before it in its own)
    is removed; ``spans`` are the maximal removed runs, judged on the input, and
    ``kept`` the bytes left (they may cut a character). The table is taken in
    ``batches`` by ranges of doc_id, one after the other into a
    ``SuffixFamily``; their number does not change the result.

    Null texts are empty. Rows with a null id come first. Rows of one id are
    documents of their own, ordered by a hash of their text; of equal rows all
    but one are removed whole, if they hold ``length`` bytes. Texts of any
    length are hashed piece by piece. An empty table gives no rows. Other
    columns are not read. Hashes of 128 bits (anchor and block) and 128 bits
    (window) stand for the strings.
    """
    spark = docs.sparkSession
    plain = _ordered(docs, id_col, text_col)
    shares = [i / batches for i in range(1, batches)]
    bounds = sorted({int(x) for x in docs.select(F.col(id_col).cast("long").alias("doc_id")).approxQuantile("doc_id", shares, 0.01)}) if shares else []
    plain = plain.withColumn("gen", sum(((F.col("ord") > b).cast("int") for b in bounds), F.lit(0)))
    family, single = SuffixFamily(spark, length, gram), plain.filter("not copy")
    for i in range(len(bounds) + 1):
        low = F.lit(True) if i == 0 else F.col("doc_id") > bounds[i - 1]
        high = F.lit(True) if i == len(bounds) else F.col("doc_id") <= bounds[i]
        family.add(single.filter(low & (high | F.col("doc_id").isNull() if i == 0 else high)).select("ord", "tie", "text"),
                   last=i == len(bounds))
    spans = materialize(family.removed(single), "spans")
    bins = materialize(spans.select(_bin()).distinct(), "bins")
    keyed = plain.withColumn("bin", _bin())
    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    clean = keyed.join(F.broadcast(bins), "bin", "left_anti").select(
        "doc_id", "copy", F.octet_length(raw).cast("long").alias("n_bytes"), nothing.alias("spans"), raw.alias("kept"))
    rest = keyed.join(F.broadcast(bins), "bin", "left_semi").join(spans, ["gen", "ord", "tie"], "left")
    whole = F.col("copy") & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    return clean.unionByName(_cut(rest)).select(
        "doc_id", "n_bytes", F.when(whole, all_of_it).otherwise(F.col("spans")).alias("spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))

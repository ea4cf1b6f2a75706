"""Shared helpers: intermediates in the shared folder, bounded tables, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage at files every executor can read again, so a lost
    executor costs a re-read, and later uses read only the columns they need.
    Spark removes the shuffle files of the write when it is done: nothing
    reads them again.
    """
    spark, path, schema = df.sparkSession, new_folder(df.sparkSession, name), df.schema
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the folder that ``materialize`` wrote for ``df`` (or for a table ``df`` selects from); nothing may read it again."""
    files = df.inputFiles()
    if files:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def row_key(*cols: Column) -> list[Column]:
    """96 bits that identify a row by the given columns (nulls count as values)."""
    return [F.xxhash64(*cols).alias("key_a"), F.hash(*reversed(cols), F.lit(17)).alias("key_b")]


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``doc`` beside ``more``: their names cannot clash with those of joins."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), *more)


def bounded_histogram(df: DataFrame, count: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
                      size: int, parts: int = 64) -> np.ndarray:
    """Sum over all rows of a histogram with ``size`` bins, for a fixed ``size``.

    ``count`` yields arrays of bin numbers of a batch. Each task adds up its
    own rows; the partial histograms are cut into ``parts`` slices, dealt by
    slice and added while they stream in, so a task holds one histogram and
    the driver receives ``size`` counters in the end, whatever the input.
    """
    step = -(-size // parts)

    def partial(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for bins in count(batch):
                np.add.at(total, bins, 1)
        filled = [i for i in range(parts) if total[i * step:(i + 1) * step].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled, pa.int32()),
             pa.array([total[i * step:(i + 1) * step].tobytes() for i in filled], pa.binary())],
            names=["part", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(raw, np.int64)
                total[i] = total[i] + more if i in total else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["part", "counts"])

    schema = "part int, counts binary"
    out = np.zeros(size, np.int64)
    for row in df.mapInArrow(partial, schema).repartition("part").mapInArrow(add, schema).toLocalIterator():
        got = np.frombuffer(row.counts, np.int64)
        out[row.part * step:row.part * step + len(got)] += got
    return out


def bounded_bitmap(df: DataFrame, bins: Callable[[pa.RecordBatch], Iterator[np.ndarray]], size: int,
                   parts: int = 64) -> np.ndarray:
    """Which of ``size`` bins any row falls into, for a fixed ``size`` (a multiple of ``8 * parts``).

    Like ``bounded_histogram``, with a bit for each bin.
    """
    step = size // parts // 8

    def partial(batches):
        seen = np.zeros(size, bool)
        for batch in batches:
            for some in bins(batch):
                seen[some] = True
        packed = np.packbits(seen).reshape(parts, step)
        filled = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array([packed[i].tobytes() for i in filled], pa.binary())],
            names=["part", "bits"])

    def either(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = np.frombuffer(raw, np.uint8)
                total[i] = total[i] | more if i in total else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["part", "bits"])

    out = np.zeros((parts, step), np.uint8)
    schema = "part int, bits binary"
    for row in df.mapInArrow(partial, schema).repartition("part").mapInArrow(either, schema).toLocalIterator():
        out[row.part] |= np.frombuffer(row.bits, np.uint8)
    return np.unpackbits(out.reshape(-1)).view(bool)


def part_count(spark: SparkSession) -> int:
    """Parts that ``dealt`` makes: a power of two, at least twice the shuffle's partitions."""
    return 1 << min(14, max(6, (2 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()))


def dealt(df: DataFrame, arrays_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, ...]]], names: list[str],
          parts: int, held: int = 1 << 20) -> DataFrame:
    """Arrays instead of rows: (part, one binary for each of ``names``), the entries dealt by the first array's first bits.

    ``arrays_of`` yields arrays of equal length from a batch, the first of them
    uint64. A task deals them out whenever it has ``held`` entries; ``parts`` is
    a power of two.
    """
    top = np.uint64(64 - (parts.bit_length() - 1))

    def out(taken):
        arrays = [np.concatenate(x) for x in zip(*taken)]
        part = (arrays[0] >> top).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        count = np.bincount(part, minlength=parts)
        filled = np.flatnonzero(count)
        cuts = np.cumsum(count[filled])[:-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), *(pa.array([x.tobytes() for x in np.split(a[order], cuts)], pa.binary()) for a in arrays)],
            names=["part", *names])

    def run(batches):
        taken, size = [], 0
        for batch in batches:
            for arrays in arrays_of(batch):
                if len(arrays[0]):
                    taken.append(arrays)
                    size += len(arrays[0])
                if size >= held:
                    yield from out(taken)
                    taken, size = [], 0
        if taken:
            yield from out(taken)

    return df.mapInArrow(run, ", ".join(["part int", *(f"{x} binary" for x in names)]))


def gathered(df: DataFrame, kinds: list[type], each: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``each`` makes of the whole parts (rows of ``dealt``) that come to a task, as one array for each of ``kinds``."""
    def run(batches):
        taken = [[np.zeros(0, kind)] for kind in kinds]
        for batch in batches:
            for own, kind, column in zip(taken, kinds, batch.columns[1:]):
                own += [np.frombuffer(x.as_buffer(), kind) for x in column]
        yield from each([np.concatenate(x) for x in taken])

    return df.repartition("part").mapInArrow(run, schema)

"""Small operations on the file system that holds a table (Hadoop FS, any scheme)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (none if it is missing)."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.deleteOnExit(where)


def put_json(spark: SparkSession, path: str, value) -> None:
    """Replace a small file as a whole: written beside it, then renamed over it in one step."""
    fs, staged = _at(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    try:
        out.write(json.dumps(value).encode())
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    target = hadoop.Path(path)
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(staged), fs.makeQualified(target), options)


def get_json(spark: SparkSession, path: str):
    """The value of a file written by ``put_json``, None without one."""
    if not exists(spark, path):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))  # one small file

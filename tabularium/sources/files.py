"""Files by path in whatever store Spark reads: local, HDFS, object stores."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    return fs.makeQualified(p).toString()


def local(path: str) -> str:
    """The name of a mounted folder; files of another store have none, which is an error."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return path
    if scheme != "file":
        raise ValueError(f"not a mounted folder: {path}")
    return "/" + rest.lstrip("/")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """``source`` under the name ``target``, in place of whatever is there."""
    fs, s = _path(spark, source)
    _, t = _path(spark, target)
    if fs.exists(t):
        fs.delete(t, True)
    if not fs.rename(s, t):
        raise OSError(f"could not rename {source} to {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside ``path`` and renamed, so no reader sees half of it."""
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    fs, p = _path(spark, part)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    replace(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str:
    row = spark.read.format("binaryFile").load(path).select("content").first()
    return bytes(row["content"]).decode("utf-8")

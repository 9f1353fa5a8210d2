"""Hadoop FileSystem operations on the driver (metadata only: exists, list, rename, delete).

These go through the session's Hadoop configuration, so they work on HDFS, local
files and object stores alike. No data passes through the driver here.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Moves ``src`` to ``dst`` (a directory rename: atomic on HDFS and local FS)."""
    fs, s = _path(spark, src)
    _, d = _path(spark, dst)
    if d.getParent() is not None:
        fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and lengths of the files directly under ``path`` (empty if it does not exist)."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    return {st.getPath().getName(): st.getLen() for st in fs.listStatus(p) if st.isFile()}


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (scheme and absolute path), for catalog locations."""
    fs, p = _path(spark, path)
    return str(fs.makeQualified(p).toString())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small text file (metadata such as a log record) atomically: a hidden
    temporary name, then a rename; readers skip names starting with ``.``."""
    fs, p = _path(spark, path)
    tmp = p.getParent().suffix(f"/.{p.getName()}.tmp")
    fs.mkdirs(p.getParent())
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        raise OSError(f"rename failed: {tmp} -> {path}")


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small text file that must not exist yet; False if it does (created exclusively where the store can)."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file (metadata)."""
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()

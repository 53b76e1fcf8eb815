"""Our own commit marker for written directories.

Spark's ``_SUCCESS`` file can be switched off by a session setting, so it is
no proof that a table is whole. A writer marks its directory when the write
has returned; readers look for that mark only. Names that begin with ``_``
are skipped by Spark's file sources.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import hadoop_fs, list_dir, path_exists

MARKER = "_COMMITTED"


def commit(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_fs(spark, f"{path}/{MARKER}")
    fs.create(jpath, True).close()
    return path


def is_committed(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{MARKER}")


def committed_children(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names below ``root`` that begin with ``prefix`` and are committed, sorted."""
    return sorted(n for n in list_dir(spark, root) if n.startswith(prefix) and is_committed(spark, f"{root}/{n}"))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a directory this library wrote (a batch that loaded nothing, a staging copy, an old version)."""
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of metadata, written by the driver to the table's file system."""
    fs, jpath = hadoop_fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()

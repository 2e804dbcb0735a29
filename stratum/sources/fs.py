"""Small file-system helpers over the session's Hadoop file system.

Used only by the staged upsert to find and drop its own staging folders and
to keep its one-line layout marker; all data movement goes through DataFrame
reads and writes. It asks the driver's JVM, so an upsert needs a classic
session (not Spark Connect).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(hpath) if st.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly in a folder."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isFile())


def delete(spark: SparkSession, path: str) -> None:
    """Recursive delete of a folder or file that the upsert staged or has replaced."""
    fs, hpath = _fs_and_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small marker file (replaced if present)."""
    fs, hpath = _fs_and_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """First line of a small marker file, or None when there is none."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(hpath), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    fs, hpath = _fs_and_path(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def scheme(spark: SparkSession, path: str) -> str:
    """Scheme of the file system that holds a path."""
    return str(_fs_and_path(spark, path)[0].getUri().getScheme())


def replace_dir(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``, whose content it replaces."""
    fs, src = _fs_and_path(spark, source)
    dst = _fs_and_path(spark, target)[1]
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")

"""Files on whatever store Spark's paths name: listing, deletion, and markers made once."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _target(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _target(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all in it; nothing happens if there is none."""
    fs, target = _target(spark, path)
    fs.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly in `path`, sorted; none if it is no folder."""
    fs, target = _target(spark, path)
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    fs, target = _target(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(target) or [])


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; nothing else of it is read."""
    fs, target = _target(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(target), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that is whole as soon as it is seen; False if there is one already.

    It is written under another name and renamed, which fails where the name is taken: of several
    writers one wins.
    """
    fs, target = _target(spark, path)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(draft, context.makeQualified(target), options)
    except Exception as failed:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise failed
    return True

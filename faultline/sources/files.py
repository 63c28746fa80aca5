"""Small files of the shared file system, by any path that Spark can write:
markers that are created once and texts that appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty marker; false if there is one already."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        return fs.createNewFile(p)
    except Exception as e:  # some file systems raise instead of answering
        if fs.exists(p):
            return False
        raise e


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` under a new name that readers see only when it is
    complete; false, and nothing written, if the name is taken.  A draft is
    renamed without overwriting, so a writer that fails blocks no other.  The file
    system must refuse to rename onto an existing file in one step, as HDFS does."""
    fs, p = _fs(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, p, options)
        return True
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(p):
            return False
        raise e


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)).decode()
    finally:
        source.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)

"""Small files of the shared file system, through Spark's own file layer."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The JVM, a path, and the file system it is on."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    _, place, fs = hadoop(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text; None if there is no such file."""
    jvm, place, fs = hadoop(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    _, place, fs = hadoop(spark, path)
    out = fs.create(place, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def entries(spark: SparkSession, path: str) -> Iterator:
    """The entries of a folder, fetched one by one; none if there is no such folder."""
    _, place, fs = hadoop(spark, path)
    if fs.exists(place):
        listed = fs.listStatusIterator(place)
        while listed.hasNext():
            yield listed.next()


def move(spark: SparkSession, source: str, target: str, replace: bool) -> bool:
    """Rename a file in one step. With ``replace`` an old target gives way at once, which
    the file system must be able to do; without, an old target stays and False is returned."""
    jvm, from_, fs = hadoop(spark, source)
    _, to, _ = hadoop(spark, target)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(fs.makeQualified(from_), fs.makeQualified(to), options)
    except Py4JJavaError as error:
        if not replace and error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in epoch milliseconds."""
    _, place, fs = hadoop(spark, path)
    return fs.getFileStatus(place).getModificationTime()

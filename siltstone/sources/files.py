"""Small files beside the data, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in ``folder``; nothing if there is no such folder."""
    where, fs = _located(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _located(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this content, all at once. False if there is one of that name already."""
    folder, _, name = path.rpartition("/")
    draft, fs = _located(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    draft, where = fs.makeQualified(draft), fs.makeQualified(_located(spark, path)[0])
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, where, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _located(spark, path)
    fs.delete(where, True)

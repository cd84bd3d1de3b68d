"""Small files on shared storage, through Hadoop's file system interface."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    fs, p = file_system(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole text of a small file; None if there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its text at once; False if it is there already.

    The text is written beside it and renamed without overwriting, so readers
    see the whole file or none, and of two writers one succeeds.
    """
    jvm = spark.sparkContext._jvm
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    fs, p = file_system(spark, path)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(jvm.org.apache.hadoop.fs.Path(draft)), fs.makeQualified(p), no_options)
    except Exception as e:
        if "FileAlreadyExistsException" not in str(getattr(e, "java_exception", e)):
            raise
        return False
    finally:
        delete(spark, draft)
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)

"""Small control files through the cluster's own file system, and scratch folders."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyExists(RuntimeError):
    """Another writer published first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder; none when it does not exist."""
    fs, at = _fs(spark, folder), _path(spark, folder)
    if not fs.exists(at):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(at))


def modified(spark: SparkSession, path: str) -> datetime:
    """When a file or folder was last changed."""
    millis = _fs(spark, path).getFileStatus(_path(spark, path)).getModificationTime()
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under a temporary name, then rename without overwriting: readers see the
    whole file or none, and of two writers of one name the second fails."""
    jvm = spark._jvm
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, draft, text)
    hadoop_conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), hadoop_conf)
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, draft), _path(spark, path), no_overwrite)
    except Py4JJavaError as error:
        delete(spark, draft)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise AlreadyExists(path) from error
        raise


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder all executors can reach, under the checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/millrace-{label}-{uuid.uuid4().hex}"


def settled(df, label: str):
    """The same rows from files under the checkpoint folder: computed once, their plan cut off."""
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names.  Only a local master without the
    setting gets a local folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder

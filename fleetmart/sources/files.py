"""Small control files on whatever file system the warehouse lives on."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def listed(spark: SparkSession, path: str, folders: bool = False) -> list[tuple[str, float]]:
    """(name, time of the last change) of the files directly below ``path``, or of the folders."""
    if not exists(spark, path):
        return []
    found = [s for s in _fs(spark, path).listStatus(_path(spark, path)) if s.isDirectory() == folders]
    return sorted((s.getPath().getName(), s.getModificationTime() / 1000) for s in found if not s.getPath().getName().startswith("."))


def create(spark: SparkSession, path: str, text: str) -> bool:
    """A file with this content, in one step, unless there is one: then false.

    Written beside it first, so that nobody reads half of it. A rename that
    doesn't replace does the rest on HDFS; on local disks, where that would be
    two steps, a hard link. An object store needs a conditional put here.
    """
    fs = _fs(spark, path)
    target = fs.makeQualified(_path(spark, path))
    fresh = fs.makeQualified(_path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"))
    if target.toUri().getScheme() == "file":
        own, wanted = Path(fresh.toUri().getPath()), Path(target.toUri().getPath())
        own.parent.mkdir(parents=True, exist_ok=True)
        own.write_text(text, encoding="utf-8")
        try:
            os.link(own, wanted)
        except FileExistsError:
            return False
        finally:
            own.unlink()
        return True
    stream = fs.create(fresh)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fresh, target, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as e:
        fs.delete(fresh, False)
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)

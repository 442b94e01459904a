"""Small files on the session's file systems: a pointer replaced in one step, folders dropped.

Paths go through Hadoop's file systems, so a local folder, HDFS and an object
store work alike, and nothing is written on a machine's own disk.
"""

from __future__ import annotations

import json

from py4j.java_gateway import is_instance_of
from pyspark.sql import SparkSession

_PACKAGE = "org.apache.hadoop.fs."


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    """The path's file system; a local one without checksum files, which are not replaced with their file."""
    fs = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    gateway = spark.sparkContext._gateway
    return fs.getRawFileSystem() if is_instance_of(gateway, fs, _PACKAGE + "ChecksumFileSystem") else fs


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it does not exist)."""
    if not exists(spark, path):
        return []
    found = _system(spark, path).listStatus(_path(spark, path))
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def drop_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def write_pointer(spark: SparkSession, path: str, value: dict) -> None:
    """Replace the small JSON file at ``path``: readers see the old value or the new one, never a part."""
    fs, whole, part = _system(spark, path), _path(spark, path), _path(spark, path + ".next")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    if is_instance_of(gateway, fs, _PACKAGE + "RawLocalFileSystem"):
        if not fs.rename(part, whole):                  # replaces the file, as POSIX does
            raise OSError(f"cannot replace {path}")
        return
    option = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(whole), overwrite)


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    """The value of a pointer file, or None if there is none yet."""
    if not exists(spark, path):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")       # a few hundred bytes
    finally:
        stream.close()
    return json.loads(text)

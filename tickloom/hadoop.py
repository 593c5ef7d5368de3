"""Paths on whatever file system Spark is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return target.getFileSystem(conf), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system."""
    system, target = _resolve(spark, path)
    return system.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _resolve(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    system, target = _resolve(spark, path)
    system.delete(target, True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The directories that a glob names, in order; none of them is looked into."""
    system, target = _resolve(spark, pattern)
    found = system.globStatus(target)
    return [] if found is None else sorted(s.getPath().toString() for s in found if s.isDirectory())


def packed_endings(spark: SparkSession) -> list[str]:
    """The endings of the names of files that Hadoop unpacks while it reads them, like `.gz`."""
    conf, hadoop = spark._jsparkSession.sessionState().newHadoopConf(), spark._jvm.org.apache.hadoop
    codecs = hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return [hadoop.util.ReflectionUtils.newInstance(codec, conf).getDefaultExtension() for codec in codecs]


def files(spark: SparkSession, path: str) -> list[str]:
    """The names of the files directly in a directory, without hidden ones; none if it does not exist."""
    system, target = _resolve(spark, path)
    if not system.exists(target):
        return []
    names = (s.getPath().getName() for s in system.listStatus(target) if s.isFile())
    return sorted(name for name in names if name[0] not in "._")


def move(spark: SparkSession, old: str, new: str) -> bool:
    """Renames a file, into a directory that may not exist yet; false if it is not there to be moved."""
    system, target = _resolve(spark, new)
    source = spark._jvm.org.apache.hadoop.fs.Path(old)
    if not system.exists(source):
        return False
    system.mkdirs(target.getParent())
    return system.rename(source, target)


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _resolve(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears as a whole: written beside its place, then renamed."""
    draft = f"{path}.draft"
    system, target = _resolve(spark, draft)
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, draft, path)

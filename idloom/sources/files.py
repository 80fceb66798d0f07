"""Files in any file system that Spark knows, through the driver's Hadoop client.

Contents are streamed inside the JVM. A rename replaces its target at once where the file system can do that, as HDFS
and local ones do; object stores copy.
"""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

BLOCK = 1 << 20


def join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _opened(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, which writes no checksum files beside, and the path in it."""
    target, conf = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()
    system = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(target.getFileSystem(conf).getUri(), conf)
    system.setWriteChecksum(False)
    return system, target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _opened(spark, path)
    return system.exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    system, target = _opened(spark, path)
    return system.exists(target) and system.getFileStatus(target).isFile()


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _opened(spark, path)
    system.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all that is in it; nothing happens if there is none."""
    system, target = _opened(spark, path)
    system.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    system, target = _opened(spark, path)
    return system.getFileStatus(target).getLen()


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file, over one that is there already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    system, old = _opened(spark, source)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(old), system.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), overwrite)


def append_parts(spark: SparkSession, folder: str, target: str) -> None:
    """One file of the part files of a folder, in the order of their names."""
    system, parts = _opened(spark, folder)
    names = sorted(x.getPath().getName() for x in system.listStatus(parts))
    out = system.create(spark._jvm.org.apache.hadoop.fs.Path(target), True)
    try:
        for name in names:
            if name.startswith("part-"):
                source = system.open(spark._jvm.org.apache.hadoop.fs.Path(join(folder, name)))
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, BLOCK, False)
                finally:
                    source.close()
    finally:
        out.close()


def sha256(spark: SparkSession, path: str) -> str:
    system, target = _opened(spark, path)
    source = system.open(target)
    try:
        return spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(source)
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _opened(spark, path)
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    system, target = _opened(spark, path)
    source = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()

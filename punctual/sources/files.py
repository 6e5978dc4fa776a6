"""File-system calls that work on any Hadoop file system, not just local disk."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches the glob ``pattern``."""
    fs, hadoop = _path(spark, pattern)
    return bool(fs.globStatus(hadoop))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop = _path(spark, path)
    fs.mkdirs(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _path(spark, path)
    fs.delete(hadoop, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it doesn't exist."""
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, hadoop = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of one that is there."""
    fs, hadoop = _path(spark, path)
    _write(fs, hadoop, text)


def _write(fs, hadoop, text: str) -> None:
    stream = fs.create(hadoop, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its text at once; False if ``path`` exists.

    The text is written beside it and gets its name in one step that fails where the name
    is taken: a hard link on local disks, elsewhere a rename that doesn't overwrite, which
    HDFS and stores with real folders do atomically.
    """
    fs, hadoop = _path(spark, path)
    hadoop = fs.makeQualified(hadoop)
    draft = spark._jvm.org.apache.hadoop.fs.Path(hadoop.getParent(), f".{uuid.uuid4().hex}.tmp")
    _write(fs, draft, text)
    try:
        if hadoop.toUri().getScheme() == "file":
            _link(spark, draft, hadoop)
        else:
            _rename(spark, draft, hadoop)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)
    return True


def _link(spark: SparkSession, draft, target) -> None:
    local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)]
    spark._jvm.java.nio.file.Files.createLink(*local)


def _rename(spark: SparkSession, source, target) -> None:
    """Give ``source`` the name of ``target``, which must not exist."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context.rename(source, target, spark.sparkContext._gateway.new_array(kind, 0))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; an error if ``target`` exists."""
    _, new = _path(spark, target)
    fs, old = _path(spark, source)
    _rename(spark, fs.makeQualified(old), fs.makeQualified(new))


def size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes of the files under ``path``."""
    fs, hadoop = _path(spark, path)
    return fs.getContentSummary(hadoop).getLength()


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at ``path``: changes when they do."""
    fs, hadoop = _path(spark, path)
    found, listed = [], fs.listFiles(hadoop, True)
    while listed.hasNext():
        status = listed.next()
        entry = (status.getPath().toString(), status.getLen(), status.getModificationTime())
        found.append(entry)
    return tuple(sorted(found))

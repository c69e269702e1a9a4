"""Small files next to the data, through the file system Spark itself uses."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def qualified(spark: SparkSession, path: str) -> str:
    """The full path of an existing file or folder, as the file system names it."""
    return _system(spark, path).getFileStatus(_path(spark, path)).getPath().toString()


def list_names(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    system = _system(spark, path)
    stream = system.open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a new file; fails if it exists, so two writers cannot both claim a version."""
    stream = _system(spark, path).create(_path(spark, path), False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a finished file at `path`; False if there is one already. Nobody sees half a file."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    write_text(spark, draft, text)
    if claim(spark, draft, path):
        return True
    delete(spark, draft)
    return False


def claim(spark: SparkSession, draft: str, path: str) -> bool:
    """Move a file or folder to `path`; False if there is one already."""
    system = _system(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, draft), _path(spark, path), no_options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False


def replace_with_pieces(spark: SparkSession, path: str, parts: list[str], folders: set[str]) -> None:
    """Make a file of texts and of the files of some folders, then put it at `path`, whatever is there.

    The lines of a folder follow each other as they are, but for the first character of the first.
    """
    hadoop = spark._jvm.org.apache.hadoop
    system = _system(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    out = system.create(_path(spark, draft), False)
    try:
        for part in parts:
            if part not in folders:
                out.write(part.encode("utf-8"))
                continue
            first = True
            for name in list_names(spark, part):
                if name.startswith(("_", ".")):
                    continue
                stream = system.open(_path(spark, f"{part}/{name}"))
                try:
                    if first and stream.read() >= 0:
                        first = False
                    hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
    finally:
        out.close()
    context = hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(hadoop.fs.Options.Rename, 1)
    options[0] = hadoop.fs.Options.Rename.OVERWRITE
    context.rename(_path(spark, draft), _path(spark, path), options)


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since 1970."""
    return _system(spark, path).getFileStatus(_path(spark, path)).getModificationTime() / 1000


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Give a file another time, where the file system keeps one."""
    _system(spark, path).setTimes(_path(spark, path), millis, -1)


def make_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_path(spark, path))


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was last written."""
    return time.time() - modified(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder this package wrote."""
    _system(spark, path).delete(_path(spark, path), True)

"""Trees of many small files, packed: a file of its own costs a record its block, its folder and its task's time."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of members, with their headers, after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
# Bytes and rows of members that a task hands on at once.
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 2000

_HEADER = 1024  # a member's header and its padding, on average


def write_archives(documents: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `content` (text or bytes) of every row as member `name` of compressed tar archives below `path`.

    Every task writes archives of its own, each of a bounded size; one that is repeated replaces
    them. Returns the names and sizes of the members.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        task, number, held = TaskContext.get().partitionId(), 0, 0
        out = tar = None
        try:
            for batch in batches:
                sizes = []
                for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                    if tar is None:
                        out = system.open_output_stream(f"{root}/part-{task:05d}-{number:05d}.tar.gz", compression=None)
                        tar = tarfile.open(fileobj=out, mode="w|gz", compresslevel=3)
                    member = tarfile.TarInfo(name)
                    member.size = len(content or b"")
                    tar.addfile(member, io.BytesIO(content or b""))
                    sizes.append(member.size)
                    held += member.size + _HEADER
                    if held >= archive_bytes:
                        tar.close()
                        out.close()
                        out = tar = None
                        number, held = number + 1, 0
                yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(sizes, pa.int64())], names=["name", "size"])
        finally:
            if tar is not None:
                tar.close()
                out.close()

    return documents.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string, size long")


def read_archives(spark: SparkSession, path: str, pattern: str = "*.{tar,tar.gz,tgz}") -> DataFrame:
    """`folder` (that of the archive), `name` and `content` of every file in the archives below a folder.

    An archive is one row to a task, its members are handed on in small batches.
    """
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, content in zip(batch.column("folder").to_pylist(), batch.column("content")):
                names, contents, size = [], [], 0
                with tarfile.open(fileobj=io.BytesIO(content.as_buffer()), mode="r|*") as tar:
                    for member in tar:
                        if not member.isfile():
                            continue
                        names.append(member.name.removeprefix("./"))
                        contents.append(tar.extractfile(member).read())
                        size += member.size
                        if size >= _BATCH_BYTES or len(names) >= _BATCH_ROWS:
                            yield _members(folder, names, contents)
                            names, contents, size = [], [], 0
                yield _members(folder, names, contents)

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(path)
        .select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "content")
    )
    return files.mapInArrow(members, "folder string, name string, content binary")


def _members(folder: str, names: list[str], contents: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([folder] * len(names), pa.string()), pa.array(names, pa.string()), pa.array(contents, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["folder", "name", "content"])

"""XML documents of a collection tree, as a table or a stream."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from xmlindex.session import gathered
from xmlindex.sources.files import qualified
from xmlindex.sources.listing import can_list, stream_tree

# What Spark's binaryFile source yields; streams need it spelled out.
_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# Bytes of a batch for each of its tasks.
_TASK_BYTES = 32 << 20


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _from_files(files: DataFrame, root: str, collection: str) -> DataFrame:
    # The root as the file system names it, however it was given: the files' paths begin with it.
    root = qualified(files.sparkSession, root)
    below = len(re.sub(_SCHEME, "", root).rstrip("/")) + 2
    inside = F.regexp_replace("path", _SCHEME, "").substr(F.lit(below), F.length("path"))
    folder = F.regexp_replace(inside, "/?[^/]*$", "")
    where = F.when(folder == "", F.lit(collection)).otherwise(F.concat_ws("/", F.lit(collection), folder))
    return files.select(
        where.alias("collection"),
        F.regexp_replace(where, "^/", "").alias("collection_id"),
        inside.alias("document_id"),
        F.unix_millis("modificationTime").alias("modified"),
        F.col("content").alias("xml"),
    )


def read_documents(spark: SparkSession, path: str, collection: str = "/db", pattern: str = "*.xml") -> DataFrame:
    """Documents below a folder: sub-folders become collections below `collection`.

    Files carry no numeric ids: the path below `path` identifies a file, so equal names in two
    folders are two documents.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).load(path)
    )
    return _from_files(gathered(files), path, collection)


def stream_documents(spark: SparkSession, path: str, collection: str = "/db", pattern: str = "*.xml",
                     batch_bytes: int = 512 << 20, files_per_batch: int | None = None) -> DataFrame:
    """New documents below a folder, as they appear.

    A batch takes the files of about `batch_bytes`: what a batch costs beside its documents does not
    depend on their number. With `files_per_batch` it takes so many files instead.

    Tasks list the files, when a query starts and about every ten seconds while it waits, and read them (see
    `listing`), so the driver's memory does not grow with their number.
    A file system that only Spark reaches is left to Spark's own source, which holds them all at the driver.
    """
    root = qualified(spark, path)
    if can_list(root):
        weight, limit = ("length", batch_bytes) if files_per_batch is None else (None, files_per_batch)
        cores = spark.sparkContext.defaultParallelism
        tasks = cores if files_per_batch else max(cores, -(-batch_bytes // _TASK_BYTES))
        return _from_files(stream_tree(spark, root, pattern, weight, limit, tasks), path, collection)
    limit = ("maxBytesPerTrigger", batch_bytes) if files_per_batch is None else ("maxFilesPerTrigger", files_per_batch)
    files = (
        spark.readStream.format("binaryFile").schema(T._parse_datatype_string(_FILE_SCHEMA))
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .option(*limit).load(path)
    )
    return _from_files(files, path, collection)


def upserts(documents: DataFrame) -> DataFrame:
    """Documents from files as events for `streaming.incremental`.

    The order is that of the files' times; a file that is written again is a newer version, and
    one that arrives late is as old as its time says.
    """
    return documents.select(
        F.col("modified").alias("sequence"), F.lit("upsert").alias("op"), "collection", "collection_id",
        "document_id", F.lit(None).cast("string").alias("user_document_id"), "xml",
        F.col("modified").alias("event_ts"),
    )


def write_documents(documents: DataFrame, path: str) -> DataFrame:
    """Write `content` (text or bytes) of every row to the file `name` below `path`; returns names and sizes.

    Files are written by the tasks, one for each row, through the file system of `path`; a task
    that is repeated writes the same files again. Names may contain folders and should differ.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            sizes = []
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                target = f"{root}/{name}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(target) as out:
                    out.write(content or b"")
                sizes.append(len(content or b""))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(sizes, pa.int64())], names=["name", "size"])

    return documents.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(write, "name string, size long")


def documents_from_table(table: DataFrame, collection: Column | str, collection_id: Column | str,
                         document_id: Column | str, xml: Column | str) -> DataFrame:
    """Documents from any table with XML in a column."""
    def column(value: Column | str) -> Column:
        return F.col(value) if isinstance(value, str) else value

    return table.select(
        column(collection).alias("collection"),
        column(collection_id).alias("collection_id"),
        column(document_id).alias("document_id"),
        column(xml).alias("xml"),
    )

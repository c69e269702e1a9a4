"""Streams over the files of a tree, however many: the driver holds no list of them.

Spark's file source keeps the status of every file of a tree in the driver's memory, and lists the files of a
batch there once more. Here tasks list the folders and leave out what was listed before. What is new is cut into
batches, by the files' times, and each batch is written as one small table; it is these tables that Spark's source
streams, one at a time, and tasks read the files that they name.
"""

from __future__ import annotations

import hashlib
import os
import re
import stat
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JError
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from xmlindex.session import CODEC, Staging, is_local, staging_root
from xmlindex.sources import files

_ENTRY = "path string, folder boolean, modified bigint, length bigint"
_LISTED = "path string, modified bigint, length bigint, error string"
_READ = "path string, modified bigint, content binary"

# Rows of a listing, and bytes and rows of files, that a task hands on at once.
_ENTRIES, _BATCH_BYTES, _BATCH_ROWS = 10_000, 8 << 20, 2000
# Seconds between two listings for a query that waits, and times the last one took.
_PAUSE, _SHARE = 10.0, 5
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def open_tree(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root, as Spark's file system names it, and the root's path there."""
    if not re.match("[A-Za-z][A-Za-z0-9+.-]*:", root) or root.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:(//[^/]*)?", "", root).rstrip("/")
    system, path = fs.FileSystem.from_uri(quote(root, safe=":/@"))
    return system, path.rstrip("/")


def can_list(root: str) -> bool:
    """Is this a folder that tasks can list and read by themselves?"""
    try:
        system, path = open_tree(root)
        return system.get_file_info(path or "/").type == fs.FileType.Directory
    except (pa.ArrowInvalid, OSError):
        return False


def _hidden(name: str) -> bool:
    """Names that Spark leaves out of a tree."""
    if name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name


def _entries(system: fs.FileSystem, path: str) -> Iterator[tuple[str, bool, int, int]]:
    """Name, whether it is a folder, time and length of what a folder holds; what has gone meanwhile is left out."""
    if not isinstance(system, fs.LocalFileSystem):
        for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            yield info.base_name, info.type == fs.FileType.Directory, (info.mtime_ns or 0) // 1_000_000, info.size or 0
        return
    try:
        scan = os.scandir(path or "/")
    except FileNotFoundError:
        return
    with scan:
        for entry in scan:
            try:
                status = entry.stat()
            except FileNotFoundError:
                continue
            yield entry.name, stat.S_ISDIR(status.st_mode), status.st_mtime_ns // 1_000_000, status.st_size


def _lister(root: str):
    names, kinds = ["path", "folder", "modified", "length"], [pa.string(), pa.bool_(), pa.int64(), pa.int64()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_tree(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                rows, above = [], f"{folder}/" if folder else ""
                for name, *rest in _entries(system, f"{base}/{folder}" if folder else base):
                    if _hidden(name):
                        continue
                    rows.append((above + name, *rest))
                    if len(rows) >= _ENTRIES:
                        yield packed(rows)
                        rows = []
                if rows:
                    yield packed(rows)

    return entries


def _reader(root: str):
    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["path", "modified", "content"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_tree(root)
        for batch in batches:
            for error in batch.column("error").drop_null().to_pylist():
                raise RuntimeError(f"{root} could not be listed: {error}")
            names, rows, size = batch.column("path").to_pylist(), [], 0
            # As they are now; a file that has gone since it was listed is left out.
            for name, info in zip(names, system.get_file_info([f"{base}/{name}" for name in names])):
                if info.type == fs.FileType.NotFound:
                    continue
                try:
                    with system.open_input_file(info.path) as source:
                        content = source.read()
                except FileNotFoundError:
                    continue
                rows.append((f"{root.rstrip('/')}/{name}", (info.mtime_ns or 0) // 1_000_000, content))
                size += len(content)
                if size >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    return read


def _home(spark: SparkSession) -> str:
    """Where lists are kept: in the staging folder, or where a local session without one finds them again."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured or not is_local(spark):
        return f"{staging_root(spark)}/xmlindex"
    return f"{tempfile.gettempdir()}/xmlindex-{os.getuid()}"


class Listing:
    """The files of a tree in lists, each made of batches; a file is listed once, whatever becomes of it.

    It lies in the staging folder under a name that the tree, the pattern and the size of a batch give, so it
    is found again after a restart; a stream that goes on with batches of another size gets all files again.
    It never names a file twice, also where two sessions list a tree.
    """

    def __init__(self, spark: SparkSession, root: str, pattern: str, weight: str | None, limit: int):
        """A batch takes files until the sum of their `weight` (a column, or one for each) comes to `limit`."""
        self.spark, self.root, self.weight, self.limit = spark, root, weight, limit
        compiled = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled()
        self._names = f"^(?s:{compiled.pattern()})$"
        key = hashlib.md5("\0".join([root, pattern, str(weight), str(limit)]).encode()).hexdigest()
        self.path = f"{_home(spark)}/listing-{key}"
        self._lock, self._ended, self._took = threading.Lock(), 0.0, 0.0
        files.make_folder(spark, self.path)

    def stream(self, tasks: int) -> DataFrame:
        """`path`, `modificationTime` and `content` of the files, a batch at a time, read by so many tasks."""
        lists = (
            self.spark.readStream.schema(T._parse_datatype_string(_LISTED)).option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", 1).parquet(self.path)
        )
        read = lists.repartition(tasks).mapInArrow(_reader(self.root), _READ)
        return read.select("path", F.timestamp_millis("modified").alias("modificationTime"), "content")

    def refresh(self) -> None:
        """List what is new. If that fails, so do the streams that read these lists."""
        with self._lock:
            began = time.monotonic()
            try:
                for name in files.list_names(self.spark, self.path):
                    if name.startswith("failed-"):
                        files.delete(self.spark, f"{self.path}/{name}")
                while not self._add():
                    pass
            except Exception as error:
                self._fail(f"{type(error).__name__}: {error}"[:2000])
            self._ended = time.monotonic()
            self._took = self._ended - began

    def refresh_in_turn(self) -> None:
        """List what is new beside the caller, unless that was done a short time ago or is being done."""
        if time.monotonic() - self._ended >= max(_PAUSE, _SHARE * self._took) and not self._lock.locked():
            threading.Thread(target=self.refresh, daemon=True).start()

    def _found(self, staging: Staging) -> DataFrame:
        """All files of the tree; folders are listed level by level, each by one task."""
        name = F.element_at(F.split("path", "/"), -1)
        folders, found = self.spark.createDataFrame([("",)], "path string"), None
        while True:
            tasks = self.spark.sparkContext.defaultParallelism
            listed = folders.repartition(tasks).mapInArrow(_lister(self.root), _ENTRY)
            level = staging.write(listed.where(F.col("folder") | name.rlike(self._names)), "listed")
            of_level = level.where("not folder").drop("folder")
            found = of_level if found is None else found.unionByName(of_level)
            folders = level.where("folder").select("path")
            if folders.isEmpty():
                return found

    def _add(self) -> bool:
        """Publish a list of the new files, if there are any; False if another list came meanwhile."""
        lists = [name for name in files.list_names(self.spark, self.path) if name.startswith("list-")]
        with Staging() as staging:
            found = self._found(staging)
            if lists:
                paths = [f"{self.path}/{name}" for name in lists]
                known = self.spark.read.schema(_LISTED).option("recursiveFileLookup", True).parquet(*paths)
                found = found.join(known.select("path"), "path", "left_anti")
            rows = staging.write(
                found.orderBy("modified", "path").withColumn("_id", F.monotonically_increasing_id()), "sorted"
            )
            if rows.isEmpty():
                return True
            return self._publish(self._cut(rows), f"list-{len(lists) + 1:08d}")

    def _cut(self, rows: DataFrame) -> DataFrame:
        """Add `batch`: how often the weights of the rows before, in the order of `_id`, make up the limit."""
        weight = F.col(self.weight) if self.weight else F.lit(1).cast("bigint")
        rows = rows.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn("_weight", weight)

        def before(window) -> Column:
            return F.coalesce(F.sum("_weight").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

        parts = rows.groupBy("_part").agg(F.sum("_weight").alias("_weight"))
        offsets = parts.select("_part", before(Window.orderBy("_part")).alias("_before"))
        inside = rows.withColumn("_inside", before(Window.partitionBy("_part").orderBy("_id")))
        return inside.join(F.broadcast(offsets), "_part").select(
            "path", "modified", "length", F.lit(None).cast("string").alias("error"),
            F.expr(f"(_before + _inside) div {self.limit}L").alias("batch"),
        )

    def _publish(self, rows: DataFrame, name: str) -> bool:
        """Write a file for each batch where no stream looks, then show all at once."""
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        try:
            (
                rows.repartition("batch").sortWithinPartitions("batch", "modified", "path")
                .write.option("maxRecordsPerFile", 0).partitionBy("batch").parquet(draft, compression=CODEC)
            )
            # Spark's source goes by the times of the lists.
            now = int(time.time() * 1000)
            batches = [n for n in files.list_names(self.spark, draft) if n.startswith("batch=")]
            for number, batch in enumerate(sorted(batches, key=lambda n: int(n.split("=")[1]))):
                for part in files.list_names(self.spark, f"{draft}/{batch}"):
                    if not _hidden(part):
                        files.set_modified(self.spark, f"{draft}/{batch}/{part}", now + number)
            if files.claim(self.spark, draft, f"{self.path}/{name}"):
                return True
        except Exception:
            files.delete(self.spark, draft)
            raise
        files.delete(self.spark, draft)
        return False

    def _fail(self, error: str) -> None:
        """Publish the error as a batch."""
        draft, shown = (f"{self.path}/{kind}-{uuid.uuid4().hex}" for kind in ("_draft", "failed"))
        row = self.spark.createDataFrame([(None, None, None, error)], _LISTED)
        row.coalesce(1).write.parquet(draft)
        files.claim(self.spark, draft, shown)


class _Watcher(StreamingQueryListener):
    """Lists trees anew for the queries that stream them: before one starts, and while it waits for files."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.listings: dict[str, Listing] = {}
        self._used: dict[str, list[Listing]] = {}

    def _read_by(self, query_id: str) -> list[Listing]:
        """The lists a query streams; all of them if its plan does not tell."""
        try:
            leaves = self._spark.streams.get(query_id)._jsq.streamingQuery().analyzedPlan().collectLeaves()
        except (AttributeError, Py4JError):
            return list(self.listings.values())
        sources = [leaves.apply(n) for n in range(leaves.size())]
        names = [s.sourceName() for s in sources if s.getClass().getSimpleName() == "StreamingRelation"]
        return [listing for path, listing in self.listings.items() if any(path in name for name in names)]

    def onQueryStarted(self, event) -> None:
        # Spark waits for this before it looks for the query's input.
        self._used[str(event.runId)] = used = self._read_by(str(event.id))
        for listing in used:
            listing.refresh()

    def onQueryIdle(self, event) -> None:
        for listing in self._used.get(str(event.runId), []):
            listing.refresh_in_turn()

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._used.pop(str(event.runId), None)


_WATCHERS: dict[SparkSession, _Watcher] = {}


def stream_tree(spark: SparkSession, root: str, pattern: str, weight: str | None, limit: int, tasks: int) -> DataFrame:
    """The files of a tree whose names match a pattern, as they appear: `path`, `modificationTime`, `content`.

    The tree is listed when a query starts, and about every ten seconds while one waits.
    """
    watcher = _WATCHERS.get(spark)
    if watcher is None:
        watcher = _WATCHERS[spark] = _Watcher(spark)
        spark.streams.addListener(watcher)
    listing = Listing(spark, root, pattern, weight, limit)
    return watcher.listings.setdefault(listing.path, listing).stream(tasks)

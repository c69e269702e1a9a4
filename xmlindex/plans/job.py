"""What every flow needs: the session, the configuration, the stores and the publisher."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from xmlindex.config import DEFAULT_BATCH_SIZE, CollectionConfig
from xmlindex.operators.publish import Publisher
from xmlindex.sources.snapshots import CAPACITY, SnapshotStore
from xmlindex.sources.status import StatusStore
from xmlindex.sources.versions import VersionedFolder

_PENDING = "index_name string, tree string, doc_key string"


class PendingRemovals:
    """Collection removals not yet acknowledged, and the documents written since they were asked for.

    A row without `doc_key` is the request; the others name documents the removal must spare.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._versions = VersionedFolder(spark, path)
        self._schema = T._parse_datatype_string(_PENDING)

    def read(self) -> DataFrame:
        version = self._versions.current()
        if version == 0:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self._versions.folder(version))

    def any(self) -> bool:
        return self._versions.current() > 0 and not self.requests().isEmpty()

    def requests(self) -> DataFrame:
        return self.read().where("doc_key is null").select("index_name", "tree").distinct()

    def touched(self) -> DataFrame:
        return self.read().where("doc_key is not null")

    def write(self, rows: DataFrame) -> None:
        version = self._versions.current() + 1
        folder = self._versions.new_folder()
        rows.select("index_name", "tree", "doc_key").distinct().write.mode("errorifexists").parquet(folder)
        self._versions.publish(version, folder)
        self._versions.drop_superseded()

    def add(self, requests: DataFrame) -> None:
        rows = requests.select("index_name", "tree", F.lit(None).cast("string").alias("doc_key"))
        self.write(self.read().unionByName(rows))


@dataclass
class Job:
    spark: SparkSession
    configs: list[CollectionConfig]
    store: SnapshotStore
    status: StatusStore
    publisher: Publisher
    pending: PendingRemovals
    batch_size: int = DEFAULT_BATCH_SIZE
    clock: object = field(default=time.time)

    @classmethod
    def at(cls, spark: SparkSession, path: str, configs: list[CollectionConfig], publisher: Publisher,
           capacity: int = CAPACITY, batch_size: int = DEFAULT_BATCH_SIZE) -> Job:
        """A job whose stores live below `path`; a bucket of the snapshot store takes `capacity` rows."""
        path = path.rstrip("/")
        return cls(
            spark, configs, SnapshotStore(spark, path, capacity), StatusStore(spark, f"{path}/status"),
            publisher, PendingRemovals(spark, f"{path}/pending"), batch_size,
        )

    def now_millis(self) -> int:
        return int(self.clock() * 1000)

    def now_text(self) -> str:
        return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(self.clock()))

    def batch_sizes(self) -> Column:
        """Batch size of a row's index: its own if configured, else the job's."""
        sizes = {
            index.name: index.batch_size
            for config in self.configs for index in config.indexes if index.batch_size
        }
        if not sizes:
            return F.lit(self.batch_size)
        own = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
        return F.coalesce(F.try_element_at(own, F.col("index_name")), F.lit(self.batch_size))

    def record(self, events: DataFrame) -> None:
        """Fold status events into the next version of the status table."""
        self.status.fold(events)

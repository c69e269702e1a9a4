"""Session helpers: builder defaults and the shared staging folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import xmlindex

# Rows a side may have before a broadcast join is no longer asked for.
BROADCAST_ROW_LIMIT = 100_000

# What this package writes is mostly text, which zstd makes a third smaller than Spark's default does.
CODEC = "zstd"


def build_session(app_name: str = "xmlindex", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; `conf` wins over the defaults."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        # Sets of collections per object stay in a hash map; the default falls back to sorting
        # after 128 keys.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.parquet.compression.codec": CODEC,
    }
    defaults.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package() -> None:
    """Send this package's functions to the Python workers with each task.

    For sessions whose executors do not have the package installed.
    """
    cloudpickle.register_pickle_by_value(xmlindex)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def bound_batches(spark: SparkSession, size: int) -> None:
    """Let no Arrow batch of this session go on once it has so many bytes; a lower setting stands.

    Spark has no such setting for a single operator; other operators get more, smaller batches of the same rows.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= size:
        spark.conf.set(key, str(size))


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own; a cluster
    must name a folder every executor can reach.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or _session_conf(
        spark, "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    folder = os.environ.get("XMLINDEX_LOCAL_STAGING")
    if not folder:
        folder = tempfile.mkdtemp(prefix="xmlindex-staging-")
        os.environ["XMLINDEX_LOCAL_STAGING"] = folder
    return folder


def _session_conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key)
    except Exception:
        return None


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_root(spark)}/xmlindex/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the staging folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    schema = df.schema
    df.write.mode("errorifexists").parquet(path, compression=CODEC)
    return spark.read.schema(schema).parquet(path)


class Staging:
    """Intermediate results of one flow, deleted when it ends."""

    def __init__(self) -> None:
        self._written: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Staging:
        return self

    def path(self, spark: SparkSession, label: str) -> str:
        """A fresh path that is deleted when the flow ends."""
        path = staging_path(spark, label)
        self._written.append((spark, path))
        return path

    def write(self, df: DataFrame, label: str) -> DataFrame:
        spark = df.sparkSession
        path = self.path(spark, label)
        df.write.mode("errorifexists").parquet(path, compression=CODEC)
        return spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_error) -> None:
        from xmlindex.sources.files import delete

        for spark, path in self._written:
            delete(spark, path)


def spread(scan: DataFrame) -> DataFrame:
    """A table scan with at least one partition per core, for work that is heavy per row.

    A small file is read by one task; only then are its rows dealt out, before they are turned
    into documents. Scans of any size have splits enough and stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def gathered(files: DataFrame, task_bytes: int = 32 << 20) -> DataFrame:
    """A scan of many small files with tasks of some size each.

    Spark counts 4 MB for opening a file, so a task would get 32 of them, however small they are.
    The planner's estimate of the bytes says how many tasks there should be; cores are kept busy.
    """
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))
    return files.coalesce(tasks) if tasks < files.rdd.getNumPartitions() else files


def is_small(df: DataFrame) -> bool:
    """Does a count confirm that `df` may be broadcast? It stops at the limit."""
    return df.limit(BROADCAST_ROW_LIMIT + 1).count() <= BROADCAST_ROW_LIMIT


def small_side(df: DataFrame) -> DataFrame:
    """`df` marked for broadcast if a count confirms it is small, else unchanged.

    Beyond the limit the join is left to the planner, which shuffles both sides and splits
    skewed partitions.
    """
    return F.broadcast(df) if is_small(df) else df


def join_small(df: DataFrame, small: DataFrame, on: list[str], how: str) -> DataFrame:
    return df.join(small_side(small), on, how)


def restrict(df: DataFrame, keep: DataFrame, drop: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` whose key is in `keep`, given that all others are in `drop`.

    Whichever of the two is small decides without moving `df`; only if neither is, `df` is
    shuffled.
    """
    if is_small(keep):
        return df.join(F.broadcast(keep), on, "left_semi")
    if is_small(drop):
        return df.join(F.broadcast(drop), on, "left_anti")
    return df.join(keep, on, "left_semi")

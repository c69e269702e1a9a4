"""What the operators here share: table access, whole texts, worker caches, column names."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_HOLDER = "_training_data_worker_cache"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, or the empty text for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held(key: tuple, make: Callable[[], Any]) -> Any:
    """`make()` once per Python worker, as long as it asks for nothing else.

    The package's functions may travel by value, and then a global of theirs starts anew with
    every task; a module of its own name in `sys.modules` lasts as long as the worker. A worker
    outlives the step it worked for, so what another step asks for takes the place of the last.
    """
    holder = sys.modules.get(_HOLDER)
    if holder is None:
        holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
        holder.values = {}
    if key not in holder.values:
        holder.values.clear()
        holder.values[key] = make()
    return holder.values[key]


def bound_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let no Arrow batch of this session have more rows, so that whole texts stay few in a worker.

    A lower setting of the session stands.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def unused(columns: list[str], name: str) -> str:
    """`name`, lengthened until no column of the frame has it (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name

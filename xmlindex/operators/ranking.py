"""Exact row positions in a total order, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from xmlindex.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_positions(df: DataFrame, *order: str) -> DataFrame:
    """Add `position`, 1-based, in the given order.

    Rows are range-partitioned and written once, each with its partition and its number in
    it; the offset of a partition is the sum of the row counts before it, a table with one row
    per partition. Writing first fixes the order, so a lost executor cannot change it.
    """
    rows = materialize(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn(
        "_row", F.col("_id") - F.shiftleft("_part", _ROW_BITS)
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part").agg(F.count("*").alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn("position", F.col("_before") + F.col("_row") + 1)
        .drop("_id", "_part", "_row", "_before")
    )

"""Cut changes into ordered, bounded batches and build the request bodies.

Operations are numbered additions first, then updates, then deletions. Numbering a document's
operations with one window would put all of them into one task, so each kind is split by a
hash of the object id: rows are numbered within a slice, and slices are offset by the counts
of those before them, which is a table of at most 3 x 4096 rows per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from xmlindex.config import DEFAULT_BATCH_SIZE
from xmlindex.session import materialize

# The order of operations and the request action of each.
OPERATIONS = ("add", "update", "delete")
ACTIONS = {"add": "addObject", "update": "updateObject", "delete": "deleteObject"}

# Consecutive operations that one window runs over.
BLOCK_ROWS = 4096

_SLICE_DIGITS = 3  # hex digits of the md5 that name a slice


def _rank(op: Column) -> Column:
    return F.array_position(F.array(*[F.lit(o) for o in OPERATIONS]), op)


def _effective_size(batch_size: int | Column) -> Column:
    size = F.lit(batch_size) if isinstance(batch_size, int) else F.coalesce(batch_size, F.lit(DEFAULT_BATCH_SIZE))
    return F.greatest(F.lit(1), size).cast("long")


def number_operations(changes: DataFrame, group: list[str]) -> DataFrame:
    """Add `position` (1-based, per group) and `operations` (the group's total)."""
    hashed = changes.withColumn("op_rank", _rank(F.col("op"))).withColumn(
        "slice", F.substring(F.md5("object_id"), 1, _SLICE_DIGITS)
    )
    slice_key = [*group, "op_rank", "slice"]
    before = Window.partitionBy(*group).orderBy("op_rank", "slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        hashed.groupBy(*slice_key)
        .agg(F.count("*").alias("n"))
        .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("operations", F.sum("n").over(Window.partitionBy(*group)))
        .drop("n")
    )
    within = Window.partitionBy(*slice_key).orderBy(F.md5("object_id"), "object_id")
    return (
        hashed.withColumn("rn", F.row_number().over(within))
        .join(offsets, slice_key)
        .withColumn("position", F.col("offset") + F.col("rn"))
        .drop("slice", "offset", "rn")
    )


def plan_batches(
    changes: DataFrame,
    batch_size: int | Column = DEFAULT_BATCH_SIZE,
    group: tuple[str, ...] = ("index_name", "document_id"),
) -> DataFrame:
    """Add `chunk` and `total_chunks`: which batch of its document an operation belongs to."""
    size = _effective_size(batch_size)
    last = F.col("operations") - 1
    return (
        number_operations(changes, list(group))
        .withColumn("chunk", F.floor((F.col("position") - 1) / size).cast("long") + 1)
        .withColumn("total_chunks", F.floor(last / size).cast("long") + 1)
    )


def _running(rows: DataFrame, group: list[str], value: Column, name: str) -> DataFrame:
    """Add the sum of `value` over a group's rows up to each `position`: within blocks, blocks offset."""
    blocked = rows.withColumn("block", F.floor((F.col("position") - 1) / BLOCK_ROWS)).withColumn("_value", value)
    key = [*group, "block"]
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocked.groupBy(*key).agg(F.sum("_value").alias("_sum")).select(
        *key, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumn("_within", F.sum("_value").over(within))
    return summed.join(offsets, key).withColumn(name, F.col("_before") + F.col("_within")).drop(
        "block", "_value", "_before", "_within"
    )


def _next_cuts(placed: DataFrame, group: list[str], size: Column, max_bytes: int) -> DataFrame:
    """For every operation the first one that no longer fits into a batch that begins with it.

    `placed` has `ends`, the bytes up to and with each operation. Ends and the byte counts that a
    batch may reach meet in cells of `max_bytes`, so a window holds one batch's bytes at most.
    """
    starts = F.col("ends") - F.col("bytes")
    cell = lambda value: F.floor(value / max_bytes).cast("long")
    ends = placed.select(*group, "position", cell(F.col("ends")).alias("cell"), F.col("ends").alias("value"), F.lit(0).alias("kind"))
    reach = placed.select(
        *group, "position", (cell(starts) + 1).alias("cell"), (starts + max_bytes).alias("value"), F.lit(1).alias("kind")
    )
    seen = Window.partitionBy(*group, "cell").orderBy("value", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        ends.unionByName(reach)
        .withColumn("found", F.max(F.when(F.col("kind") == 0, F.col("position"))).over(seen))
        .where("kind = 1").select(*group, "position", "found")
    )
    last = ends.groupBy(*group, "cell").agg(F.max("position").alias("last"))
    joined = (
        placed.select(*group, "position", "operations", size.alias("size"), cell(starts).alias("cell"))
        .join(found, [*group, "position"])
        .join(last, [*group, "cell"], "left")
    )
    fits = F.greatest(F.col("position"), F.coalesce("found", F.col("position")), F.coalesce("last", F.col("position")))
    following = F.least(F.col("position") + F.col("size"), fits + 1)
    return joined.select(*group, "position", following.alias("following")).where(F.col("following") <= F.col("operations"))


def plan_sized_batches(
    changes: DataFrame,
    bytes: Column,
    max_bytes: int,
    batch_size: int | Column = DEFAULT_BATCH_SIZE,
    group: tuple[str, ...] = ("index_name", "document_id"),
) -> DataFrame:
    """Like `plan_batches`, with batches of at most `max_bytes` too; `bytes` is the size of an operation.

    A batch takes operations in order for as long as both limits hold, and one at least. Where
    the next cut would be is known for every operation; doubling these jumps - two, four, eight
    cuts on - marks all cuts that are reached from the first operation in as many rounds as the
    logarithm of the number of batches, so no document is walked through by one task. Only the
    operations of groups that are too large for one batch take part.
    """
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    keys = list(group)
    size = _effective_size(batch_size)
    numbered = number_operations(changes, keys).withColumn("bytes", bytes.cast("long"))
    placed = materialize(_running(numbered, keys, F.col("bytes"), "ends"), "placed")
    large = placed.groupBy(*keys).agg(F.max("ends").alias("total")).where(F.col("total") > max_bytes).drop("total")
    large = materialize(large, "large")
    bound = placed.join(large, keys, "left_semi")
    jumps = materialize(_next_cuts(bound, keys, size, max_bytes), "jumps")
    marks = fresh = materialize(bound.where("position = 1").select(*keys, "position"), "marks")
    while True:
        fresh = materialize(
            marks.join(jumps, [*keys, "position"]).select(*keys, F.col("following").alias("position")), "marks"
        )
        if fresh.isEmpty():
            break
        marks = marks.unionByName(fresh)
        after = jumps.select(*keys, F.col("position").alias("following"), F.col("following").alias("further"))
        jumps = materialize(
            jumps.join(after, [*keys, "following"]).select(*keys, "position", F.col("further").alias("following")), "jumps"
        )
    by_count = placed.join(large, keys, "left_anti").where((F.col("position") - 1) % size == 0).select(*keys, "position")
    cuts = marks.unionByName(by_count).withColumn("cut", F.lit(1))
    flagged = placed.join(cuts, [*keys, "position"], "left")
    chunked = _running(flagged, keys, F.coalesce("cut", F.lit(0)), "chunk").drop("cut", "ends")
    totals = cuts.groupBy(*keys).agg(F.count("*").alias("total_chunks"))
    return chunked.join(totals, keys).withColumn("chunk", F.col("chunk").cast("long"))


def chunk_plan(batches: DataFrame, group: tuple[str, ...] = ("index_name", "document_id")) -> DataFrame:
    """One row per batch with the number of operations of each kind."""
    return batches.groupBy(*group, "chunk", "total_chunks").agg(
        F.count_if(F.col("op") == "add").alias("additions"),
        F.count_if(F.col("op") == "update").alias("updates"),
        F.count_if(F.col("op") == "delete").alias("deletions"),
    )


def batch_totals(changes: DataFrame, group: list[str]) -> DataFrame:
    """Operations of each kind per change set."""
    return changes.groupBy(*group).agg(
        F.count_if(F.col("op") == "add").alias("additions"),
        F.count_if(F.col("op") == "update").alias("updates"),
        F.count_if(F.col("op") == "delete").alias("deletions"),
    )


def request_json(op: Column | str, object_id: Column | str, record_json: Column | str) -> Column:
    """One request; stored record text goes in unchanged."""
    from xmlindex.functions.records import json_string

    op, record_json = (F.col(c) if isinstance(c, str) else c for c in (op, record_json))
    action = F.element_at(F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair]), op)
    body = F.when(
        op == "delete", F.concat(F.lit('{"objectID":'), json_string(object_id), F.lit("}"))
    ).otherwise(record_json)
    return F.concat(F.lit('{"body":'), body, F.lit(',"action":"'), action, F.lit('"}'))


def assemble_batches(batches: DataFrame, group: tuple[str, ...] = ("index_name", "document_id")) -> DataFrame:
    """One row per batch: its `body`, with at most `batch_size` requests in order."""
    request = F.struct("position", request_json("op", "object_id", "record_json").alias("request"))
    requests = F.transform(F.array_sort(F.collect_list(request)), lambda r: r["request"])
    return (
        batches.groupBy(*group, "chunk", "total_chunks")
        .agg(
            F.count("*").alias("requests"),
            F.concat(F.lit('{"requests":['), F.array_join(requests, ","), F.lit("]}")).alias("body"),
        )
    )


def single_batches(batches: DataFrame, group: tuple[str, ...] = ("index_name", "document_id")) -> DataFrame:
    """`assemble_batches` where every batch has one operation: request text is not moved."""
    request = request_json("op", "object_id", "record_json")
    return batches.select(
        *group, "chunk", "total_chunks", F.lit(1).cast("bigint").alias("requests"),
        F.concat(F.lit('{"requests":['), F.coalesce(request, F.lit("")), F.lit("]}")).alias("body"),
    )


def touched_collections(changes: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Distinct collections a change set touches, per index: of its records and of the documents."""
    rows = changes.where("op <> 'delete'").select("index_name", "collection")
    if documents is not None:
        rows = rows.unionByName(documents.select("index_name", "collection"))
    return rows.where("collection is not null").distinct()

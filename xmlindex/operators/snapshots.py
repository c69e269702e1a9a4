"""Snapshots of documents: newest, previous, duplicates, and the difference between two.

Joins and aggregates key on (index, document key, node key), so a document or collection that
holds a large share of all records is still spread over all partitions. The difference
compares checksums only; record text is fetched for the records that changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DOCUMENT_KEY = ["index_name", "doc_key"]
RECORD_KEY = ["index_name", "doc_key", "node_key"]


def dedup_last_write(records: DataFrame, keys: list[str], order: str | Column | list) -> DataFrame:
    """One row per key: the last in `order` (a column, or several compared in turn).

    The aggregate keeps one row per key on the map side already, so a key written a million
    times costs a million comparisons, not a million shuffled rows.
    """
    order = order if isinstance(order, list) else [order]
    ordering = F.struct(*order)
    rest = [c for c in records.columns if c not in keys]
    last = F.max_by(F.struct(*rest), ordering)
    return records.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def latest_timestamps(snapshots: DataFrame, before: Column | None = None) -> DataFrame:
    """Newest snapshot time per document, optionally only among those before a time (an as-of lookup)."""
    if before is not None:
        snapshots = snapshots.where(F.col("snapshot_ts") < before)
    return snapshots.groupBy(*DOCUMENT_KEY).agg(F.max("snapshot_ts").alias("snapshot_ts"))


def previous_timestamps(snapshots: DataFrame) -> DataFrame:
    """The time before the newest, per document that has one.

    Times are made distinct first, and the filter on the row number lets Spark drop all but
    two per document before the rows are exchanged.
    """
    newest_first = Window.partitionBy(*DOCUMENT_KEY).orderBy(F.desc("snapshot_ts"))
    return (
        snapshots.select(*DOCUMENT_KEY, "snapshot_ts").distinct()
        .withColumn("rn", F.row_number().over(newest_first))
        .where("rn <= 2")
        .where("rn = 2")
        .drop("rn")
    )


def at_timestamps(snapshots: DataFrame, timestamps: DataFrame) -> DataFrame:
    """Records of the snapshots taken at the given times; documents emptied then have none."""
    rows = snapshots.join(timestamps, [*DOCUMENT_KEY, "snapshot_ts"], "left_semi")
    return rows.where("node_key is not null")


def latest_snapshot(snapshots: DataFrame, before: Column | None = None) -> DataFrame:
    """Records of the newest snapshot of every document."""
    return at_timestamps(snapshots, latest_timestamps(snapshots, before))


def previous_snapshot(snapshots: DataFrame) -> DataFrame:
    """Records of the snapshot before the newest."""
    return at_timestamps(snapshots, previous_timestamps(snapshots))


def diff_snapshots(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Additions, updates and deletions that turn `previous` into `current`.

    Both have `index_name, doc_key, node_key, object_id, collection, document_id, md5`. The
    result has these plus `op`; deletions carry the previous object id and are left out
    without one. With no previous rows everything is an addition.
    """
    slim = [*RECORD_KEY, "object_id", "collection", "document_id", "md5"]
    before = previous.select(*RECORD_KEY, F.struct(*slim[3:]).alias("p"))
    after = current.select(*RECORD_KEY, F.struct(*slim[3:]).alias("c"))
    op = (
        F.when(F.col("p").isNull(), "add")
        .when(F.col("c").isNull(), "delete")
        .when(F.col("p.md5") != F.col("c.md5"), "update")
    )
    return (
        before.join(after, RECORD_KEY, "full_outer")
        .withColumn("op", op)
        .where("op is not null and (op <> 'delete' or p.object_id is not null)")
        .select(
            *RECORD_KEY,
            "op",
            F.coalesce("c.object_id", "p.object_id").alias("object_id"),
            F.coalesce("c.collection", "p.collection").alias("collection"),
            F.coalesce("c.document_id", "p.document_id").alias("document_id"),
        )
    )


def with_record_json(changes: DataFrame, current: DataFrame) -> DataFrame:
    """Add the record text of additions and updates; deletions have none."""
    texts = current.select(*RECORD_KEY, "record_json")
    return changes.join(texts, RECORD_KEY, "left").withColumn(
        "record_json", F.when(F.col("op") != "delete", F.col("record_json"))
    )


def document_collection(previous: DataFrame, current: DataFrame, changes: DataFrame) -> DataFrame:
    """Collection of a document: that of its first addition, update, current or previous record."""
    def ranked(df: DataFrame, rank: Column) -> DataFrame:
        return df.select(*DOCUMENT_KEY, "collection", "node_key", rank.alias("rank"))

    op = F.col("op")
    rows = (
        ranked(changes.where(op.isin("add", "update")), F.when(op == "add", 0).otherwise(1))
        .unionByName(ranked(current, F.lit(2)))
        .unionByName(ranked(previous, F.lit(3)))
        .where("collection is not null")
    )
    return rows.groupBy(*DOCUMENT_KEY).agg(
        F.min_by("collection", F.struct("rank", "node_key")).alias("collection")
    )


def local_state(latest: DataFrame, tree: Column | str) -> DataFrame:
    """Latest valid records in a collection tree, one per object id (the last written wins)."""
    from xmlindex.functions.paths import in_collection_tree

    valid = latest.where("object_id <> '' and collection <> ''").where(in_collection_tree("collection", tree))
    return dedup_last_write(valid, ["index_name", "object_id"], ["doc_key", "node_key"])

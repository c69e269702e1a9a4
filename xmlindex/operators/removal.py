"""What has to go when documents, collections or an index are removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from xmlindex.config import CollectionConfig
from xmlindex.functions.paths import ancestors, in_collection_tree
from xmlindex.operators.extract import index_table, resolve_config
from xmlindex.operators.snapshots import DOCUMENT_KEY
from xmlindex.operators.sync import TREE_KEY, in_trees, valid_records
from xmlindex.session import join_small


def removal_scope(requests: DataFrame, configs: list[CollectionConfig]) -> DataFrame:
    """Collection removals to act on, once per index of the collection.

    Requests made by a re-index are left out (the snapshot difference deals with them), and
    so are collections without a configuration.
    """
    indexes = index_table(requests.sparkSession, configs).drop("document_id_slot")
    return (
        resolve_config(requests.where("not reindex"), configs)
        .join(F.broadcast(indexes), "config_no")
        .drop("config_no", "reindex")
        .withColumnRenamed("collection", "tree")
    )


def removal_candidates(latest: DataFrame, requests: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Distinct object ids per requested tree, without documents written again since.

    `requests` has `index_name, tree`; `touched` has `index_name, tree, doc_key`.
    """
    rows = in_trees(valid_records(latest), requests)
    if touched is not None:
        rows = rows.join(touched, [*TREE_KEY, "doc_key"], "left_anti")
    return rows.select(*TREE_KEY, "object_id").distinct()


def stale_removals(latest: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested trees that have no stored record at all."""
    held = in_trees(valid_records(latest), requests).select(*TREE_KEY).distinct()
    return requests.select(*TREE_KEY).distinct().join(held, TREE_KEY, "left_anti")


def covered_by_removal(events: DataFrame, removals: DataFrame) -> DataFrame:
    """Events that come after every removal of a tree they lie in.

    Both have `sequence`; `removals` names its `tree`. Only distinct collections are matched
    with trees, so the documents themselves are joined with a small table once.
    """
    last = (
        events.select("collection").distinct()
        .select("collection", F.explode(ancestors("collection")).alias("tree"))
        .join(removals.groupBy("tree").agg(F.max("sequence").alias("removed_at")), "tree")
        .groupBy("collection")
        .agg(F.max("removed_at").alias("removed_at"))
    )
    return (
        join_small(events, last, ["collection"], "left")
        .where("removed_at is null or sequence > removed_at")
        .drop("removed_at")
    )


def document_removals(latest: DataFrame, documents: DataFrame) -> DataFrame:
    """Delete operations for all records of the given documents; none stored means none."""
    return (
        latest.join(documents.select(*DOCUMENT_KEY).distinct(), DOCUMENT_KEY, "left_semi")
        .where("object_id is not null")
        .select(
            "index_name", "doc_key", "node_key", F.lit("delete").alias("op"),
            "object_id", "collection", "document_id",
        )
    )


def tombstones(documents: DataFrame, snapshot_ts: int | None = None) -> DataFrame:
    """Snapshot rows saying that a document now has no records.

    Without `snapshot_ts` every document brings its own time in that column.
    """
    text = F.lit(None).cast("string")
    if snapshot_ts is not None:
        documents = documents.withColumn("snapshot_ts", F.lit(snapshot_ts).cast("bigint"))
    return documents.select(*DOCUMENT_KEY, "snapshot_ts").distinct().select(
        *DOCUMENT_KEY,
        "snapshot_ts",
        *[text.alias(c) for c in ("node_key", "object_id", "collection", "document_id",
                                  "user_document_id", "record_json", "md5")],
    )


def delete_by_collection(records: DataFrame, collection: str) -> DataFrame:
    """Records of exactly this collection."""
    return records.where(F.col("collection") == collection)


def delete_by_tree(records: DataFrame, tree: str) -> DataFrame:
    """Records of this collection and those below it."""
    return records.where(in_collection_tree("collection", tree))


def delete_by_document(records: DataFrame, document_id: str | int) -> DataFrame:
    """Records of one document; text matches user-specified ids, a number internal ones."""
    if isinstance(document_id, str):
        return records.where(F.col("user_document_id") == document_id)
    return records.where(
        F.col("user_document_id").isNull() & (F.col("document_id") == F.lit(str(document_id)))
    )

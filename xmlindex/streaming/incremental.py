"""Keep the index up to date from a stream of document events.

Events have `sequence` (their order), `op` (`upsert`, `delete` or `remove_collection`),
`collection`, `collection_id`, `document_id`, `user_document_id` (null unless known) and `xml`.
With a column `event_ts` (milliseconds) a document is as old as that says, whenever it arrives: of
several versions the newest counts, and one that comes late goes to its place in the history.
Collections are removed when the event arrives.
State is the snapshot store, so a restart carries on where the checkpoint says, and a batch
that is repeated replaces what it wrote.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from xmlindex.config import CollectionConfig
from xmlindex.operators.extract import index_table, resolve_config
from xmlindex.operators.removal import covered_by_removal, removal_scope
from xmlindex.plans.indexing import index_documents, remove_documents
from xmlindex.plans.job import Job
from xmlindex.plans.removing import flush_removals, request_removals
from xmlindex.session import Staging, gathered
from xmlindex.sources import files

UPSERT, DELETE, REMOVE_COLLECTION = "upsert", "delete", "remove_collection"


def surviving_events(events: DataFrame, configs: list[CollectionConfig] | None = None) -> DataFrame:
    """The last event of each document, without those a later collection removal covers.

    With `configs`, only removals that will be acted on cover events. Deciding needs no document
    text: only (document, sequence) is aggregated, and both tell the survivor.
    """
    removals = events.where(F.col("op") == REMOVE_COLLECTION).select("collection", "sequence")
    if configs is not None:
        removals = removal_scope(removals.withColumn("reindex", F.lit(False)), configs).select("tree", "sequence")
    else:
        removals = removals.withColumnRenamed("collection", "tree")
    documents = events.where(F.col("op") != REMOVE_COLLECTION)
    key = ["collection", "document_id"]
    order = F.struct("event_ts", "sequence") if "event_ts" in events.columns else F.col("sequence")
    last = documents.groupBy(*key).agg(F.max_by("sequence", order).alias("sequence"))
    kept = covered_by_removal(last, removals).select(*key, "sequence")
    return documents.join(kept, [*key, "sequence"], "left_semi")


def apply_events(job: Job, events: DataFrame, commit: str, snapshot_ts: int | None = None) -> None:
    """One batch: collections are removed first, then what came after them is applied."""
    snapshot_ts = job.now_millis() if snapshot_ts is None else snapshot_ts
    times = ["event_ts"] if "event_ts" in events.columns else []
    with Staging() as staging:
        events = staging.write(gathered(events), "events")
        kept = surviving_events(events, job.configs)
        upserts = kept.where(F.col("op") == UPSERT)
        deletes = kept.where(F.col("op") == DELETE)

        removals = events.where(F.col("op") == REMOVE_COLLECTION).select("collection").distinct()
        if not removals.isEmpty():
            requests = removal_scope(removals.withColumn("reindex", F.lit(False)), job.configs)
            request_removals(job, requests)
        if job.pending.any():
            flush_removals(job, f"{commit}-collections", snapshot_ts)
        if not deletes.isEmpty():
            remove_documents(job, _index_keys(job, deletes, f"{commit}-documents"), f"{commit}-documents", snapshot_ts + 1)
        if not upserts.isEmpty():
            documents = upserts.select("collection", "collection_id", "document_id", "xml", *times)
            index_documents(
                job, documents, f"{commit}-upserts", snapshot_ts + 2, on_malformed="skip", event_time=times[0] if times else None
            )


def _index_keys(job: Job, deletes: DataFrame, commit: str) -> DataFrame:
    """(index, document key) of deleted documents, for every index of their collection.

    An event without the user's id is looked up by collection and internal id among the keys of
    the store, since the internal id of one document may be the user's id of another.
    """
    names = index_table(job.spark, job.configs)
    asked = (
        resolve_config(deletes.drop("xml"), job.configs)
        .join(F.broadcast(names), "config_no")
        .select("index_name", "collection", F.col("document_id").cast("string").alias("document_id"), "user_document_id",
                *(F.col(c).alias("snapshot_ts") for c in deletes.columns if c == "event_ts"))
    )
    times = [c for c in asked.columns if c == "snapshot_ts"]
    latest = [F.max(c).alias(c) for c in times]

    def once(keys: DataFrame) -> DataFrame:
        return keys.groupBy("index_name", "doc_key").agg(*latest) if latest else keys.distinct()

    known = asked.where("user_document_id is not null").select("index_name", F.col("user_document_id").alias("doc_key"), *times)
    unknown = asked.where("user_document_id is null").drop("user_document_id")
    if unknown.isEmpty():
        return once(known)
    internal = ["index_name", "collection", "document_id"]
    trees = unknown.select(F.col("collection").alias("tree"))
    held = job.store.listing_of(trees, without_commit=commit).select(*internal, "doc_key").join(unknown, internal)
    return once(known.unionByName(held.select("index_name", "doc_key", *times)))


def start_incremental(job: Job, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
    """Apply a stream of events; `trigger` as for `DataStreamWriter.trigger`.

    Commits are named after the id that the checkpoint holds, so two streams, or one that starts
    anew with a new checkpoint at the same path, never replace each other's.
    """
    def each(batch: DataFrame, number: int) -> None:
        name = json.loads(files.read_text(job.spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        apply_events(job, batch, f"{name}-b{number}")

    writer: DataStreamWriter = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()

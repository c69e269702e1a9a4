"""Bring store, index and status back in step: replay, refresh, reconcile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from xmlindex.operators.batches import assemble_batches
from xmlindex.operators.publish import REPLAY_BATCH_SIZE
from xmlindex.operators.ranking import with_positions
from xmlindex.operators.status import DEGRADED, refresh_status
from xmlindex.operators.sync import matching_documents, replay_plan, sync_report
from xmlindex.plans.indexing import reindex_collection
from xmlindex.plans.job import Job
from xmlindex.session import materialize

# Reads the index as it is now.
LiveReader = Callable[[], DataFrame]


def report_for(job: Job, index_name: str, tree: str, live: DataFrame, with_status: bool = True) -> DataFrame:
    """Sync report of one tree of one index."""
    local = job.store.listing(tree).where(F.col("index_name") == index_name).drop("document_id")
    trees = job.spark.createDataFrame([(index_name, tree)], "index_name string, tree string")
    status = job.status.read() if with_status else None
    return sync_report(
        local.withColumnRenamed("user_document_id", "document_id"),
        live.where(F.col("index_name") == index_name), trees, status,
    )


def replay_batches(plan: DataFrame, size: int = REPLAY_BATCH_SIZE) -> DataFrame:
    """Batches of a replay plan in its order: deletions by id, then additions by id.

    `phase` says which batches may be sent side by side: all that delete only (1), the one
    that does both (2), all that add only (3).
    """
    placed = with_positions(plan, "index_name", "action_rank", "object_id")
    first = placed.groupBy("index_name").agg(
        F.min("position").alias("first"), F.count("*").alias("operations")
    )
    chunk = F.floor((F.col("position") - F.col("first")) / size).cast("long") + 1
    chunked = (
        placed.join(F.broadcast(first), "index_name")
        .withColumn("chunk", chunk)
        .withColumn("total_chunks", F.floor((F.col("operations") - 1) / size).cast("long") + 1)
    )
    ranks = chunked.groupBy("index_name", "chunk").agg(
        F.min("action_rank").alias("low"), F.max("action_rank").alias("high")
    )
    phase = F.when(F.col("low") != F.col("high"), 2).when(F.col("low") == 1, 1).otherwise(3)
    bodies = assemble_batches(chunked, ("index_name",))
    return bodies.join(ranks, ["index_name", "chunk"]).withColumn("phase", phase).drop("low", "high")


def replay(job: Job, index_name: str, tree: str, live: LiveReader, commit: str) -> tuple[DataFrame, DataFrame]:
    """Rebuild one tree of the index from the store; returns outcomes and the report afterwards.

    A phase with a refused batch is the last one, so nothing is added on top of what was not deleted.
    """
    local = job.store.latest().where(F.col("index_name") == index_name).drop("document_id")
    local = local.withColumnRenamed("user_document_id", "document_id")
    plan = replay_plan(local, live().where(F.col("index_name") == index_name), tree)
    batches = materialize(replay_batches(plan), "replay")
    outcomes = None
    for phase in (1, 2, 3):
        sent = job.publisher.publish(batches.where(F.col("phase") == phase), f"{commit}-{phase}")
        outcomes = sent if outcomes is None else outcomes.unionByName(sent)
        if not sent.where(F.col("state") == DEGRADED).isEmpty():
            break
    return outcomes, report_for(job, index_name, tree, live(), with_status=False)


def refresh(job: Job, index_name: str, tree: str, live: DataFrame) -> DataFrame:
    """Mark a tree that is in step as current; raises if it is not."""
    report = materialize(report_for(job, index_name, tree, live), "report")
    job.status.write(refresh_status(report, job.status.read(), job.now_text()))
    return report


def reconcile(
    job: Job, index_name: str, tree: str, documents: DataFrame, live: LiveReader, commit: str,
    quarantine_name: str, force: bool = False, allow: bool = False, rounds: int = 5, report: DataFrame | None = None,
) -> DataFrame:
    """Set the stored snapshots of a tree aside and index it anew, until that changes nothing more;
    returns the final report.

    A round sets aside what the store holds of the tree, extracts its documents again, sends all of
    them and reports. Rounds end once the tree is in step, two reports in a row agree (what is wrong
    then, such as records that only the index has, indexing does not mend), or after `rounds`. Later
    rounds add their number to the names of commit and quarantine. Does nothing if the tree is in
    step, unless forced. Changes the store, hence `allow`. `report` is the tree's `report_for` as things
    are, if there is one already.
    """
    if not allow:
        raise PermissionError("reconcile changes the snapshot store; pass allow=True to do so")
    if report is None:
        report = materialize(report_for(job, index_name, tree, live()), "report")
    if report.select("synced").first()[0] and not force:
        return report
    trees = job.spark.createDataFrame([(index_name, tree)], "index_name string, tree string")
    seen = _findings(report)
    for number in range(1, rounds + 1):
        suffix = "" if number == 1 else f"-{number}"
        local = job.store.listing(tree).where(F.col("index_name") == index_name)
        job.store.quarantine(matching_documents(local, trees).drop("tree"), quarantine_name + suffix)
        reindex_collection(job, documents, tree, commit + suffix)
        report = materialize(report_for(job, index_name, tree, live()), "report")
        before, seen = seen, _findings(report)
        if seen["synced"] or seen == before:
            break
    return report


def _findings(report: DataFrame) -> dict:
    """What a report of one tree says of store and index, without the times of the status."""
    counts = [c for c in report.columns if c.endswith("_count") or c.startswith("sample_")]
    return report.select("synced", "classification", *counts).first().asDict()

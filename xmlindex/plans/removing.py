"""Remove collections and indexes: first from the index, then from the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from xmlindex.operators.batches import assemble_batches, plan_batches
from xmlindex.operators.removal import removal_candidates, stale_removals, tombstones
from xmlindex.operators.snapshots import DOCUMENT_KEY
from xmlindex.operators.status import (
    COLLECTION_DELETE, CURRENT, DEGRADED, INDEX_DROP, outcome_events, stale_events,
)
from xmlindex.operators.sync import TREE_KEY, in_trees
from xmlindex.plans.job import Job
from xmlindex.session import materialize


def request_removals(job: Job, requests: DataFrame) -> DataFrame:
    """Register collection removals (`index_name, tree`); returns those with nothing stored.

    The latter are marked stale: without stored records there is no telling what to delete.
    """
    asked = materialize(requests.select(*TREE_KEY).distinct(), "requests")
    stale = materialize(stale_removals(job.store.listing_of(asked), asked), "stale")
    job.pending.add(asked)
    if not stale.isEmpty():
        job.record(stale_events(stale, job.now_text(), job.now_millis()))
    return stale


def flush_removals(job: Job, commit: str, snapshot_ts: int | None = None) -> DataFrame:
    """Carry out pending removals; returns one outcome per tree that had records.

    Stored records go only after the index accepted the deletion. A tree that failed stays
    pending for the next flush.
    """
    snapshot_ts = job.now_millis() if snapshot_ts is None else snapshot_ts
    requests = materialize(job.pending.requests(), "requests")
    touched = materialize(job.pending.touched(), "touched")
    latest = job.store.listing_of(requests, without_commit=commit)
    deletes = materialize(
        removal_candidates(latest, requests, touched).select(
            *TREE_KEY, "object_id", F.lit("delete").alias("op"),
            F.lit(None).cast("string").alias("record_json"),
        ),
        "deletes",
    )
    batches = assemble_batches(plan_batches(deletes, job.batch_sizes(), ("index_name", "tree")), ("index_name", "tree"))
    sent = job.publisher.publish(batches, commit)
    failed = F.col("state") == DEGRADED
    outcomes = materialize(
        sent.groupBy(*TREE_KEY).agg(
            F.when(F.bool_or(failed), DEGRADED).otherwise(CURRENT).alias("state"),
            F.sum("requests").alias("object_count"),
            F.max(F.when(failed, F.struct("failure_class", "failure_message"))).alias("failure"),
        ).select(*TREE_KEY, "state", "object_count", "failure.failure_class", "failure.failure_message"),
        "outcomes",
    )
    done = requests.join(outcomes.where(F.col("state") == DEGRADED), TREE_KEY, "left_anti")
    gone = (
        in_trees(latest.where("collection is not null"), done)
        .join(touched, [*TREE_KEY, "doc_key"], "left_anti")
        .select(*DOCUMENT_KEY)
    )
    job.store.append(tombstones(materialize(gone.distinct(), "gone"), snapshot_ts), commit)
    job.pending.write(job.pending.read().join(done, TREE_KEY, "left_anti"))
    rows = outcomes.withColumnRenamed("tree", "collection")
    job.record(outcome_events(rows, COLLECTION_DELETE, job.now_text(), job.now_millis()))
    return outcomes


def remove_collections(job: Job, requests: DataFrame, commit: str, snapshot_ts: int | None = None) -> DataFrame:
    """Register and carry out removals at once."""
    request_removals(job, requests)
    return flush_removals(job, commit, snapshot_ts)


def drop_index(job: Job, index_name: str) -> None:
    """Delete an index and all that is stored about it."""
    try:
        job.publisher.drop_index(index_name)
        state, failure = CURRENT, (None, None)
    except Exception as error:
        state, failure = DEGRADED, (type(error).__name__, str(error))
    row = (index_name, None, INDEX_DROP, state, job.now_text(), job.now_millis(), None, *failure)
    job.record(job.spark.createDataFrame(
        [row],
        "index_name string, collection string, operation string, state string, ts string, seq bigint, "
        "object_count bigint, failure_class string, failure_message string",
    ))
    if state == CURRENT:
        job.store.drop_index(index_name)


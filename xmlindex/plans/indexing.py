"""Index documents: extract, compare with the stored snapshot, publish, remember, report.

The snapshot of a document is stored only after its changes were accepted, so a failed batch
is found again by the next run. Every step that is read twice is written to the staging
folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from xmlindex.functions.paths import in_collection_tree
from xmlindex.operators.batches import assemble_batches, plan_batches, single_batches
from xmlindex.operators.extract import MARKER_COLUMNS, build_records, processed_documents, resolve_config, skipped_documents
from xmlindex.operators.removal import document_removals, tombstones
from xmlindex.operators.shred import shred_documents
from xmlindex.operators.snapshots import DOCUMENT_KEY, RECORD_KEY, diff_snapshots
from xmlindex.operators.status import BATCH_WRITE, DEGRADED, DOCUMENT_DELETE, outcome_events, status_gate
from xmlindex.operators.sync import in_trees
from xmlindex.plans.job import Job
from xmlindex.session import Staging, materialize, restrict, small_side
from xmlindex.sources.snapshots import snapshot_rows

_GROUP = ("index_name", "doc_key")


def without_moved(changes: DataFrame) -> DataFrame:
    """Drop deletions of object ids that another document of the same run adds or updates.

    A record that moved to another document keeps its object id; whichever order the two
    documents are sent in, it has to be there in the end.
    """
    written = changes.where("op <> 'delete'").select("index_name", "object_id")
    deletes = changes.where("op = 'delete'").join(written, ["index_name", "object_id"], "left_anti")
    return changes.where("op <> 'delete'").unionByName(deletes)


def publish_changes(job: Job, changes: DataFrame, commit: str, texts: DataFrame | None = None) -> DataFrame:
    """Plan, assemble and send changes; one outcome per document.

    Batches are planned on keys alone. `texts` holds the record text of additions and updates
    by record key; it is joined only then.
    """
    failed = F.col("state") == DEGRADED
    no_text = F.lit(None).cast("string").alias("record_json")
    with Staging() as staging:
        planned = staging.write(plan_batches(changes, job.batch_sizes(), _GROUP), "planned")
        requests = planned.where("op = 'delete'").select("*", no_text)
        upserts = planned.where("op <> 'delete'")
        if texts is not None:
            requests = requests.unionByName(texts.join(upserts, RECORD_KEY))
        several = planned.where("operations > 1")
        bodies = single_batches(requests, _GROUP) if several.isEmpty() else assemble_batches(requests, _GROUP)
        outcomes = job.publisher.publish(bodies, commit)
        per_document = outcomes.groupBy(*_GROUP).agg(
            F.when(F.bool_or(failed), DEGRADED).otherwise("current").alias("state"),
            F.sum("requests").alias("object_count"),
            F.max(F.when(failed, F.struct("failure_class", "failure_message"))).alias("failure"),
        )
        return materialize(
            per_document.select(*_GROUP, "state", "object_count", "failure.failure_class", "failure.failure_message"),
            "documents",
        )


def late_documents(job: Job, times: DataFrame, commit: str) -> DataFrame:
    """Those documents of which the store has a newer snapshot than the one that comes now."""
    held = job.store.times_of(times, without_commit=commit)
    return times.join(held, DOCUMENT_KEY).where("snapshot_ts < held_ts").drop("held_ts")


def index_documents(
    job: Job, documents: DataFrame, commit: str, snapshot_ts: int | None = None, on_malformed: str = "fail",
    event_time: str | None = None,
) -> DataFrame:
    """Bring the index up to date with `documents`; returns one outcome per changed document.

    `event_time` names a column with the time each document was as it is here (a number, one
    version of a document a run). A version older than the newest one stored takes its place in
    the history, if it differs from the one before it, and nothing of it is sent.

    Documents that are not well-formed keep their stored records; with `on_malformed="skip"`
    they degrade the status of their collection instead of ending the run. Those whose `xml` is
    null do so in both modes.
    """
    snapshot_ts = job.now_millis() if snapshot_ts is None else snapshot_ts
    with Staging() as staging:
        # Texts are staged once, as records; the documents' marker rows go with them.
        shredded = shred_documents(resolve_config(documents, job.configs), job.configs, on_malformed)
        marked = [c for c in documents.columns if c != "xml"]
        extracted = staging.write(
            build_records(shredded, job.configs, markers=True)
            .withColumn("written", F.monotonically_increasing_id())
            .select(*marked, *MARKER_COLUMNS, "index_name", "doc_key", "node_key", "object_id", "user_document_id",
                    "record_json", "md5", "written"),
            "extracted",
        )
        markers = extracted.where("scope is null").select(*marked, *MARKER_COLUMNS)
        processed = processed_documents(markers, job.configs)
        records = snapshot_rows(
            extracted.where("scope is not null"), F.col(event_time) if event_time else snapshot_ts, "written"
        )
        # Deciding what changed moves keys and checksums only; record text is joined afterwards.
        slim = records.drop("record_json", "snapshot_ts", "user_document_id")
        times = slim.groupBy(*RECORD_KEY).agg(
            F.max_by(F.struct(*(c for c in slim.columns if c not in RECORD_KEY)), "written").alias("last"),
            F.count("*").alias("times"),
        )
        current = staging.write(times.select(*RECORD_KEY, "last.*", "times"), "current")
        previous = job.store.latest_of(processed, without_commit=commit)
        times = late = None
        if event_time:
            seen = processed_documents(markers, job.configs, event_time)
            times = seen.groupBy(*DOCUMENT_KEY).agg(F.max(event_time).cast("bigint").alias("snapshot_ts"))
            times = staging.write(times, "times")
            late = staging.write(late_documents(job, times, commit), "late")
            if late.isEmpty():
                late = None
            else:
                newer = previous.join(late, DOCUMENT_KEY, "left_anti")
                previous = newer.unionByName(job.store.before(late, without_commit=commit))
        changes = staging.write(without_moved(diff_snapshots(previous, current)), "changes")

        winners = records
        if not current.where("times > 1").isEmpty():
            # Repeated node keys are rare, so it is the losers that are looked up.
            last = current.where("times > 1").select(*RECORD_KEY, F.col("written").alias("last"))
            losers = slim.join(last, RECORD_KEY).where("written <> last").select("written")
            winners = records.join(small_side(losers), "written", "left_anti")
        winners = winners.drop("written")
        texts = winners.select(*RECORD_KEY, "record_json")
        sent = changes if late is None else changes.join(late, DOCUMENT_KEY, "left_anti")
        outcomes = publish_changes(job, sent, commit, texts)

        accepted = outcomes.where("state = 'current'").select(*DOCUMENT_KEY)
        if late is not None:
            accepted = accepted.unionByName(late.select(*DOCUMENT_KEY))
        _remember(job, winners, processed, changes, accepted, commit, snapshot_ts, times)
        _spare_from_removal(job, processed)
        skipped = skipped_documents(markers, job.configs)
        job.record(_indexing_events(job, processed, skipped, sent, outcomes))
    return outcomes


def _remember(job: Job, winners: DataFrame, processed: DataFrame, changes: DataFrame, accepted: DataFrame,
              commit: str, snapshot_ts: int, times: DataFrame | None) -> None:
    """Store the new snapshots of changed documents; an emptied document gets a marker row.

    `times` has the event time of each document, if they have their own.
    """
    changed = changes.select(*DOCUMENT_KEY).distinct().join(accepted, DOCUMENT_KEY, "left_semi")
    others = processed.select(*DOCUMENT_KEY).join(changed, DOCUMENT_KEY, "left_anti")
    held = winners.select(*DOCUMENT_KEY).distinct()
    emptied = changed.join(held, DOCUMENT_KEY, "left_anti")
    emptied = tombstones(emptied, snapshot_ts) if times is None else tombstones(emptied.join(times, DOCUMENT_KEY))
    rows = restrict(winners, changed, others, DOCUMENT_KEY).unionByName(emptied)
    job.store.append(rows, commit)


def _spare_from_removal(job: Job, processed: DataFrame) -> None:
    """Documents written while a removal of their collection is pending are not its business."""
    if not job.pending.any():
        return
    spared = in_trees(processed, job.pending.requests()).select("index_name", "tree", "doc_key")
    job.pending.write(job.pending.read().unionByName(spared))


def _indexing_events(job: Job, processed: DataFrame, skipped: DataFrame, changes: DataFrame,
                     outcomes: DataFrame) -> DataFrame:
    """Status of every collection the run touched, also by documents without changes."""
    collections = (
        changes.where("op <> 'delete'").select(*DOCUMENT_KEY, "collection")
        .unionByName(processed.select(*DOCUMENT_KEY, "collection"))
        .where("collection is not null")
        .distinct()
    )
    rows = collections.join(outcomes, DOCUMENT_KEY, "left").select(
        "index_name", "collection",
        F.coalesce("state", F.lit("current")).alias("state"),
        F.coalesce("object_count", F.lit(0)).alias("object_count"),
        "failure_class", "failure_message",
    )
    malformed = skipped.select(
        "index_name", "collection",
        F.lit(DEGRADED).alias("state"),
        F.lit(0).cast("bigint").alias("object_count"),
        F.lit("MalformedDocument").alias("failure_class"),
        F.concat_ws(": ", F.col("document_id").cast("string"), "error").alias("failure_message"),
    )
    return outcome_events(rows.unionByName(malformed), BATCH_WRITE, job.now_text(), job.now_millis())


def remove_documents(job: Job, documents: DataFrame, commit: str, snapshot_ts: int | None = None) -> DataFrame:
    """Delete the records of documents (`index_name, doc_key`) and forget their snapshots.

    Documents without stored records are left alone. With a column `snapshot_ts`, the time each was
    deleted, one that the store has newer than that is only marked in the history.
    """
    timed = "snapshot_ts" in documents.columns
    snapshot_ts = job.now_millis() if snapshot_ts is None else snapshot_ts
    gone, late = documents, None
    if timed:
        documents = materialize(documents, "deleted")
        late = late_documents(job, documents.select(*DOCUMENT_KEY, "snapshot_ts"), commit)
        gone = documents.join(late, DOCUMENT_KEY, "left_anti")
    changes = materialize(
        document_removals(job.store.latest_of(gone, without_commit=commit), gone), "removals"
    )
    outcomes = publish_changes(job, changes, commit)
    accepted = outcomes.where("state = 'current'").select(*DOCUMENT_KEY)
    if timed:
        marked = accepted.join(documents.select(*DOCUMENT_KEY, "snapshot_ts"), DOCUMENT_KEY).unionByName(late)
        job.store.append(tombstones(marked), commit)
    else:
        job.store.append(tombstones(accepted, snapshot_ts), commit)
    rows = outcomes.withColumn("collection", F.lit(None).cast("string"))
    job.record(outcome_events(rows, DOCUMENT_DELETE, job.now_text(), job.now_millis()))
    return outcomes


def reindex_collection(job: Job, documents: DataFrame, tree: str, commit: str,
                       snapshot_ts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Index every document of one collection tree; returns outcomes and blocking status rows."""
    scoped = documents.where(in_collection_tree("collection", tree))
    outcomes = index_documents(job, scoped, commit, snapshot_ts)
    return outcomes, status_gate(job.status.read())

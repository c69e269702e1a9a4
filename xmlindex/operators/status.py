"""Outcomes of operations folded into a status table, and the gate that reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from xmlindex.session import small_side

# Fixed values of the status contract.
CURRENT, DEGRADED, STALE = "current", "degraded", "stale_local_store"
BATCH_WRITE, DOCUMENT_DELETE, COLLECTION_DELETE = "batch_write", "document_delete", "collection_delete"
INDEX_DROP, MANUAL_REFRESH = "index_drop", "manual_refresh"
HEALTH_VERSION = 1

STATUS_KEY = ["index_name", "collection"]
STATUS_SCHEMA = (
    "index_name string, collection string, operation string, state string, ts string, "
    "last_success_ts string, object_count bigint, failure_class string, failure_message string"
)
_DETAILS = ["operation", "state", "ts", "object_count", "failure_class", "failure_message"]


def fold_status(events: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Newest event per (index, collection), with the time of the last success carried forward.

    `events` has the status columns but `last_success_ts`, and `seq`, their order. Rows without
    a collection describe the index as a whole.
    """
    succeeded = F.when(F.col("state") == CURRENT, F.col("ts"))
    rows = events.select(*STATUS_KEY, "seq", *_DETAILS, succeeded.alias("success"))
    if previous is not None:
        older = previous.select(
            *STATUS_KEY, F.lit(None).cast("bigint").alias("seq"), *_DETAILS,
            F.col("last_success_ts").alias("success"),
        )
        rows = rows.unionByName(older)
    # Earlier status comes before every event, whatever its number.
    order = F.struct(F.col("seq").isNotNull(), F.col("seq"))
    return (
        rows.groupBy(*STATUS_KEY)
        .agg(
            F.max_by(F.struct(*_DETAILS), order).alias("last"),
            F.max_by("success", F.when(F.col("success").isNotNull(), order)).alias("last_success_ts"),
        )
        .select(
            *STATUS_KEY, "last.operation", "last.state", "last.ts", "last_success_ts",
            "last.object_count", "last.failure_class", "last.failure_message",
        )
    )


def newest_events(events: DataFrame) -> DataFrame:
    """The events `fold_status` can still choose from: per (index, collection) those of the highest number,
    and of the highest of a success.

    For many events of few collections, which are read twice for it: numbers are compared by hashing, the
    rows of a fold by sorting.
    """
    succeeded = F.when((F.col("state") == CURRENT) & F.col("ts").isNotNull(), F.col("seq"))
    last = events.groupBy(*STATUS_KEY).agg(F.max("seq").alias("_last"), F.max(succeeded).alias("_success"))
    last = small_side(last.select(F.col("index_name").alias("_index"), F.col("collection").alias("_collection"), "_last", "_success"))
    same = F.col("index_name").eqNullSafe(F.col("_index")) & F.col("collection").eqNullSafe(F.col("_collection"))
    kept = F.col("seq").isNull() | (F.col("seq") == F.col("_last")) | (succeeded == F.col("_success"))
    return events.join(last, same & kept).select(*events.columns)


def collection_health(status: DataFrame) -> DataFrame:
    """Rows of a known collection."""
    return status.where("collection is not null and collection <> ''")


def status_for(status: DataFrame, keys: DataFrame, health: DataFrame | None = None) -> DataFrame:
    """Status of each (index, collection) asked for: its health row, else its record."""
    details = [c for c in status.columns if c not in STATUS_KEY]
    health = collection_health(status) if health is None else health

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*STATUS_KEY, F.struct(*details).alias(name))

    return (
        keys.join(side(health, "h"), STATUS_KEY, "left")
        .join(side(status, "r"), STATUS_KEY, "left")
        .withColumn("found", F.coalesce("h", "r"))
        .select(*STATUS_KEY, "found.*")
    )


def status_gate(status: DataFrame) -> DataFrame:
    """Rows that block a deployment; none means pass."""
    return status.where(F.col("state").isin(DEGRADED, STALE))


def refresh_status(report: DataFrame, status: DataFrame, ts: str) -> DataFrame:
    """Mark synchronised trees as current; refuses if any tree of the report is not."""
    refused = report.where(~F.col("classification").isin("synced", "stale_status"))
    blocking = refused.select("index_name", "tree", "classification").take(1)
    if blocking:
        index_name, tree, classification = blocking[0]
        raise ValueError(f"{index_name} {tree} is {classification}: not refreshing its status")
    rows = report.select(
        "index_name",
        F.col("tree").alias("collection"),
        F.lit(MANUAL_REFRESH).alias("operation"),
        F.lit(CURRENT).alias("state"),
        F.lit(ts).alias("ts"),
        F.lit(0).cast("bigint").alias("seq"),
        F.col("local_count").cast("bigint").alias("object_count"),
        F.lit(None).cast("string").alias("failure_class"),
        F.lit(None).cast("string").alias("failure_message"),
    )
    return fold_status(rows, status)


def outcome_events(outcomes: DataFrame, operation: str, ts: str, seq: int) -> DataFrame:
    """Status events of batch outcomes, one per (index, collection).

    `outcomes` has `index_name, collection, state, object_count, failure_class,
    failure_message`. A collection is degraded if any of its batches failed.
    """
    failed = F.col("state") == DEGRADED
    return (
        outcomes.groupBy(*STATUS_KEY)
        .agg(
            F.bool_or(failed).alias("failed"),
            F.sum("object_count").alias("n"),
            F.max(F.when(failed, F.struct("failure_class", "failure_message"))).alias("failure"),
        )
        .select(
            *STATUS_KEY,
            F.lit(operation).alias("operation"),
            F.when(F.col("failed"), DEGRADED).otherwise(CURRENT).alias("state"),
            F.lit(ts).alias("ts"),
            F.lit(seq).cast("bigint").alias("seq"),
            F.when(~F.col("failed"), F.col("n")).cast("bigint").alias("object_count"),
            "failure.failure_class",
            "failure.failure_message",
        )
    )


def stale_events(stale: DataFrame, ts: str, seq: int) -> DataFrame:
    """Status events of collection removals that found nothing stored."""
    nothing = F.lit(None).cast("string")
    return stale.select(
        "index_name",
        F.col("tree").alias("collection"),
        F.lit(COLLECTION_DELETE).alias("operation"),
        F.lit(STALE).alias("state"),
        F.lit(ts).alias("ts"),
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(None).cast("bigint").alias("object_count"),
        nothing.alias("failure_class"),
        nothing.alias("failure_message"),
    )

"""The status table on disk, and status documents of other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from xmlindex.operators.status import HEALTH_VERSION, STATUS_KEY, STATUS_SCHEMA, fold_status
from xmlindex.session import Staging
from xmlindex.sources import files
from xmlindex.sources.versions import VersionedFolder

_ENTRY = (
    "struct<`index`:string,collection:string,operation:string,state:string,timestamp:string,"
    "lastSuccessfulOperationTimestamp:string,objectCount:bigint,failureClass:string,failureMessage:string>"
)


class StatusStore:
    """Status rows in versions: written aside, then published."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._versions = VersionedFolder(spark, path)
        self._schema = T._parse_datatype_string(STATUS_SCHEMA)

    def read(self) -> DataFrame:
        version = self._versions.current()
        if version == 0:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(self._versions.folder(version))

    def write(self, status: DataFrame) -> None:
        """Make `status` the whole table; fails if another writer has been faster."""
        version = self._versions.current() + 1
        folder = self._versions.new_folder()
        status.select(*self._schema.names).write.mode("errorifexists").parquet(folder)
        self._versions.publish(version, folder)
        self._versions.drop_superseded()

    def fold(self, events: DataFrame) -> None:
        """Fold status events into the table. Of two writers the later one folds into what the other wrote."""
        while True:
            version = self._versions.current()
            folder = self._versions.new_folder()
            folded = fold_status(events, self.read())
            folded.select(*self._schema.names).write.mode("errorifexists").parquet(folder)
            if self._versions.claim(version + 1, folder):
                break
            files.delete(self.spark, folder)
        self._versions.drop_superseded()


def read_status_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, collection health) of a JSON status document; rows without an index are skipped."""
    schema = f"records array<{_ENTRY}>, collectionHealth array<{_ENTRY}>"
    document = spark.read.schema(schema).option("multiLine", True).json(path)

    def rows(member: str) -> DataFrame:
        found = document.select(F.explode(member).alias("r")).select("r.*")
        return found.select(
            F.col("index").alias("index_name"), "collection", "operation", "state",
            F.col("timestamp").alias("ts"),
            F.col("lastSuccessfulOperationTimestamp").alias("last_success_ts"),
            F.col("objectCount").alias("object_count"),
            F.col("failureClass").alias("failure_class"),
            F.col("failureMessage").alias("failure_message"),
        ).where("index_name <> ''")

    return rows("records"), rows("collectionHealth").where("collection <> ''")


def write_status_document(status: DataFrame, path: str) -> None:
    """The status table as the one JSON document that other tools read.

    The tasks write its lines in pieces; the pieces are copied into a draft one after the other,
    which then takes the place of the document at `path` at once, so a reader sees the old one or the
    new one. Of equal keys none are merged: fold them before.
    """
    spark = status.sparkSession
    lines = status_lines(status)
    with Staging() as staging:
        members = {"records": lines, "collectionHealth": lines.where("health")}
        pieces = {}
        for member, rows in members.items():
            order = [F.col("index_name"), F.coalesce("collection", F.lit(""))]
            pieces[member] = staging.path(spark, member)
            rows.orderBy(*order).select(F.concat(F.lit(","), "entry")).write.text(pieces[member])
        texts = [f'{{"contractVersion":{HEALTH_VERSION}']
        for member, folder in pieces.items():
            texts += [f',"{member}":[', folder, "]"]
        files.replace_with_pieces(spark, path, [*texts, "}"], set(pieces.values()))


def status_lines(status: DataFrame) -> DataFrame:
    """Status rows as JSON text in the members other tools expect, to be written one per line.

    `health` says whether the row belongs to the collection health list of the contract.
    """
    entry = F.to_json(F.struct(
        F.col("index_name").alias("index"), "collection", "operation", "state",
        F.col("ts").alias("timestamp"),
        F.col("last_success_ts").alias("lastSuccessfulOperationTimestamp"),
        F.col("object_count").alias("objectCount"),
        F.col("failure_class").alias("failureClass"),
        F.col("failure_message").alias("failureMessage"),
    ))
    return status.select(
        *STATUS_KEY,
        F.lit(HEALTH_VERSION).alias("contract_version"),
        (F.coalesce("collection", F.lit("")) != "").alias("health"),
        entry.alias("entry"),
    )

"""Send batches and report what became of each.

Batches of one commit touch every object once, so they may be sent side by side; `lanes=1`
sends one after the other per index. Outcomes are written before anything reads them, so a
batch is sent once per commit, or again only when its task or the commit is repeated, which
adding, updating and deleting by object id tolerates.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from xmlindex.operators.status import CURRENT, DEGRADED
from xmlindex.session import materialize
from xmlindex.sources import files

# Attempts, first delay in seconds (doubling), requests of a replay batch.
ATTEMPTS = 3
FIRST_DELAY = 1.0
REPLAY_BATCH_SIZE = 500

_OUTCOME = "state string, attempts int, ack string, failure_class string, failure_message string"

# Acknowledgements that a task holds before it writes them.
ACKS_PER_FILE = 64
_ACK = "index_name string, digest string, ack string, attempts int, run string"

# (index name, request body) -> acknowledgement
Transport = Callable[[str, str], str | None]


class TransportError(Exception):
    """A rejected request; `status` is the HTTP status if there was an answer."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status

    def __reduce__(self):
        return type(self), (self.args[0], self.status)


def retryable(error: BaseException) -> bool:
    """Too many requests, a server error, or no answer at all."""
    if isinstance(error, TransportError):
        return error.status is None or error.status == 429 or 500 <= error.status < 600
    return isinstance(error, (ConnectionError, TimeoutError))


def send(transport: Transport, index_name: str, body: str, attempts: int = ATTEMPTS,
         first_delay: float = FIRST_DELAY, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(state, attempts, ack, failure class, failure message) of one batch."""
    for attempt in range(1, attempts + 1):
        try:
            return CURRENT, attempt, transport(index_name, body), None, None
        except Exception as error:
            if attempt < attempts and retryable(error):
                sleep(first_delay * 2 ** (attempt - 1))
                continue
            return DEGRADED, attempt, None, type(error).__name__, str(error)
    raise ValueError("attempts must be positive")


def batch_digest(batches: DataFrame) -> Column:
    """What tells a batch of a commit from the others: its group, its number and its body."""
    group = [c for c in ("doc_key", "tree", "chunk") if c in batches.columns]
    return F.sha2(F.concat_ws("\x00", *(F.col(c).cast("string") for c in [*group, "body"])), 256)


class Publisher(Protocol):
    def publish(self, batches: DataFrame, commit: str) -> DataFrame:
        """Send `batches` (`index_name`, `body`, ...); returns them without body, with outcomes."""

    def drop_index(self, index_name: str) -> None:
        """Delete a whole index."""


class _AckWriter:
    """Keeps the acknowledgements of one task: a small file for every block of them, and the rest at the end."""

    def __init__(self, folder: str | None, run: str):
        self.folder, self.run, self.waiting = folder, run, []

    def add(self, index_name: str, digest: str, ack: str | None, attempts: int) -> None:
        if self.folder is not None:
            self.waiting.append({"index_name": index_name, "digest": digest, "ack": ack, "attempts": attempts, "run": self.run})
            if len(self.waiting) >= ACKS_PER_FILE:
                self.flush()

    def flush(self) -> None:
        if self.waiting:
            system, root = fs.FileSystem.from_uri(self.folder)
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{uuid.uuid4().hex}.json") as out:
                out.write("".join(json.dumps(line) + "\n" for line in self.waiting).encode())
            self.waiting = []


class CallPublisher:
    """Calls a transport for every batch, inside the tasks.

    With `acks`, a folder, every acknowledgement is kept there while batches are sent, so a commit
    that is repeated - by a task, a restarted micro-batch or a replay - sends only what was not
    acknowledged, in order, and reports the earlier acknowledgements with its own. What a dying
    task had not written yet, at most `ACKS_PER_FILE` of them, is sent again.
    """

    def __init__(self, transport: Transport, attempts: int = ATTEMPTS, first_delay: float = FIRST_DELAY,
                 lanes: int = 32, drop: Callable[[str], None] | None = None, acks: str | None = None):
        self.transport, self.attempts, self.first_delay = transport, attempts, first_delay
        self.lanes, self._drop, self.acks = max(1, lanes), drop, acks.rstrip("/") if acks else None

    def _ack_folder(self, commit: str) -> str | None:
        return None if self.acks is None else f"{self.acks}/commit={commit}"

    def acknowledged(self, spark: SparkSession, commit: str) -> DataFrame:
        """What was acknowledged of a commit, once for each batch: the first time counts."""
        folder = self._ack_folder(commit)
        if folder is None or not files.exists(spark, folder):
            return spark.createDataFrame([], _ACK)
        rows = spark.read.schema(_ACK).json(folder)
        first = F.min(F.struct("attempts", "run", "ack")).alias("first")
        return rows.groupBy("index_name", "digest").agg(first).select("index_name", "digest", "first.*")

    def forget(self, spark: SparkSession, commit: str) -> None:
        """Delete the acknowledgements of a commit that will not be repeated."""
        if self.acks is not None:
            files.delete(spark, self._ack_folder(commit))

    def publish(self, batches: DataFrame, commit: str) -> DataFrame:
        if self.acks is None:
            return self._send(batches, None)
        spark = batches.sparkSession
        kept = [c for c in batches.columns if c != "body"]
        digested = batches.withColumn("digest", batch_digest(batches))
        if not files.exists(spark, self._ack_folder(commit)):
            return self._send(digested, self._ack_folder(commit)).drop("digest")
        known = materialize(self.acknowledged(spark, commit), "acknowledged")
        key = ["index_name", "digest"]
        earlier = digested.drop("body").join(known, key).select(
            *kept, "digest", F.lit(CURRENT).alias("state"), "attempts", "ack",
            F.lit(None).cast("string").alias("failure_class"), F.lit(None).cast("string").alias("failure_message"),
        )
        earlier = materialize(earlier, "earlier")
        sent = self._send(digested.join(known.select(*key), key, "left_anti"), self._ack_folder(commit))
        return earlier.unionByName(sent).drop("digest")

    def _send(self, batches: DataFrame, folder: str | None) -> DataFrame:
        transport, attempts, first_delay = self.transport, self.attempts, self.first_delay
        kept = [f for f in batches.schema.fields if f.name not in ("body", "lane")]
        number = uuid.uuid4().hex

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acks = _AckWriter(folder, number)
            try:
                yield from sent(rows, acks)
            finally:
                acks.flush()

        def sent(rows: Iterator[pa.RecordBatch], acks: _AckWriter) -> Iterator[pa.RecordBatch]:
            for batch in rows:
                names, bodies = batch.column("index_name"), batch.column("body")
                outcomes = []
                for n in range(batch.num_rows):
                    outcome = send(transport, names[n].as_py(), bodies[n].as_py(), attempts, first_delay)
                    outcomes.append(outcome)
                    if outcome[0] == CURRENT and folder is not None:
                        acks.add(names[n].as_py(), batch.column("digest")[n].as_py(), outcome[2], outcome[1])
                types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
                columns = list(zip(*outcomes)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name) for f in kept),
                     *(pa.array(c, t) for c, t in zip(columns, types))],
                    names=[*(f.name for f in kept), "state", "attempts", "ack", "failure_class",
                           "failure_message"],
                )

        order = [c for c in ("doc_key", "tree", "chunk") if c in batches.columns]
        spread = F.lit(0) if self.lanes == 1 else F.pmod(F.xxhash64(*order), F.lit(self.lanes))
        outcomes = (
            batches.withColumn("lane", spread)
            .repartition(self.lanes, "index_name", "lane")
            .sortWithinPartitions("index_name", *order)
            .mapInArrow(run, T.StructType([*kept, *T._parse_datatype_string(_OUTCOME).fields]))
        )
        return materialize(outcomes, "outcomes")

    def drop_index(self, index_name: str) -> None:
        if self._drop is not None:
            self._drop(index_name)


class FilePublisher:
    """Writes request bodies as lines of compressed text, one folder per commit and index; repeating a commit replaces it."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def publish(self, batches: DataFrame, commit: str) -> DataFrame:
        folder = f"{self.path}/commit={commit}"
        batches.select("index_name", "body").write.mode("overwrite").partitionBy("index_name").text(folder, compression="gzip")
        nothing = F.lit(None).cast("string")
        return batches.drop("body").select(
            "*",
            F.lit(CURRENT).alias("state"),
            F.lit(1).alias("attempts"),
            F.lit(folder).alias("ack"),
            nothing.alias("failure_class"),
            nothing.alias("failure_message"),
        )

    def drop_index(self, index_name: str) -> None:
        """Nothing to delete: the files are a log."""

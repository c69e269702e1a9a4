"""The snapshot store: every record a document ever gave, and what is stored now.

Every commit adds a run, a folder of rows that is never changed, and a manifest that names what is
live (see `commits`). From the runs three tables are read:

* the history: all snapshots, by time;
* the current table: the newest snapshot of every document. A run says which of its rows were newest
  when it was written, and brings along the keys of the documents it replaces, a deletion vector
  for the runs before it. Once more rows were added than the last compaction left (or the first run
  had), the current rows are written anew, so reading them never costs more than twice their number;
* the listing: the current records without their text, in files sorted by the place of their
  collection in the tree, so that a collection tree is one range of places, and the files of other
  trees are left out by their minima and maxima.

Rows are dealt into buckets by an extendible hash directory of their documents, so looking up the
documents of one batch reads their buckets alone. Dropping an index unlinks its partitions and
quarantining documents adds their keys; neither rewrites what stays.
"""

from __future__ import annotations

from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from xmlindex.functions.paths import place, tree_places
from xmlindex.operators.snapshots import DOCUMENT_KEY, RECORD_KEY, at_timestamps, latest_timestamps
from xmlindex.session import CODEC, Staging
from xmlindex.sources import files
from xmlindex.sources.archives import read_archives
from xmlindex.sources.commits import GRACE, CommitLog, Run, State
from xmlindex.sources.directory import DEEPEST, Directory, slot_of

SNAPSHOT_COLUMNS = (
    "index_name string, doc_key string, snapshot_ts bigint, node_key string, object_id string, "
    "collection string, document_id string, user_document_id string, record_json string, md5 string"
)
_COLUMNS = [part.split()[0] for part in SNAPSHOT_COLUMNS.split(", ")]
_LISTED = [c for c in _COLUMNS if c != "record_json"]
_SCHEMAS = {
    "data": f"{SNAPSHOT_COLUMNS}, newest boolean, run string, bucket int",
    "replaced": "index_name string, doc_key string, run string, bucket int",
    "gone": "index_name string, doc_key string, run string",
    "trees": ", ".join(p for p in SNAPSHOT_COLUMNS.split(", ") if not p.startswith("record_json"))
             + ", place string, alive boolean, run string",
}
# Rows a bucket may have before it is split.
CAPACITY = 200_000


def snapshot_rows(records: DataFrame, snapshot_ts: int | Column, *carried: str) -> DataFrame:
    """Records as snapshot rows, with further columns; a node key written twice keeps its last record."""
    ts = F.lit(snapshot_ts) if isinstance(snapshot_ts, int) else snapshot_ts
    return records.select(
        "index_name", "doc_key", ts.cast("bigint").alias("snapshot_ts"), "node_key", "object_id",
        "collection", F.col("document_id").cast("string").alias("document_id"), "user_document_id",
        "record_json", "md5", *carried,
    )


class SnapshotStore:
    def __init__(self, spark: SparkSession, path: str, capacity: int = CAPACITY):
        self.spark = spark
        self.path = path.rstrip("/")
        self.capacity = capacity
        self._root = f"{self.path}/snapshots"
        self.log = CommitLog(spark, self._root)

    # --- Reading ------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """All snapshots, with the `commit` that wrote them."""
        return self._history(self.log.state()).drop("seq", "run", "bucket", "newest")

    def latest(self, before: Column | None = None) -> DataFrame:
        """Records of the newest snapshot of every document, or of the newest before a time."""
        if before is None:
            return self._records(self._current(self.log.state()))
        snapshots = self.read()
        return self._records(at_timestamps(snapshots, latest_timestamps(snapshots, before)))

    def latest_of(self, documents: DataFrame, without_commit: str | None = None) -> DataFrame:
        """The newest records of the given (index, document key) pairs; only their buckets are read.

        A batch that is repeated leaves its own earlier commit out of account; what was newest
        before it is found in the history.
        """
        state = self.log.state()
        wanted = documents.select(*DOCUMENT_KEY).distinct()
        if without_commit is not None and _knows(state, without_commit):
            others = self._history(_without(state, without_commit)).join(wanted, DOCUMENT_KEY, "left_semi")
            return self._records(at_timestamps(others, latest_timestamps(others)))
        held = self._current(state, self._touched(state, wanted))
        return self._records(held.join(wanted, DOCUMENT_KEY, "left_semi"))

    def times_of(self, documents: DataFrame, without_commit: str | None = None) -> DataFrame:
        """`held_ts`, the time of the newest snapshot, of those documents that have one."""
        state = self.log.state()
        wanted = documents.select(*DOCUMENT_KEY).distinct()
        if without_commit is not None and _knows(state, without_commit):
            held = self._history(_without(state, without_commit))
        else:
            held = self._current(state, self._touched(state, wanted))
        held = held.join(wanted, DOCUMENT_KEY, "left_semi")
        return latest_timestamps(held).withColumnRenamed("snapshot_ts", "held_ts")

    def before(self, documents: DataFrame, without_commit: str | None = None) -> DataFrame:
        """The records of each document just before a time of its own, `snapshot_ts`."""
        state = self.log.state()
        if without_commit is not None:
            state = _without(state, without_commit)
        until = documents.select(*DOCUMENT_KEY, F.col("snapshot_ts").alias("until"))
        older = self._history(state).join(until, DOCUMENT_KEY).where("snapshot_ts < until").drop("until")
        return self._records(at_timestamps(older, latest_timestamps(older)))

    def listing(self, tree: str | None = None) -> DataFrame:
        """The current records without their text: all, or those of one collection tree."""
        if tree is None:
            return self._listing(self.log.state(), None)
        low, high = tree_places(F.lit(tree))
        return self._listing(self.log.state(), (F.col("place") >= low) & (F.col("place") < high))

    def listing_of(self, trees: DataFrame, without_commit: str | None = None) -> DataFrame:
        """The current records between the first and the last place of the given trees, without text.

        A step that is repeated leaves its own earlier commit out of account, as in `latest_of`.
        """
        state = self.log.state()
        low, high = tree_places(F.col("tree"))
        ends = trees.agg(F.min(low).alias("low"), F.max(high).alias("high")).first()
        inside = F.lit(False)
        if ends["low"] is not None:
            inside = (F.col("place") >= ends["low"]) & (F.col("place") < ends["high"])
        if without_commit is not None and _knows(state, without_commit):
            others = self._history(_without(state, without_commit))
            held = self._records(at_timestamps(others, latest_timestamps(others)))
            return held.withColumn("place", place("collection")).where(inside).select(*_LISTED)
        return self._listing(state, inside)

    def _records(self, rows: DataFrame) -> DataFrame:
        return rows.where("node_key is not null").select(*_COLUMNS)

    def _read(self, kind: str, runs: tuple[Run, ...] | list[Run], keep: Column | None = None) -> DataFrame:
        """The rows of some runs, each with its `seq` and `commit`."""
        schema = T._parse_datatype_string(_SCHEMAS[kind])
        paths = [f"{self._root}/{kind}/run={run.id}" for run in runs]
        if not paths:
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).option("basePath", f"{self._root}/{kind}").parquet(*paths)
        if keep is not None:
            rows = rows.where(keep)
        numbered = pa.table({"run": pa.array([r.id for r in runs], pa.string()), "seq": pa.array([r.seq for r in runs], pa.int64()),
                             "commit": pa.array([r.commit for r in runs], pa.string())})
        # One row a live run, whose number vacuum bounds.
        return rows.join(F.broadcast(self.spark.createDataFrame(numbered)), "run")

    def _undropped(self, state: State, runs: tuple[Run, ...] | list[Run]) -> Column | None:
        """Leaves out whole partitions: those of an index in runs from before it was dropped."""
        keep = None
        for index_name, seq in state.dropped.items():
            before = [run.id for run in runs if run.seq < seq]
            if before:
                one = ~((F.col("index_name") == index_name) & F.col("run").isin(before))
                keep = one if keep is None else keep & one
        return keep

    def _without_deleted(self, rows: DataFrame, runs: list[Run], kind: str, deletions: tuple[Run, ...],
                         keep: Column | None = None) -> DataFrame:
        """Rows whose document is in no deletion vector of a later commit."""
        later = [d for d in deletions if any(run.seq < d.seq for run in runs)]
        if not later:
            return rows
        deleted = self._read(kind, later, keep).groupBy(*DOCUMENT_KEY).agg(F.max("seq").alias("deleted_at"))
        same = [F.col(f"r.{c}") == F.col(f"d.{c}") for c in DOCUMENT_KEY]
        return rows.alias("r").join(deleted.alias("d"), [*same, F.col("d.deleted_at") > F.col("r.seq")], "left_anti")

    def _history(self, state: State) -> DataFrame:
        runs = [run for run in state.runs if run.history]
        rows = self._read("data", runs, self._undropped(state, runs))
        return self._without_deleted(rows, runs, "gone", state.gone)

    def _current(self, state: State, touched: Column | None = None) -> DataFrame:
        runs = [run for run in state.runs if run.current]
        keep = F.col("newest")
        for one in (touched, self._undropped(state, runs)):
            keep = keep if one is None else keep & one
        return self._without_deleted(self._read("data", runs, keep), runs, "replaced", state.replaced, touched)

    def _listing(self, state: State, keep: Column | None) -> DataFrame:
        undropped = self._undropped(state, state.trees)
        if undropped is not None:
            keep = undropped if keep is None else keep & undropped
        rows = self._read("trees", state.trees, keep)
        if len(state.trees) > 1 or any(not run.current for run in state.trees):
            # A record is listed if the last word about it at its place says so.
            rest = [c for c in _LISTED if c not in RECORD_KEY]
            last = F.max_by(F.struct("alive", *rest), F.struct("seq", "alive"))
            rows = rows.groupBy(*RECORD_KEY, "place").agg(last.alias("_last")).where("_last.alive").select(*RECORD_KEY, "_last.*")
        return rows.select(*_LISTED)

    def _directory(self, name: str) -> Directory:
        return Directory.from_text(files.read_text(self.spark, f"{self._root}/directories/{name}")) if name else Directory()

    def _touched(self, state: State, documents: DataFrame) -> Column | None:
        """A partition filter for the buckets of some documents; at most a directory of numbers is collected."""
        keep = F.lit(False)
        runs = [run for run in (*state.runs, *state.replaced) if run.current or not run.history]
        for name in sorted({run.directory for run in runs}):
            directory = self._directory(name)
            own = F.col("run").isin([run.id for run in runs if run.directory == name])
            if len(set(directory.slots)) > 1:
                held = documents.select(directory.bucket(*DOCUMENT_KEY).alias("bucket")).distinct().collect()
                own = own & F.col("bucket").isin(sorted(row["bucket"] for row in held))
            keep = keep | own
        return keep

    # --- Writing ------------------------------------------------------------------------------

    def _write_rows(self, rows: DataFrame, directory: Directory, run: str) -> int:
        """Partition files of even size: a hot index or bucket is split, small ones are merged."""
        (
            rows.select(*_COLUMNS, "newest", directory.bucket(*DOCUMENT_KEY).alias("bucket"))
            .hint("rebalance", "index_name", "bucket")
            .sortWithinPartitions("index_name", "bucket", "doc_key", "node_key")
            .write.mode("overwrite").partitionBy("index_name", "bucket").parquet(f"{self._root}/data/run={run}", compression=CODEC)
        )
        return self._read("data", [Run(run, 0)]).count()

    def _write_keys(self, documents: DataFrame, directory: Directory, run: str) -> None:
        keys = documents.select(*DOCUMENT_KEY, directory.bucket(*DOCUMENT_KEY).alias("bucket"))
        keys.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self._root}/replaced/run={run}", compression=CODEC)

    def _write_listing(self, listed: DataFrame, unlisted: DataFrame | None, run: str) -> None:
        def rows(df: DataFrame, alive: bool) -> DataFrame:
            return df.where("node_key is not null").select(*_LISTED, place("collection").alias("place"), F.lit(alive).alias("alive"))

        both = rows(listed, True) if unlisted is None else rows(listed, True).unionByName(rows(unlisted, False))
        order = ["index_name", "place", "doc_key", "node_key"]
        (
            both.repartitionByRange(*order).sortWithinPartitions(*order)
            .write.mode("overwrite").parquet(f"{self._root}/trees/run={run}", compression=CODEC)
        )

    def _split(self, state: State, documents: DataFrame, rows: int) -> tuple[str, Directory]:
        """The directory for `rows` more rows of `documents` (with `n_rows`): buckets too full are split."""
        directory = self._directory(state.directory)
        if rows <= self.capacity:
            return state.directory, directory
        depth = min(DEEPEST, max(directory.depth, (rows // self.capacity).bit_length() + 2))
        counts = documents.groupBy(slot_of(depth, *DOCUMENT_KEY).alias("slot")).agg(
            F.sum("n_rows").alias("rows"), F.count("*").alias("documents")
        )
        found = {row["slot"]: (row["rows"], row["documents"]) for row in counts.collect()}
        divided = directory.split(found, depth, self.capacity)
        if divided == directory:
            return state.directory, directory
        name = CommitLog.new_id()
        files.write_text(self.spark, f"{self._root}/directories/{name}", divided.to_text())
        return name, divided

    def append(self, rows: DataFrame, commit: str) -> None:
        """Add snapshot rows; repeating a commit replaces what it added and nothing else.

        A snapshot older than the newest one of its document takes its place in the history and
        leaves the current table as it is. `rows` is read several times, so it should be staged.
        """
        run, keys, listed, brought = (CommitLog.new_id() for _ in range(4))

        def change(state: State, number: int) -> State:
            with Staging() as staging:
                repeated = [r for r in state.runs if r.history and r.commit == commit]
                incoming = rows.groupBy(*DOCUMENT_KEY).agg(
                    F.max("snapshot_ts").alias("snapshot_ts"), F.count("*").alias("n_rows"), F.min("snapshot_ts").alias("first_ts")
                )
                if repeated:
                    before = self._read("data", repeated).select(*DOCUMENT_KEY).distinct()
                    incoming = incoming.join(before, DOCUMENT_KEY, "full_outer").na.fill(0, ["n_rows"])
                incoming = staging.write(incoming, "incoming")
                shown = staging.write(
                    self._current(state, self._touched(state, incoming)).select(*_LISTED)
                    .join(incoming.select(*DOCUMENT_KEY), DOCUMENT_KEY, "left_semi"), "shown",
                ) if any(r.current for r in state.runs) else self._read("data", []).select(*_LISTED)
                others = shown
                if repeated:
                    others = self._history(_without(state, commit)).join(incoming.select(*DOCUMENT_KEY), DOCUMENT_KEY, "left_semi")
                if any(r.current for r in state.runs) or repeated:
                    held = latest_timestamps(others).withColumnRenamed("snapshot_ts", "held_ts")
                    incoming = staging.write(incoming.join(held, DOCUMENT_KEY, "left"), "decided")
                else:
                    incoming = incoming.withColumn("held_ts", F.lit(None).cast("bigint"))
                decided = incoming.withColumn(
                    "newest", F.col("snapshot_ts").isNotNull()
                    & (F.col("held_ts").isNull() | (F.col("snapshot_ts") >= F.col("held_ts")))
                )
                counts = decided.agg(
                    F.sum("n_rows").alias("rows"), F.count_if(~F.col("newest")).alias("late"),
                    F.count_if(F.col("first_ts") < F.col("snapshot_ts")).alias("several"),
                    F.count_if(F.col("held_ts").isNotNull()).alias("held"),
                ).first()
                if not counts["rows"] and not repeated:
                    return state
                directory_name, directory = self._split(state, decided, counts["rows"] or 0)

                flagged = rows.withColumn("newest", F.lit(True))
                if counts["late"] or counts["several"]:
                    shows = decided.where("newest").select(*DOCUMENT_KEY, "snapshot_ts", F.lit(True).alias("newest"))
                    flagged = rows.join(shows, [*DOCUMENT_KEY, "snapshot_ts"], "left").withColumn(
                        "newest", F.coalesce("newest", F.lit(False))
                    )
                written = self._write_rows(flagged, directory, run)
                runs = [r for r in state.runs if r not in repeated]
                runs.append(Run(run, number, commit, directory_name, written, history=True, current=True))
                replaced, unlisted = list(state.replaced), None
                added = self._read("data", [runs[-1]], F.col("newest"))
                if counts["held"] or repeated:
                    hidden = decided if repeated else decided.where("newest and held_ts is not null")
                    self._write_keys(hidden, directory, keys)
                    replaced.append(Run(keys, number, commit, directory_name))
                    unlisted = shown.join(hidden.select(*DOCUMENT_KEY), DOCUMENT_KEY, "left_semi")
                if repeated:
                    # What the earlier attempt had replaced and this one does not shows again.
                    lost = decided.where("not newest and held_ts is not null").select(*DOCUMENT_KEY, F.col("held_ts").alias("snapshot_ts"))
                    again = others.join(lost, [*DOCUMENT_KEY, "snapshot_ts"], "left_semi").withColumn("newest", F.lit(True))
                    n_again = self._write_rows(again, directory, brought)
                    runs.append(Run(brought, number, "", directory_name, n_again, current=True))
                    added = self._read("data", runs[-2:], F.col("newest"))
                self._write_listing(added, unlisted, listed)
                return replace(
                    state, runs=tuple(runs), replaced=tuple(replaced), directory=directory_name,
                    trees=(*state.trees, Run(listed, number, commit)),
                )

        state = self.log.commit(commit, change)
        added = [r.rows for r in state.runs if r.current and r.history]
        base = [r.rows for r in state.runs if r.current and not r.history]
        if not base:
            # Nothing came before the first run, so it needs no compaction to be a base.
            base, added = added[:1], added[1:]
        if sum(added) > max(self.capacity, sum(base)):
            self.compact()
        self.log.free()

    def _compacted(self, state: State) -> tuple[State, State]:
        """(what was read, what replaces it): the current rows and their listing in one run each."""
        base, listed = CommitLog.new_id(), CommitLog.new_id()
        rows = self._current(state)
        documents = rows.groupBy(*DOCUMENT_KEY).agg(F.count("*").alias("n_rows"))
        total = sum(run.rows for run in state.runs if run.current)
        directory_name, directory = self._split(state, documents, total)
        written = self._write_rows(rows, directory, base)
        run = Run(base, state.seq, "", directory_name, written, current=True)
        self._write_listing(self._read("data", [run]), None, listed)
        kept = tuple(replace(r, current=False) for r in state.runs if r.history)
        return state, replace(
            state, runs=(*kept, run), replaced=(), directory=directory_name, trees=(Run(listed, state.seq, current=True),)
        )

    def compact(self) -> None:
        """Write the current table and its listing anew, without what was replaced."""
        self._rewrite("compact", self._compacted)

    def _rewrite(self, note: str, build) -> State:
        """Commit what `build` makes of a state; what others only added meanwhile stays beside it."""
        made: list[tuple[State, State]] = []

        def change(state: State, _number: int) -> State:
            if made:
                read, result = made[-1]
                kinds = ("runs", "replaced", "gone", "trees")
                if state.dropped == read.dropped and all(set(getattr(read, k)) <= set(getattr(state, k)) for k in kinds):
                    added = {k: tuple(r for r in getattr(state, k) if r not in getattr(read, k)) for k in kinds}
                    return replace(result, freed=state.freed, **{k: (*getattr(result, k), *added[k]) for k in kinds})
            made.append(build(state))
            return made[-1][1]

        return self.log.commit(note, change)

    def vacuum(self, keep: int = 2, grace: float = GRACE) -> None:
        """Keep the newest snapshots of every document and drop older ones, and compact.

        What the store held before is deleted once it was replaced `grace` seconds ago. A commit
        must not be repeated after its rows were merged.
        """
        def build(state: State) -> tuple[State, State]:
            _read, after = self._compacted(state)
            snapshots = self._history(state)
            newest = Window.partitionBy(*DOCUMENT_KEY).orderBy(F.desc("snapshot_ts"))
            kept = (
                snapshots.select(*DOCUMENT_KEY, "snapshot_ts").distinct()
                .withColumn("rn", F.row_number().over(newest))
                .where(F.col("rn") <= keep)
                .drop("rn")
            )
            run = CommitLog.new_id()
            rows = snapshots.join(kept, [*DOCUMENT_KEY, "snapshot_ts"], "left_semi").withColumn("newest", F.lit(False))
            written = self._write_rows(rows, self._directory(after.directory), run)
            merged = Run(run, state.seq, "vacuum", after.directory, written, history=True)
            base = tuple(r for r in after.runs if r.current)
            return state, replace(after, runs=(merged, *base), gone=(), dropped={})

        self._rewrite("vacuum", build)
        self.log.free(grace)
        self.log.forget(grace)
        used = self.log.state()
        for name in files.list_names(self.spark, f"{self._root}/directories"):
            path = f"{self._root}/directories/{name}"
            if name not in used.directories() and files.age(self.spark, path) >= max(grace, 1.0):
                files.delete(self.spark, path)

    def drop_index(self, index_name: str) -> None:
        """Forget everything about an index: its partitions are unlinked, nothing is rewritten."""
        self.log.commit("drop_index", lambda state, number: replace(state, dropped={**state.dropped, index_name: number}))

    def quarantine(self, documents: DataFrame, name: str) -> DataFrame:
        """Move all snapshots of the given documents aside; one row per (index, document) asked for.

        The moved rows are kept below `quarantine/<name>`; a name that exists is refused. The store
        itself only learns the keys of the moved documents.
        """
        target = f"{self.path}/quarantine/{name}"
        if files.exists(self.spark, target):
            raise FileExistsError(f"quarantine target already exists: {target}")
        asked = f"{self.path}/quarantine-asked/{name}"
        documents.select(*DOCUMENT_KEY).distinct().write.mode("overwrite").parquet(asked)
        wanted = self.spark.read.schema("index_name string, doc_key string").parquet(asked)
        gone, keys, listed = (CommitLog.new_id() for _ in range(3))

        def change(state: State, number: int) -> State:
            moved = self._history(state).join(wanted, DOCUMENT_KEY, "left_semi")
            moved.select(*_COLUMNS, "commit").write.mode("overwrite").partitionBy("commit").parquet(target, compression=CODEC)
            found = self.spark.read.schema("index_name string, doc_key string").parquet(target).distinct()
            found.write.mode("overwrite").parquet(f"{self._root}/gone/run={gone}")
            found = self.spark.read.schema("index_name string, doc_key string").parquet(f"{self._root}/gone/run={gone}")
            directory = self._directory(state.directory)
            self._write_keys(found, directory, keys)
            shown = self._current(state, self._touched(state, found)).join(found, DOCUMENT_KEY, "left_semi")
            self._write_listing(shown.limit(0), shown, listed)
            return replace(
                state, gone=(*state.gone, Run(gone, number)),
                replaced=(*state.replaced, Run(keys, number, "", state.directory)), trees=(*state.trees, Run(listed, number)),
            )

        self.log.commit("quarantine", change)
        held = self.spark.read.schema("index_name string, doc_key string").parquet(f"{self._root}/gone/run={gone}")
        return wanted.join(held.withColumn("moved", F.lit(True)), DOCUMENT_KEY, "left").select(
            *DOCUMENT_KEY,
            F.coalesce("moved", F.lit(False)).alias("moved"),
            F.when(F.col("moved").isNull(), "missing-source").alias("reason"),
        )


def _knows(state: State, commit: str) -> bool:
    return any(run.history and run.commit == commit for run in state.runs)


def _without(state: State, commit: str) -> State:
    """The state without the runs of a commit in its history."""
    return replace(state, runs=tuple(r for r in state.runs if not (r.history and r.commit == commit)))


def import_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot rows from a tree of JSON files `<index>/<document>/<timestamp>/<node>.json`.

    The files may also be members of tar archives (see `archives`) that lie where the tree would.
    Hidden files and folders, other extensions and folders that are not numbers are skipped.
    """
    from xmlindex.functions.records import collection_of, object_id_of, record_text

    places = ((-4, "index_name"), (-3, "doc_key"), (-2, "stamp"), (-1, "file"))

    def named(rows: DataFrame, parts: Column) -> DataFrame:
        return rows.select("record_json", parts.alias("parts")).where("size(parts) >= 4").select(
            "record_json", *[F.element_at("parts", n).alias(name) for n, name in places]
        )

    texts = (
        spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
        .option("wholetext", True).text(path)
        .withColumnRenamed("value", "record_json")
    )
    files = named(texts, F.split("_metadata.file_path", "/")).withColumns({
        "doc_key": F.url_decode("doc_key"), "file": F.url_decode("file"),
    })
    # Spark leaves hidden files and folders out of a tree by itself, not out of an archive.
    hidden = r"(^|/)([.]|_[^=/]*(/|$))"
    members = read_archives(spark, path).where(F.col("name").endswith(".json") & ~F.col("name").rlike(hidden))
    packed = named(
        members.withColumn("record_json", F.col("content").cast("string")), F.split(F.concat_ws("/", "folder", "name"), "/")
    )
    return (
        files.unionByName(packed)
        .where(r"stamp rlike '^\\d+$' and not startswith(file, '.') and not startswith(doc_key, '.')")
        .select(
            "index_name", "doc_key",
            F.col("stamp").cast("bigint").alias("snapshot_ts"),
            F.regexp_replace("file", r"\.json$", "").alias("node_key"),
            object_id_of("record_json").alias("object_id"),
            collection_of("record_json").alias("collection"),
            F.get_json_object("record_json", "$.documentID").alias("document_id"),
            record_text("record_json", "documentID").alias("user_document_id"),
            "record_json",
            F.md5("record_json").alias("md5"),
        )
    )

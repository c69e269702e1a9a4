"""Indexing, removing, repairing and streaming against an index held in files."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from xmlindex.config import load_config
from xmlindex.operators.publish import CallPublisher, FilePublisher, TransportError
from xmlindex.plans.indexing import index_documents, reindex_collection, remove_documents
from xmlindex.plans.job import Job
from xmlindex.plans.removing import drop_index, flush_removals, remove_collections, request_removals
from xmlindex.plans.repairing import reconcile, refresh, replay, replay_batches, report_for
from xmlindex.sources.live import read_live_index
from xmlindex.streaming.incremental import apply_events, start_incremental

# The transport below runs in the Python workers, which cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONFIG = load_config({
    "collection": "/db/dict",
    "indexes": [{"name": "words", "documentId": "/book/@id", "batchSize": 2, "roots": [
        {"path": "/book/entry", "nodeId": "@id", "fields": [
            {"name": "lemma", "path": "/form"}, {"name": "n", "path": "@n", "type": "integer"}]}]}],
})
DOCUMENTS = "collection string, collection_id int, document_id int, xml string"


def book(name, *entries):
    body = "".join(f'<entry id="{i}" n="{n}"><form>{form}</form></entry>' for i, n, form in entries)
    return f'<book id="{name}">{body}</book>'


class DirectoryIndex:
    """A live index as one file per object; deletes and writes arrive as request bodies."""

    def __init__(self, path, failing=""):
        self.path, self.failing = str(path), failing

    def __call__(self, index_name, body):
        if self.failing and self.failing in body:
            raise TransportError("rejected", 400)
        for request in json.loads(body)["requests"]:
            target = os.path.join(self.path, request["body"]["objectID"].replace("/", "_") + ".json")
            if request["action"] == "deleteObject":
                if os.path.exists(target):
                    os.remove(target)
            else:
                with open(target, "w") as out:
                    json.dump(request["body"], out)
        return "ok"

    def ids(self):
        return sorted(json.load(open(os.path.join(self.path, n)))["objectID"] for n in os.listdir(self.path))


@pytest.fixture
def index(tmp_path):
    (tmp_path / "live").mkdir()
    return DirectoryIndex(tmp_path / "live")


@pytest.fixture
def job(spark, tmp_path, index):
    return Job.at(spark, str(tmp_path / "store"), [CONFIG], CallPublisher(index, first_delay=0.0, lanes=2), capacity=3)


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENTS)


ONE = ("/db/dict/a", 5, 1, book("one", ("x1", 1, "hello"), ("x2", 2, "world"), ("x3", 3, "again")))
TWO = ("/db/dict/b", 6, 2, book("two", ("y1", 1, "ja")))


def operations(outcomes):
    return {r.doc_key: (r.state, r.object_count) for r in outcomes.collect()}


def live_reader(spark, index):
    return lambda: read_live_index(spark, index.path, "words")


def test_unchanged_documents_send_nothing(spark, job, index):
    first = index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    assert operations(first) == {"one": ("current", 3), "two": ("current", 1)}
    assert index.ids() == ["x1", "x2", "x3", "y1"]
    second = index_documents(job, documents(spark, ONE, TWO), "c2", 200)
    assert operations(second) == {}
    state = {r.collection: (r.state, r.object_count) for r in job.status.read().collect()}
    assert state == {"/db/dict/a": ("current", 0), "/db/dict/b": ("current", 0)}


def test_update_add_delete_and_empty(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    changed = ("/db/dict/a", 5, 1, book("one", ("x1", 1, "hello"), ("x2", 9, "world"), ("x4", 4, "new")))
    emptied = ("/db/dict/b", 6, 2, book("two"))
    out = index_documents(job, documents(spark, changed, emptied), "c2", 200)
    assert operations(out) == {"one": ("current", 3), "two": ("current", 1)}
    assert index.ids() == ["x1", "x2", "x4"]
    assert {r.object_id for r in job.store.latest().collect()} == {"x1", "x2", "x4"}
    # The emptied document stays empty: nothing is deleted twice.
    assert operations(index_documents(job, documents(spark, emptied), "c3", 300)) == {}


def test_repeating_a_commit_changes_nothing(spark, job, index):
    index_documents(job, documents(spark, ONE), "c1", 100)
    again = index_documents(job, documents(spark, ONE), "c1", 100)
    assert operations(again) == {"one": ("current", 3)}
    assert job.store.read().count() == 3 and index.ids() == ["x1", "x2", "x3"]


def test_failed_batch_is_found_again(spark, job, index):
    job.publisher.transport.failing = "world"
    out = index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    assert operations(out)["one"][0] == "degraded" and operations(out)["two"][0] == "current"
    states = {r.collection: (r.state, r.failure_class) for r in job.status.read().collect()}
    assert states["/db/dict/a"] == ("degraded", "TransportError")
    job.publisher.transport.failing = ""
    out, blocking = reindex_collection(job, documents(spark, ONE, TWO), "/db/dict/a", "c2", 200)
    assert operations(out) == {"one": ("current", 3)}
    assert blocking.count() == 0 and index.ids() == ["x1", "x2", "x3", "y1"]


def test_record_moved_to_another_document_stays(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    one = ("/db/dict/a", 5, 1, book("one", ("x1", 1, "hello"), ("x2", 2, "world")))
    two = ("/db/dict/b", 6, 2, book("two", ("y1", 1, "ja"), ("x3", 3, "again")))
    index_documents(job, documents(spark, one, two), "c2", 200)
    assert index.ids() == ["x1", "x2", "x3", "y1"]


def test_malformed_document_keeps_its_records(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    broken = ("/db/dict/a", 5, 1, "<book id='one'><entry>")
    index_documents(job, documents(spark, broken, TWO), "c2", 200, on_malformed="skip")
    assert index.ids() == ["x1", "x2", "x3", "y1"]
    states = {r.collection: r.failure_class for r in job.status.read().collect()}
    assert states == {"/db/dict/a": "MalformedDocument", "/db/dict/b": None}


def test_remove_documents(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    asked = spark.createDataFrame([("words", "one"), ("words", "nobody")], "index_name string, doc_key string")
    assert operations(remove_documents(job, asked, "c2", 200)) == {"one": ("current", 3)}
    assert index.ids() == ["y1"]
    assert [r.doc_key for r in job.store.latest().collect()] == ["two"]
    assert operations(index_documents(job, documents(spark, ONE), "c3", 300)) == {"one": ("current", 3)}


TREE = "index_name string, tree string"


def test_remove_collection_spares_siblings_and_marks_stale(spark, job, index):
    sibling = ("/db/dict/ab", 7, 3, book("three", ("z1", 1, "z")))
    below = ("/db/dict/a/sub", 8, 4, book("four", ("w1", 1, "w")))
    index_documents(job, documents(spark, ONE, sibling, below), "c1", 100)
    asked = spark.createDataFrame([("words", "/db/dict/a"), ("words", "/db/none")], TREE)
    out = remove_collections(job, asked, "c2", 200)
    assert [(r.tree, r.state, r.object_count) for r in out.collect()] == [("/db/dict/a", "current", 4)]
    assert index.ids() == ["z1"]
    assert job.pending.read().count() == 0
    states = {r.collection: r.state for r in job.status.read().collect()}
    assert states["/db/none"] == "stale_local_store" and states["/db/dict/a"] == "current"


def test_failed_removal_stays_pending_and_spares_new_documents(spark, job, index):
    index_documents(job, documents(spark, ONE), "c1", 100)
    request_removals(job, spark.createDataFrame([("words", "/db/dict/a")], TREE))
    index.failing = job.publisher.transport.failing = "deleteObject"
    flush_removals(job, "c2", 200)
    assert job.store.latest().count() == 3 and job.pending.requests().count() == 1
    job.publisher.transport.failing = ""
    other = ("/db/dict/a", 5, 9, book("nine", ("n1", 1, "neu")))
    index_documents(job, documents(spark, other), "c3", 300)
    flush_removals(job, "c4", 400)
    assert index.ids() == ["n1"]
    assert [r.doc_key for r in job.store.latest().collect()] == ["nine"]


def test_drop_index(spark, job, index):
    index_documents(job, documents(spark, ONE), "c1", 100)
    drop_index(job, "words")
    assert job.store.latest().count() == 0
    row = job.status.read().where("collection is null").first()
    assert (row.operation, row.state) == ("index_drop", "current")


def test_report_replay_refresh_reconcile(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    live = live_reader(spark, index)
    report = report_for(job, "words", "/db/dict", live()).first()
    # Nothing was ever recorded for the parent collection itself.
    assert report.synced and report.classification == "stale_status" and report.local_count == 4
    assert report_for(job, "words", "/db/dict/a", live()).first().classification == "synced"
    os.remove(os.path.join(index.path, "x2.json"))
    json.dump({"objectID": "stray", "collection": "/db/dict/a", "documentID": 7},
              open(os.path.join(index.path, "stray.json"), "w"))
    json.dump({"objectID": "lost", "collection": "/db/else", "documentID": "one"},
              open(os.path.join(index.path, "lost.json"), "w"))
    report = report_for(job, "words", "/db/dict", live()).first()
    assert report.classification == "wrong_path_drift"
    assert (report.sample_missing, report.sample_unexpected, report.sample_wrong_path) == (
        ["x2"], ["stray"], ["lost"])
    assert (report.replay_delete_count, report.replay_upload_count) == (5, 4)
    with pytest.raises(ValueError, match="wrong_path_drift"):
        refresh(job, "words", "/db/dict", live())
    _outcomes, after = replay(job, "words", "/db/dict", live, "r1")
    assert after.first().synced and index.ids() == ["x1", "x2", "x3", "y1"]
    refresh(job, "words", "/db/dict", live())
    assert job.status.read().where("collection = '/db/dict'").first().operation == "manual_refresh"

    with pytest.raises(PermissionError):
        reconcile(job, "words", "/db/dict/a", documents(spark, ONE, TWO), live, "q1", "stamp__a")
    os.remove(os.path.join(index.path, "x1.json"))
    final = reconcile(job, "words", "/db/dict/a", documents(spark, ONE, TWO), live, "q1", "stamp__a", allow=True)
    assert final.first().synced and index.ids() == ["x1", "x2", "x3", "y1"]
    # A record that only the index has stays: the second round finds what the first one left.
    json.dump({"objectID": "stray", "collection": "/db/dict/a", "documentID": 7},
              open(os.path.join(index.path, "stray.json"), "w"))
    os.remove(os.path.join(index.path, "x1.json"))
    final = reconcile(job, "words", "/db/dict/a", documents(spark, ONE, TWO), live, "q2", "stamp__b", allow=True).first()
    assert not final.synced and (final.sample_missing, final.sample_unexpected) == ([], ["stray"])
    assert index.ids() == ["stray", "x1", "x2", "x3", "y1"]
    aside = {name for name in os.listdir(os.path.join(job.store.path, "quarantine"))}
    assert aside == {"stamp__a", "stamp__b", "stamp__b-2"}
    asked = spark.createDataFrame([("words", "one")], "index_name string, doc_key string")
    with pytest.raises(FileExistsError):
        job.store.quarantine(asked, "stamp__a")


def test_quarantine_reports_missing_documents(spark, job):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    asked = spark.createDataFrame([("words", "one"), ("words", "nobody")], "index_name string, doc_key string")
    moved = {r.doc_key: (r.moved, r.reason) for r in job.store.quarantine(asked, "q").collect()}
    assert moved == {"one": (True, None), "nobody": (False, "missing-source")}
    assert operations(index_documents(job, documents(spark, ONE), "c2", 200)) == {"one": ("current", 3)}


def test_vacuum_keeps_newest(spark, job):
    for n in range(4):
        doc = ("/db/dict/a", 5, 1, book("one", ("x1", n, "hello")))
        index_documents(job, documents(spark, doc), f"c{n}", 100 + n)
    job.store.vacuum(keep=2)
    assert sorted(r.snapshot_ts for r in job.store.read().collect()) == [102, 103]


def test_vacuum_frees_what_was_replaced(spark, job, tmp_path):
    for n in range(3):
        index_documents(job, documents(spark, ("/db/dict/a", 5, 1, book("one", ("x1", n, "hello")))), f"c{n}", 100 + n)
    folder = tmp_path / "store" / "snapshots"
    job.store.vacuum(keep=1)
    assert len(list((folder / "data").iterdir())) > 2
    job.store.vacuum(keep=1, grace=0.0)
    # One run of history, one of current rows, and one listing.
    assert len(list((folder / "data").iterdir())) == 2 and len(list((folder / "trees").iterdir())) == 1
    assert len([p for p in (folder / "log").iterdir() if p.name.isdigit()]) == 1
    assert [r.snapshot_ts for r in job.store.read().collect()] == [102]


def test_second_writer_of_a_version_changes_nothing(spark, tmp_path):
    from xmlindex.sources.versions import VersionedFolder

    versions = VersionedFolder(spark, str(tmp_path / "t"))
    folders = [versions.new_folder() for _ in range(2)]
    for n, folder in enumerate(folders):
        spark.range(n + 1).write.parquet(folder)
    versions.publish(1, folders[0])
    with pytest.raises(Exception, match="exists"):
        versions.publish(1, folders[1])
    assert spark.read.parquet(versions.folder(versions.current())).count() == 1


def test_failed_replay_phase_is_the_last(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    os.remove(os.path.join(index.path, "x2.json"))
    json.dump({"objectID": "stray", "collection": "/db/dict/a", "documentID": 7},
              open(os.path.join(index.path, "stray.json"), "w"))
    job.publisher.transport.failing = "deleteObject"
    outcomes, after = replay(job, "words", "/db/dict", live_reader(spark, index), "r1")
    assert {r.state for r in outcomes.collect()} == {"degraded"}
    assert not after.first().synced and "x2" not in index.ids()


def test_replay_batches_are_ordered_and_bounded(spark):
    plan = spark.range(7).select(
        F.lit("i").alias("index_name"), F.format_string("d%02d", "id").alias("object_id"),
        F.lit(1).alias("action_rank"), F.lit("delete").alias("op"), F.lit(None).cast("string").alias("record_json"),
    ).unionByName(spark.range(4).select(
        F.lit("i").alias("index_name"), F.format_string("a%02d", "id").alias("object_id"),
        F.lit(2).alias("action_rank"), F.lit("add").alias("op"),
        F.format_string('{"objectID":"a%02d"}', "id").alias("record_json"),
    ))
    rows = replay_batches(plan, 3).orderBy("chunk").collect()
    assert [(r.chunk, r.total_chunks, r.requests, r.phase) for r in rows] == [
        (1, 4, 3, 1), (2, 4, 3, 1), (3, 4, 3, 2), (4, 4, 2, 3)]
    sent = [q["body"]["objectID"] for r in rows for q in json.loads(r.body)["requests"]]
    assert sent == [f"d{n:02d}" for n in range(7)] + [f"a{n:02d}" for n in range(4)]


EVENTS = ("sequence bigint, op string, collection string, collection_id int, document_id int, "
          "user_document_id string, xml string")


def event(sequence, op, document=None, collection=None, user=None):
    if document is None:
        return (sequence, op, collection, None, None, None, None)
    return (sequence, op, *document[:3], user, document[3])


def test_events_apply_in_order(spark, job, index):
    newer = (*ONE[:3], book("one", ("x1", 1, "hello")))
    batch = [
        event(1, "upsert", ONE), event(2, "upsert", TWO), event(3, "upsert", newer),
        event(4, "remove_collection", collection="/db/dict/b"),
    ]
    apply_events(job, spark.createDataFrame(batch, EVENTS), "b0", 100)
    assert index.ids() == ["x1"]
    batch = [
        event(5, "remove_collection", collection="/db/dict/a"), event(6, "upsert", ONE),
        event(7, "delete", TWO, user="two"), event(8, "upsert", TWO),
    ]
    apply_events(job, spark.createDataFrame(batch, EVENTS), "b1", 200)
    assert index.ids() == ["x1", "x2", "x3", "y1"]
    apply_events(job, spark.createDataFrame([event(9, "delete", TWO, user="two")], EVENTS), "b2", 300)
    assert index.ids() == ["x1", "x2", "x3"]


def test_deletes_without_the_users_id(spark, job, index):
    # The user's id of this document is the internal id of the first one.
    namesake = ("/db/dict/b", 6, 3, book("1", ("z1", 1, "nu")))
    apply_events(job, spark.createDataFrame([event(1, "upsert", ONE), event(2, "upsert", namesake)], EVENTS), "b0", 100)
    batch = [event(3, "delete", ONE), event(4, "delete", ("/db/dict/a", 5, 99, None))]
    for _ in range(2):
        apply_events(job, spark.createDataFrame(batch, EVENTS), "b1", 200)
        assert index.ids() == ["z1"]
    assert [r.doc_key for r in job.store.latest().collect()] == ["1"]


def test_stream_equals_batch(spark, job, index, tmp_path):
    source = str(tmp_path / "events")
    spark.createDataFrame([event(1, "upsert", ONE), event(2, "upsert", TWO)], EVENTS).write.parquet(source)
    stream = spark.readStream.schema(EVENTS).parquet(source)
    start_incremental(job, stream, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    assert index.ids() == ["x1", "x2", "x3", "y1"]
    newer = (*ONE[:3], book("one", ("x1", 1, "hello")))
    spark.createDataFrame([event(3, "upsert", newer)], EVENTS).write.mode("append").parquet(source)
    start_incremental(job, stream, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    assert index.ids() == ["x1", "y1"]


def test_file_publisher_writes_request_lines(spark, tmp_path):
    job = Job.at(spark, str(tmp_path / "s"), [CONFIG], FilePublisher(str(tmp_path / "out")))
    index_documents(job, documents(spark, ONE), "c1", 100)
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(len(line["requests"]) for line in lines) == [1, 2]
    assert all(q["action"] == "addObject" for line in lines for q in line["requests"])


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    from xmlindex.sources.documents import read_documents, stream_documents

    for folder in ("", "east/", "west/east/"):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "same.xml").write_text(f"<r>{folder}</r>")
    expected = {
        ("/db", "same.xml", "<r></r>"), ("/db/east", "east/same.xml", "<r>east/</r>"),
        ("/db/west/east", "west/east/same.xml", "<r>west/east/</r>"),
    }
    rows = read_documents(spark, str(tmp_path)).collect()
    assert {(r["collection"], r["document_id"], bytes(r["xml"]).decode()) for r in rows} == expected
    stream = stream_documents(spark, str(tmp_path)).writeStream.format("memory").queryName("found_files").start()
    stream.processAllAvailable()
    stream.stop()
    assert spark.table("found_files").count() == 3


def test_odd_rows_do_not_end_a_run(spark):
    from xmlindex.functions.paths import ancestors
    from xmlindex.operators.shred import malformed_documents

    paths = spark.createDataFrame([("stray",), ("/a/b",), ("a/b",), ("",), ("/",)], "c string")
    assert [r[0] for r in paths.select(ancestors("c")).collect()] == [
        ["stray"], ["/a/b", "/a"], ["a/b", "a"], [""], ["/"]]
    odd = [(1, b"<r/>"), (2, b"<r>"), (3, b'<?xml version="1.0" encoding="Shift_JIS"?><r/>'),
           (4, b'<?xml version="1.0" encoding="none-such"?><r/>'), (5, None)]
    found = malformed_documents(spark.createDataFrame(odd, "document_id int, xml binary"))
    assert {r["document_id"] for r in found.collect()} == {2, 3, 4, 5}


def test_removals_without_a_configuration_cover_nothing(spark):
    from xmlindex.config import load_config
    from xmlindex.streaming.incremental import surviving_events

    config = load_config({"collection": "/db/kept", "indexes": [{"name": "i", "roots": [{"path": "/", "fields": []}]}]})
    events = spark.createDataFrame(
        [(1, "upsert", "/db/kept", 1), (2, "upsert", "/db/kept", 2), (2, "upsert", "/db/kept", 1),
         (3, "remove_collection", "/db", None), (4, "upsert", "/db/kept/low", 3), (5, "remove_collection", "/db/kept/low", None)],
        "sequence long, op string, collection string, document_id int",
    )
    kept = surviving_events(events, [config]).collect()
    assert sorted((r["sequence"], r["document_id"]) for r in kept) == [(2, 1), (2, 2)]


def test_an_append_beside_a_vacuum_is_kept(spark, job, index, monkeypatch):
    for n in range(2):
        index_documents(job, documents(spark, ("/db/dict/a", 5, 1, book("one", ("x1", n, "hello")))), f"c{n}", 100 + n)
    written = job.store._compacted

    def beside(state):
        monkeypatch.setattr(job.store, "_compacted", written)
        result = written(state)
        index_documents(job, documents(spark, TWO), "beside", 300)
        return result

    monkeypatch.setattr(job.store, "_compacted", beside)
    job.store.vacuum(keep=1)
    assert {(r.doc_key, r.snapshot_ts) for r in job.store.read().collect()} == {("one", 101), ("two", 300)}
    assert {(r.doc_key, r.snapshot_ts) for r in job.store.latest().collect()} == {("one", 101), ("two", 300)}
    assert {r.object_id for r in job.store.listing("/db/dict").collect()} == {"x1", "y1"}


def test_a_repeated_commit_replaces_only_its_own_rows(spark, job, index):
    index_documents(job, documents(spark, ONE, TWO), "c1", 100)
    other = (*ONE[:3], book("one", ("x9", 9, "other")))
    emptied = (*TWO[:3], book("two"))
    index_documents(job, documents(spark, other, emptied), "c2", 200)
    assert {r.object_id for r in job.store.latest().collect()} == {"x9"}
    # Repeated with other input: the first document is as it was before the commit.
    index_documents(job, documents(spark, emptied), "c2", 200)
    assert {r.object_id for r in job.store.latest().collect()} == {"x1", "x2", "x3"}
    assert {r.object_id for r in job.store.listing("/db/dict").collect()} == {"x1", "x2", "x3"}
    assert job.store.read().where("commit = 'c1'").count() == 4


def test_late_snapshots_take_their_place_in_the_history(spark, job, index):
    index_documents(job, documents(spark, ONE), "c1", 100)
    rows = job.store.latest().withColumn("snapshot_ts", F.lit(50).cast("bigint"))
    job.store.append(rows.where("object_id = 'x1'"), "late")
    assert {r.snapshot_ts for r in job.store.latest().collect()} == {100} and job.store.latest().count() == 3
    assert {r.object_id for r in job.store.latest(F.lit(100)).collect()} == {"x1"}
    assert job.store.listing().count() == 3


def test_reading_the_newest_leaves_the_history_alone(spark, job, index):
    for n in range(8):
        index_documents(job, documents(spark, ONE[:3] + (book("one", ("x1", n, "hello"), ("x2", n, "w")),)), f"c{n}", 100 + n)
    assert job.store.read().select("snapshot_ts").distinct().count() == 8
    wanted = spark.createDataFrame([("words", "one")], "index_name string, doc_key string")
    runs = {run.id for run in job.store.log.state().runs if run.current}
    read = {part[4:] for path in job.store.latest_of(wanted).inputFiles() for part in path.split("/") if part.startswith("run=")}
    assert len(runs) < 8
    files_of_rows = {part[4:] for path in job.store.latest_of(wanted).inputFiles() if "/data/" in path
                     for part in path.split("/") if part.startswith("run=")}
    assert files_of_rows <= runs and read
    assert [r.snapshot_ts for r in job.store.latest().collect()] == [107, 107]


def test_one_tree_is_read_from_its_own_files(spark, tmp_path):
    from xmlindex.sources.snapshots import SnapshotStore

    store = SnapshotStore(spark, str(tmp_path / "s"), capacity=50)
    rows = spark.range(400).select(
        F.lit("i").alias("index_name"), F.col("id").cast("string").alias("doc_key"), F.lit(1).cast("bigint").alias("snapshot_ts"),
        F.lit("0").alias("node_key"), F.col("id").cast("string").alias("object_id"),
        F.concat(F.lit("/db/c"), (F.col("id") % 8).cast("string")).alias("collection"),
        F.lit("1").alias("document_id"), F.lit(None).cast("string").alias("user_document_id"),
        F.lit("{}").alias("record_json"), F.md5(F.lit("{}")).alias("md5"))
    store.append(rows, "c1")
    assert len({b for b in store._directory(store.log.state().directory).slots}) >= 8
    held = store.listing("/db/c3")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(place" in plan and "LessThan(place" in plan and "record_json" not in plan
    assert {r.collection for r in held.collect()} == {"/db/c3"} and held.count() == 50
    # Siblings that begin alike are outside, what lies below is inside.
    more = rows.withColumn("doc_key", F.concat(F.lit("n"), "doc_key")).withColumn("collection", F.concat("collection", F.lit("/low")))
    store.append(more.withColumn("object_id", F.col("doc_key")), "c2")
    store.append(rows.where("id < 8").withColumn("collection", F.concat("collection", F.lit("x"))).withColumn("snapshot_ts", F.lit(2).cast("bigint")), "c3")
    assert store.listing("/db/c3").count() == 99 and store.listing("/db/c3x").count() == 1
    store.drop_index("i")
    assert store.listing().count() == store.latest().count() == store.read().count() == 0
    store.append(rows, "c4")
    assert store.latest().count() == store.read().count() == 400


def test_buckets_split_as_they_fill():
    from xmlindex.sources.directory import Directory

    directory = Directory().split({0: (90, 9), 1: (5, 5), 2: (4, 1), 3: (60, 1)}, 2, 20)
    assert directory == Directory(2, (0, 2, 1, 3))
    deeper = directory.split({n: (30, 3) if n in (0, 1) else (1, 1) for n in range(8)}, 3, 20)
    assert deeper.depth == 3 and deeper.slots[0] != deeper.slots[1] and deeper.slots[2] == deeper.slots[3] == 2


def test_roots_in_any_spelling(spark, tmp_path, monkeypatch):
    from xmlindex.sources.documents import read_documents

    (tmp_path / "books" / "sub").mkdir(parents=True)
    for name in ("a.xml", "sub/a.xml"):
        (tmp_path / "books" / name).write_text("<r/>")
    for root in (f"file:{tmp_path}/./books", f"{tmp_path}/books/", f"file://{tmp_path}/books/sub/..", f"{tmp_path}//books"):
        rows = read_documents(spark, root, "/db/b").collect()
        assert {(r["collection"], r["document_id"]) for r in rows} == {("/db/b", "a.xml"), ("/db/b/sub", "sub/a.xml")}


def test_a_new_checkpoint_at_the_same_path_keeps_earlier_commits(spark, job, index, tmp_path):
    import shutil

    for n, document in enumerate((ONE, TWO)):
        source, checkpoint = str(tmp_path / f"events{n}"), str(tmp_path / "checkpoint")
        spark.createDataFrame([event(1, "upsert", document)], EVENTS).write.parquet(source)
        start_incremental(job, spark.readStream.schema(EVENTS).parquet(source), checkpoint, availableNow=True).awaitTermination()
        shutil.rmtree(checkpoint)
    assert {r.doc_key for r in job.store.latest().collect()} == {"one", "two"}


TIMED = EVENTS + ", event_ts bigint"


def test_events_that_come_late_send_nothing(spark, job, index):
    old, new = (*ONE[:3], book("one", ("x1", 1, "old"), ("x5", 1, "old"))), (*ONE[:3], book("one", ("x1", 2, "new")))
    versions = [(100, ONE), (300, new), (200, old)]
    for n, (at, document) in enumerate(versions):
        batch = spark.createDataFrame([(*event(n, "upsert", document), at)], TIMED)
        apply_events(job, batch, f"b{n}")
    assert index.ids() == ["x1"] and {r.snapshot_ts for r in job.store.latest().collect()} == {300}
    assert {r.object_id for r in job.store.latest(F.lit(250)).collect()} == {"x1", "x5"}
    assert {r.object_id for r in job.store.latest(F.lit(150)).collect()} == {"x1", "x2", "x3"}
    # A late deletion marks the history, a later one deletes.
    apply_events(job, spark.createDataFrame([(*event(3, "delete", ONE, user="one"), 250)], TIMED), "b3")
    assert index.ids() == ["x1"] and job.store.latest(F.lit(260)).count() == 0
    apply_events(job, spark.createDataFrame([(*event(4, "delete", ONE), 400), (*event(5, "upsert", old), 350)], TIMED), "b4")
    assert index.ids() == []
    # What was deleted stays so, if only an older version comes.
    apply_events(job, spark.createDataFrame([(*event(6, "upsert", old), 360)], TIMED), "b5")
    assert index.ids() == [] and job.store.latest().count() == 0


def test_the_later_of_two_status_writers_folds_into_the_other(spark, job, monkeypatch):
    from xmlindex.operators.status import outcome_events

    def events(collection, seq):
        rows = spark.createDataFrame([("i", collection, "current", 1, None, None)], "index_name string, collection string, "
                                     "state string, object_count long, failure_class string, failure_message string")
        return outcome_events(rows, "batch_write", f"t{seq}", seq)

    claim = job.status._versions.claim

    def beside(version, folder):
        monkeypatch.setattr(job.status._versions, "claim", claim)
        job.record(events("/db/b", 2))
        return claim(version, folder)

    monkeypatch.setattr(job.status._versions, "claim", beside)
    job.record(events("/db/a", 1))
    assert {r.collection for r in job.status.read().collect()} == {"/db/a", "/db/b"}


def test_an_indexing_run_stages_texts_once_and_does_not_rewrite_the_first_run(spark, tmp_path, monkeypatch):
    import gzip

    from xmlindex.session import Staging

    staged, write = [], Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, df, label: staged.append((label, set(df.columns))) or write(self, df, label))
    job = Job.at(spark, str(tmp_path / "s"), [CONFIG], FilePublisher(str(tmp_path / "out")), capacity=2)
    index_documents(job, documents(spark, ONE, ("/db/dict/a", 5, 2, "<book>")), "c1", 100, on_malformed="skip")
    assert [label for label, columns in staged if columns & {"fields", "record_json"}] == ["extracted"]
    assert [r.rows for r in job.store.log.state().runs] == [3]
    assert [r for r in job.status.read().collect() if r.failure_class == "MalformedDocument"]
    sent = list((tmp_path / "out").rglob("*.gz"))
    assert sent and all(json.loads(line)["requests"] for path in sent for line in gzip.open(path, "rt"))

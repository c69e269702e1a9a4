"""Operators on small frames, brute-force comparisons, and the plans that matter at scale."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from xmlindex.config import load_config
from xmlindex.functions import paths as P
from xmlindex.operators import batches as B, snapshots as S, status as T, sync as Y
from xmlindex.operators.extract import extract_records
from xmlindex.operators.publish import TransportError, retryable, send
from xmlindex.operators.ranking import with_positions
from xmlindex.sources.live import read_live_index
from xmlindex.sources.snapshots import SnapshotStore, import_snapshot_files
from xmlindex.sources.status import read_status_document, status_lines


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def changes(spark, adds, updates, deletes, document="1"):
    rows = [("i", document, op, f"{op}{n}") for op, many in (("add", adds), ("update", updates), ("delete", deletes))
            for n in range(many)]
    return spark.createDataFrame(rows, "index_name string, document_id string, op string, object_id string")


def test_chunks_hold_additions_then_updates_then_deletions(spark):
    plan = B.chunk_plan(B.plan_batches(changes(spark, 3, 6, 4), 5)).orderBy("chunk").collect()
    assert [(r.chunk, r.total_chunks, r.additions, r.updates, r.deletions) for r in plan] == [
        (1, 3, 3, 2, 0), (2, 3, 0, 4, 1), (3, 3, 0, 0, 3)]
    assert B.plan_batches(changes(spark, 0, 0, 0), 3).count() == 0
    single = B.plan_batches(changes(spark, 2, 0, 0), 0).select(F.max("total_chunks")).first()[0]
    assert single == 2  # a batch holds at least one operation


def test_batches_of_one_operation_are_assembled_where_they_are(spark):
    rows = changes(spark, 1, 0, 0).unionByName(changes(spark, 0, 0, 1, "2")).withColumn("record_json", F.lit('{"objectID":"x"}'))
    planned = B.plan_batches(rows, 5).localCheckpoint()
    single = B.single_batches(planned)
    assert "Exchange" not in plan_of(single)
    whole = B.assemble_batches(planned)
    assert single.dtypes == whole.dtypes
    assert sorted(map(tuple, single.collect())) == sorted(map(tuple, whole.collect()))


def test_hot_document_is_numbered_in_slices(spark):
    rows = B.number_operations(changes(spark, 300, 50, 0), ["index_name", "document_id"])
    assert sorted(r.position for r in rows.collect()) == list(range(1, 351))
    # The operations themselves are exchanged by slice, not by document alone.
    assert re.search(r"hashpartitioning\(index_name#\d+, document_id#\d+, op_rank#\d+L?, slice#\d+", plan_of(rows))


def test_positions_follow_the_order(spark):
    ids = [f"k{n:03d}" for n in range(200)]
    random.Random(1).shuffle(ids)
    frame = spark.createDataFrame([(i,) for i in ids], "k string").repartition(5)
    rows = with_positions(frame, "k").orderBy("position").collect()
    assert [(r.position, r.k) for r in rows] == list(enumerate(sorted(ids), 1))


def test_collection_tree(spark):
    paths = ["/db/a", "/db/a/b", "/db/ab", "/db", "/db/a2/x"]
    frame = spark.createDataFrame([(p,) for p in paths], "c string")
    inside = [r.c for r in frame.where(P.in_collection_tree("c", "/db/a")).collect()]
    assert inside == ["/db/a", "/db/a/b"]
    assert frame.where("c = '/db/a/b'").select(P.ancestors("c")).first()[0] == ["/db/a/b", "/db/a", "/db"]
    checks = [("/a/b/c", "/a/b", True), ("/a/b", "/a/b", True), ("/a", "/a/b", False), ("/a/bc", "/a/b", False), ("/a", "", True)]
    for path, other, expected in checks:
        row = spark.range(1).select(P.path_starts_with(F.lit(path), F.lit(other))).first()
        assert row[0] is expected


def test_names(spark):
    row = spark.range(1).select(
        P.slug(F.lit("/db/a b/ü")), P.quarantine_name(F.lit("/db/a"), F.lit("T")),
        P.collection_filter(F.lit('/db/"x"\\y')), P.quoted_index_name(F.lit("a b*~/é")),
        P.document_filter(F.lit(7), F.lit(None).cast("string")), P.document_filter(F.lit(7), F.lit("u")),
    ).first()
    assert list(row) == ["db_a_b__", "T__db_a", 'collection:"/db/\\"x\\"\\\\y"', "a%20b%2A~%2F%C3%A9",
                         "documentID = 7", "documentID:u"]


def test_report_agrees_with_sets(spark):
    """Random placements, duplicates of object ids and misplaced documents against plain sets."""
    rng = random.Random(7)
    places = ["/db/a", "/db/a/x", "/db/b", "/db/b/y", "/db/c"]
    local = [("i", f"d{n % 17}", f"o{rng.randrange(60)}", rng.choice(places), f"u{n % 17}" if n % 5 else None)
             for n in range(90)]
    live = [("i", f"o{n}", rng.choice(places + ["/else"]), f"u{rng.randrange(20)}") for n in range(20, 80)]
    trees = ["/db", "/db/a", "/db/a/x", "/db/b", "/db/c", "/none"]
    got = Y.sync_report(
        spark.createDataFrame(local, "index_name string, doc_key string, object_id string, collection string, document_id string"),
        spark.createDataFrame(live, "index_name string, object_id string, collection string, document_id string"),
        spark.createDataFrame([("i", t) for t in trees], "index_name string, tree string"), sample_limit=3,
    ).collect()
    assert sorted(r.tree for r in got) == sorted(trees)
    for row in got:
        def inside(place, tree=row.tree):
            return place == tree or place.startswith(tree + "/")

        stored = [r for r in local if inside(r[3])]
        ids = {r[2] for r in stored}
        there = {r[1] for r in live if inside(r[2])}
        documents = {r[4] for r in stored if r[4]}
        wrong = [r[1] for r in live if r[3] in documents and not inside(r[2])]
        assert (row.local_count, row.live_count, row.missing_count, row.unexpected_count, row.wrong_path_count) == (
            len(ids), len(there), len(ids - there), len(there - ids), len(wrong))
        assert (row.document_dirs, row.document_ids) == (len({r[1] for r in stored}), len(documents))
        assert row.sample_missing == sorted(ids - there)[:3]
        assert row.sample_unexpected == sorted(there - ids)[:3]
        assert row.sample_wrong_path == sorted(wrong)[:3]
        assert row.replay_delete_count == len(there | set(wrong))


def test_report_groups_by_hashing_and_does_not_depend_on_how(spark, monkeypatch):
    """Where objects are is a number per object, which needs no sort; very many trees take arrays instead."""
    rng = random.Random(3)
    places = [f"/db/{a}/{b}" for a in "abc" for b in range(30)]
    local = spark.createDataFrame(
        [("i", f"d{n % 9}", f"o{rng.randrange(80)}", rng.choice(places), f"u{n % 9}") for n in range(120)],
        "index_name string, doc_key string, object_id string, collection string, document_id string")
    live = spark.createDataFrame([("i", f"o{n}", rng.choice(places), f"u{rng.randrange(12)}") for n in range(20, 90)],
                                 "index_name string, object_id string, collection string, document_id string")
    trees = spark.createDataFrame([("i", t) for t in (*places, "/db", "/db/a", "/db/b")], "index_name string, tree string")
    plan = plan_of(Y.wrong_path_groups(local, live, trees, 0, Y.TreeSets(local, live, trees)))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    found = [(Y.sync_report(local, live, trees), Y.sync_counts(local, live, trees))]
    monkeypatch.setattr(Y, "_WORDS", 1)
    found.append((Y.sync_report(local, live, trees), Y.sync_counts(local, live, trees)))
    few, many = ([sorted(map(str, df.collect())) for df in frames] for frames in found)
    assert few == many and len(few[0]) == 93 and len(few[1]) > 93


@pytest.mark.parametrize("numbers, state, expected", [
    ((3, 3, 0, 0, 0), "current", "synced"),
    ((3, 3, 0, 0, 0), None, "stale_status"),
    ((3, 3, 0, 0, 0), "degraded", "stale_status"),
    ((0, 3, 0, 3, 0), None, "local_store_corruption"),
    ((0, 3, 0, 3, 1), None, "local_store_corruption"),
    ((3, 3, 1, 1, 2), None, "wrong_path_drift"),
    ((3, 2, 1, 0, 0), None, "true_live_loss"),
    ((3, 3, 1, 1, 0), None, "mismatch"),
])
def test_classification(spark, numbers, state, expected):
    names = ["local_count", "live_count", "missing_count", "unexpected_count", "wrong_path_count"]
    row = spark.createDataFrame([(*numbers, not any(numbers[2:]), state)],
                                ", ".join(f"{n} int" for n in names) + ", synced boolean, status_state string")
    assert row.select(Y.classify(row, True)).first()[0] == expected
    if expected == "stale_status":
        assert row.select(Y.classify(row, False)).first()[0] == "synced"


EVENTS = "index_name string, collection string, operation string, state string, ts string, seq bigint, " \
         "object_count bigint, failure_class string, failure_message string"


def test_status_keeps_the_last_success(spark):
    def fold(rows, previous=None):
        return T.fold_status(spark.createDataFrame(rows, EVENTS), previous)

    first = fold([("i", "/db", "batch_write", "current", "t1", 1, 5, None, None),
                  ("i", "/db", "batch_write", "degraded", "t2", 2, None, "E", "m"),
                  ("i", None, "index_drop", "current", "t1", 1, None, None, None)])
    rows = {r.collection: r for r in first.collect()}
    assert (rows["/db"].state, rows["/db"].ts, rows["/db"].last_success_ts) == ("degraded", "t2", "t1")
    second = fold([("i", "/db", "batch_write", "stale_local_store", "t3", 0, None, None, None)], first)
    row = second.where("collection = '/db'").first()
    assert (row.state, row.last_success_ts, row.failure_class) == ("stale_local_store", "t1", None)
    assert [r.collection for r in T.status_gate(second).collect()] == ["/db"]
    keys = spark.createDataFrame([("i", "/db"), ("i", "/x")], "index_name string, collection string")
    assert {r.collection: r.state for r in T.status_for(second, keys).collect()} == {"/db": "stale_local_store", "/x": None}


def test_newest_events_fold_to_the_same_status(spark):
    rows = [(i, c, "batch_write", state, f"t{n}", n, n, None, None) for n, (i, c, state) in enumerate(
        [("i", "/a", "current"), ("i", "/a", "current"), ("i", "/a", "degraded"), ("i", "/b", "degraded"),
         ("i", "/b", "degraded"), ("i", None, "current"), ("i", None, "current")])]
    events = spark.createDataFrame(rows, EVENTS)
    newest = T.newest_events(events)
    assert sorted(r.seq for r in newest.collect()) == [1, 2, 4, 6]
    assert sorted(map(str, T.fold_status(newest).collect())) == sorted(map(str, T.fold_status(events).collect()))


def test_status_documents(spark, tmp_path):
    entry = {"index": "i", "collection": "/db", "operation": "batch_write", "state": "degraded", "timestamp": "t",
             "failureClass": "E", "failureMessage": "m"}
    (tmp_path / "s.json").write_text(json.dumps(
        {"updatedAt": "t", "healthContractVersion": 1, "records": [entry, {"state": "current"}], "collectionHealth": [entry]}))
    records, health = read_status_document(spark, str(tmp_path / "s.json"))
    assert records.count() == 1 and health.first().failure_class == "E"
    line = status_lines(records).first()
    assert line.health and json.loads(line.entry) == entry


def test_live_dumps(spark, tmp_path):
    records = [
        {"objectID": "a", "collection": "/db", "documentID": "d"}, {"objectID": "b", "collection": "/db", "documentID": 7},
        {"objectID": 5, "collection": "/db"}, {"objectID": "", "collection": "/db"}, {"objectID": "c"},
    ]
    expected = {("a", "/db", "d"), ("b", "/db", None)}
    for name, text in (("array", json.dumps(records)), ("object", json.dumps({"records": records})),
                       ("lines", "\n".join(map(json.dumps, records)))):
        (tmp_path / f"{name}.json").write_text(text)
        rows = read_live_index(spark, str(tmp_path / f"{name}.json"), "i", lines=name == "lines")
        assert {(r.object_id, r.collection, r.document_id) for r in rows.collect()} == expected, name


def test_live_records_are_parsed_once(spark, tmp_path):
    (tmp_path / "d.jsonl").write_text('{"objectID":"a","collection":"/c","documentID":7}\n{"objectID":"","collection":"/c"}\nx\n')
    rows = read_live_index(spark, str(tmp_path / "d.jsonl"), "i", lines=True)
    assert [tuple(r) for r in rows.collect()] == [("i", "a", "/c", None)]
    physical = plan_of(rows).split("== Initial Plan ==")[0]
    assert len(re.findall(r"parse_json\(|parseJson|ParseJson", physical)) == 1


def test_snapshot_files_are_imported(spark, tmp_path):
    def put(path, collection="/db"):
        target = tmp_path / "indexes" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps({"objectID": target.name, "collection": collection, "documentID": "d"}))

    for path in ("i/doc/100/1.2.json", "i/doc/200/1.2.json", "i/doc/200/.hidden.json", "i/doc/200/1.3.txt",
                 "i/doc/notes/1.json", "i/.x/300/1.json", "i/7/50/0.json"):
        put(path)
    rows = import_snapshot_files(spark, str(tmp_path / "indexes"))
    latest = {(r.doc_key, r.snapshot_ts, r.node_key) for r in S.latest_snapshot(rows).collect()}
    assert latest == {("doc", 200, "1.2"), ("7", 50, "0")}


@pytest.mark.parametrize("error, again", [
    (TransportError("x", 429), True), (TransportError("x", 503), True), (TransportError("x"), True),
    (TransportError("x", 400), False), (ConnectionError("x"), True), (ValueError("x"), False),
])
def test_retries(error, again):
    waits = []

    def failing(_index, _body):
        raise error

    state, attempts, _ack, failure, _message = send(failing, "i", "{}", sleep=waits.append)
    assert retryable(error) is again and state == "degraded" and failure == type(error).__name__
    assert (attempts, waits) == ((3, [1.0, 2.0]) if again else (1, []))


def test_extraction_does_not_shuffle(spark):
    config = load_config({"collection": "/db", "indexes": [{"name": "i", "roots": [
        {"path": "/r/e", "fields": [{"name": "f", "path": "f"}]}]}]})
    documents = spark.createDataFrame([("/db", 1, 1, "<r/>")], "collection string, collection_id int, document_id int, xml string")
    plan = plan_of(extract_records(documents, [config]))
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_lookup_reads_only_the_buckets_and_columns_it_needs(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), capacity=10)
    rows = spark.range(40).select(
        F.lit("i").alias("index_name"), F.col("id").cast("string").alias("doc_key"), F.lit(1).cast("bigint").alias("snapshot_ts"),
        F.lit("0").alias("node_key"), F.col("id").cast("string").alias("object_id"), F.lit("/db").alias("collection"),
        F.lit("1").alias("document_id"), F.lit(None).cast("string").alias("user_document_id"),
        F.lit("{}").alias("record_json"), F.md5(F.lit("{}")).alias("md5"))
    store.append(rows, "c1")
    wanted = spark.createDataFrame([("i", "3"), ("i", "99")], "index_name string, doc_key string")
    held = store.latest_of(wanted).select("doc_key", "object_id", "md5")
    assert [tuple(r)[:2] for r in held.collect()] == [("3", "3")]
    plan = plan_of(held)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+", plan)
    assert "record_json" not in plan


def test_sized_batches_equal_a_walk(spark):
    import random

    rng = random.Random(4)
    sizes = {f"d{g}": [rng.choice([1, 2, 5, 9, 40, 130]) for _ in range(n)] for g, n in enumerate((1, 7, 90, 300))}
    sizes["same"] = [10] * 64
    rows = [("i", g, "add", f"{n:05d}", size) for g, many in sizes.items() for n, size in enumerate(many)]
    frame = spark.createDataFrame(rows, "index_name string, document_id string, op string, object_id string, n int")
    for limit, count in ((50, 6), (100, 1000), (1, 3), (10_000, 8)):
        got = B.plan_sized_batches(frame, F.col("n"), limit, count).collect()
        assert len(got) == len(rows)
        for group in sizes:
            own = sorted((r.position, r.n, r.chunk, r.total_chunks) for r in got if r.document_id == group)
            chunk, held, total, expected = 1, 0, 0, []
            for _position, size, _chunk, _all in own:
                if held and (held >= count or total + size > limit):
                    chunk, held, total = chunk + 1, 0, 0
                held, total = held + 1, total + size
                expected.append(chunk)
            assert [c for _, _, c, _ in own] == expected and {t for *_, t in own} == {chunk}
    assert B.plan_sized_batches(frame.limit(0), F.col("n"), 5).count() == 0


def test_one_document_dumps_are_read_in_parts(spark, tmp_path):
    odd = ['}', '{', '"', '\\', '\\"', '],"records":[{', 'ü\n', "{}[]", '\\}', ""]
    records = [{"objectID": f"o{n}", "collection": "/db", "documentID": odd[n % len(odd)] + "d", "deep": [{"a": {"b": odd[-n % 10]}}, {}],
                "records": [{"objectID": "no", "collection": "/db"}]} for n in range(60)]
    others = {"note": 'a{b}"c', "hits": [{"objectID": "x", "collection": "/db"}], "meta": {"x": {"objectID": "y", "collection": "/db"}}}
    expected = {(r["objectID"], r["documentID"]) for r in records}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        for name, content in (("array", records), ("object", {"records": records}), ("first", {**others, "records": records, "empty": []}),
                              ("last", {"records": records, **others})):
            for indent in (None, 1):
                (tmp_path / f"{name}{indent}.json").write_text(json.dumps(content, indent=indent, ensure_ascii=indent is None), encoding="utf-8")
                frame = read_live_index(spark, str(tmp_path / f"{name}{indent}.json"), "i")
                assert {(r.object_id, r.document_id) for r in frame.collect()} == expected, (name, indent)
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "arrayNone.json")).rdd.getNumPartitions() > 3
        for name, content in (("one", '{"objectID":"a","collection":"/db","documentID":"d"}'), ("deep", '{"objectID":"a","x":{"y":[{}]},"collection":"/db","documentID":"d", "z":{"k":{}} } \n')):
            (tmp_path / f"{name}.json").write_text(content)
            assert [tuple(r) for r in read_live_index(spark, str(tmp_path / f"{name}.json"), "i").collect()] == [("i", "a", "/db", "d")]
        for name, content in (("none", "[]"), ("nothing", '{"records": []}'), ("void", "")):
            (tmp_path / f"{name}.json").write_text(content)
            assert read_live_index(spark, str(tmp_path / f"{name}.json"), "i").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snapshot_files_are_imported_from_archives_too(spark, tmp_path):
    import gzip
    import os

    from xmlindex.sources.archives import read_archives, write_archives

    body = json.dumps({"objectID": "o", "collection": "/db", "documentID": "d"})
    names = ["i/doc/100/1.2.json", "i/doc/200/a b+%2F.json", "i/doc/200/.hidden.json", "i/doc/200/1.3.txt",
             "i/doc/notes/1.json", "i/.x/300/1.json", "i/_y/300/1.json", f"i/{'long' * 40}/50/0.json"]
    path = str(tmp_path / "tree")
    documents = spark.createDataFrame([(n, body) for n in names], "name string, content string").repartition(3)
    sizes = write_archives(documents, path, archive_bytes=2000).collect()
    assert {(r.name, r.size) for r in sizes} == {(n, len(body)) for n in names}
    packed = [n for n in os.listdir(path) if n.endswith(".tar.gz")]
    assert 3 < len(packed) < len(names) and all(gzip.open(f"{path}/{n}").read(1) for n in packed)
    assert {(r.name, bytes(r.content).decode()) for r in read_archives(spark, path).collect()} == {(n, body) for n in names}
    beside = tmp_path / "tree" / "i" / "7" / "60"
    beside.mkdir(parents=True)
    (beside / "1.json").write_text(body)
    found = {(r.index_name, r.doc_key, r.snapshot_ts, r.node_key, r.object_id) for r in import_snapshot_files(spark, path).collect()}
    assert found == {("i", "doc", 100, "1.2", "o"), ("i", "doc", 200, "a b+%2F", "o"),
                     ("i", "long" * 40, 50, "0", "o"), ("i", "7", 60, "1", "o")}

"""Streams over the files of a tree, of which tasks make the list."""

import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from xmlindex.sources import listing as L
from xmlindex.sources.documents import stream_documents


def write(root, *names):
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"<a>{name}</a>")


def run(stream, checkpoint):
    """What one run over all that is there gives, batch by batch."""
    seen = []
    query = stream.writeStream.foreachBatch(lambda df, _n: seen.append({r.document_id: bytes(r.xml).decode() for r in df.collect()}))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return [batch for batch in seen if batch]


def held(checkpoint):
    """Files that Spark's source, and so the driver, keeps of a stream."""
    logs = [f"{checkpoint}/sources/0/{n}" for n in os.listdir(f"{checkpoint}/sources/0") if n.isdigit()]
    return sum(line.startswith("{") for log in logs for line in open(log))


def test_the_driver_holds_no_file_of_a_streamed_tree(spark, tmp_path):
    root, checkpoint = tmp_path / "tree", str(tmp_path / "checkpoint")
    names = {f"{folder}{n}.xml" for n in range(50) for folder in ("", "a/", "a b/c%d/")}
    write(root, *names, "_left/out.xml", ".hidden.xml", "a/_draft.xml", "other.txt", "x=1/_y=2.xml")
    names.add("x=1/_y=2.xml")
    stream = stream_documents(spark, str(root))
    assert run(stream, checkpoint) == [{n: f"<a>{n}</a>" for n in names}]
    assert held(checkpoint) == 1

    # A file that was given is not given again; what is new comes with the next run of the same frame.
    write(root, "a/0.xml", "a/new.xml", "deep/er/new.xml")
    (root / "a/0.xml").write_text("<b/>")
    os.remove(root / "1.xml")
    assert run(stream, checkpoint) == [{n: f"<a>{n}</a>" for n in ("a/new.xml", "deep/er/new.xml")}]
    assert run(stream_documents(spark, str(root)), checkpoint) == []
    assert held(checkpoint) == 2

    # Another stream gets all files as they are now.
    first, second = run(stream_documents(spark, str(root)), str(tmp_path / "other"))
    assert {**first, **second} == {n: f"<a>{n}</a>" for n in {*names, "a/new.xml", "deep/er/new.xml"} - {"1.xml"}} | {"a/0.xml": "<b/>"}


def test_files_that_appear_while_a_stream_waits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "_PAUSE", 0.0)
    monkeypatch.setattr(L, "_SHARE", 0)
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "500")
    seen = []
    write(tmp_path / "tree", "first.xml")
    query = stream_documents(spark, str(tmp_path / "tree")).writeStream.foreachBatch(
        lambda df, _n: seen.extend(r.document_id for r in df.collect())).start()
    try:
        query.processAllAvailable()
        assert seen == ["first.xml"]
        write(tmp_path / "tree", "a/second.xml")
        for _ in range(120):
            if len(seen) < 2:
                query.awaitTermination(0.5)
        assert seen == ["first.xml", "a/second.xml"]
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")


def test_a_listing_that_fails_ends_the_stream(spark, tmp_path, monkeypatch):
    write(tmp_path / "tree", "a.xml", "b.xml")
    stream, checkpoint = stream_documents(spark, str(tmp_path / "tree")), str(tmp_path / "checkpoint")
    with monkeypatch.context() as broken:
        broken.setattr(L.Listing, "_found", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException, match="could not be listed: ZeroDivisionError"):
            run(stream, checkpoint)
    assert run(stream, checkpoint) == [{"a.xml": "<a>a.xml</a>", "b.xml": "<a>b.xml</a>"}]


def test_batches_are_cut_by_the_files_times_and_lengths(spark, tmp_path):
    (tmp_path / "tree").mkdir()
    lengths = [random.Random(n).choice([0, 1, 7, 100, 900]) for n in range(500)]
    rows = [(f"{n}.xml", n // 3, length, n + ((n // 100) << 33)) for n, length in enumerate(lengths)]
    frame = spark.createDataFrame(rows, "path string, modified bigint, length bigint, _id bigint").withColumn(
        "_id", F.col("_id") - F.lit(100) * F.shiftright("_id", 33))
    one = L.Listing(spark, f"file:{tmp_path}/tree", "*.xml", "length", 1000)
    expected = {f"{n}.xml": sum(lengths[:n]) // 1000 for n in range(500)}
    cut = one._cut(frame)
    assert {r.path: r.batch for r in cut.collect()} == expected
    # Of two sessions that make a list at a time, one has to make it anew.
    assert one._publish(cut, "list-00000001") and not one._publish(cut, "list-00000001")
    assert spark.read.option("recursiveFileLookup", True).parquet(one.path).count() == 500
    two = L.Listing(spark, f"file:{tmp_path}/tree", "*.xml", None, 150)
    assert {r.path: r.batch for r in two._cut(frame).collect()} == {f"{n}.xml": n // 150 for n in range(500)}

"""Queries over tables whose shape differs from the given ones."""

import pytest

import table_queries as tables

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("parts", [1, 2])
def test_stream_incremental_reads_a_table_of_parts(spark, tmp_path, parts):
    rows = [(1, "a\nb", "en", "web", 3), (2, "c", "de", "web", 1), (3, "d <e>", "fr", "book", 5)]
    documents = spark.createDataFrame(rows, DOCUMENTS).repartition(parts)
    if parts > 1:
        documents.write.parquet(f"{tmp_path}/documents.parquet")
    else:
        documents.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    found = tables.QUERIES["stream_incremental"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == [("d1", "/db/en/web"), ("d3", "/db/fr/book")]


def test_small_files_share_tasks_and_batches(spark, tmp_path):
    from xmlindex.sources.documents import read_documents, stream_documents

    for n in range(400):
        (tmp_path / f"{n}.xml").write_text(f"<a>{n}</a>")
    found = read_documents(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert {bytes(r.xml).decode() for r in found.collect()} == {f"<a>{n}</a>" for n in range(400)}

    def batches(name, **limit):
        seen = []
        stream = stream_documents(spark, str(tmp_path), **limit).writeStream.foreachBatch(lambda df, _n: seen.append(df.count()))
        stream.option("checkpointLocation", f"{tmp_path}-{name}").trigger(availableNow=True).start().awaitTermination()
        return sorted(seen)

    by_bytes = batches("bytes", batch_bytes=2000)
    assert len(by_bytes) == 2 and sum(by_bytes) == 400
    assert batches("files", files_per_batch=150) == [100, 150, 150]
    assert batches("default") == [400]

"""Token files: one shared zstandard dictionary, each document compressed on its own.

A token data set is a folder with two Parquet tables.

`dictionary`: one row of `hash` (SHA-256, hex) and `data`, the dictionary trained on serialised
id arrays (empty if there was nothing to train on), and `width`, the bytes of an id.

`blocks`: rows of about 256 kB, each with `shard` and `block` (numbers in document order),
`dictionary` (the hash that the frames need), `payload` (zstandard frames, one per document, one
after the other) and the offset index, arrays with one entry per document: `doc_ids`, `ends` (of
the frame in the payload), `starts` (ids of the shard before the document) and `lengths` (ids).
A document is read by picking its block by `first_id` and `last_id`, and decompressing its
frame alone. Ids are unsigned and little-endian.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from xmlindex.llm.bpe import arrow_rows, encode_texts, slices
from xmlindex.llm.support import whole_text
from xmlindex.llm.tokenizer import encoder

BLOCK_BYTES = 1 << 18
LEVEL = 3
# Documents that a shard has at least, on average.
SHARD_ROWS = 100

_BLOCKS = (
    "shard long, block long, first_id long, last_id long, dictionary string, payload binary, "
    "doc_ids array<long>, ends array<long>, starts array<long>, lengths array<long>"
)


def _width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def train_dictionary(encoded: DataFrame, vocabulary: int, *, ids: str = "ids", size: int = 1 << 16) -> bytes:
    """A dictionary trained on the serialised id arrays of a sample, which is collected: bound it."""
    width = _width(vocabulary)
    samples = [np.array(r[0], f"<u{width}").tobytes() for r in encoded.where(F.size(ids) > 0).select(ids).collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""  # too few or too short samples


def sample_texts(df: DataFrame, *, text: str, rows: int, chars: int) -> DataFrame:
    """Windows of at most `chars` characters of at most `rows` distinct texts, spread over the table by a hash.

    Texts are told apart by their hash; another hash places the window. Only the dictionary's
    training sees them: it shapes the compression, not what is written.
    """
    whole = whole_text(f"`{text}`")
    mark = F.xxhash64(whole)
    total = max(1, df.select(F.approx_count_distinct(mark)).first()[0])
    share = min(1 << 20, max(1, (rows << 20) * 3 // (total * 4) + 1))
    begin = F.pmod(F.xxhash64(whole, F.lit("window")), F.greatest(F.length(whole) - chars, F.lit(0)) + 1) + 1
    picked = df.where(F.pmod(mark, F.lit(1 << 20)) < share).select(
        mark.alias("mark"), whole.substr(begin.cast("int"), F.lit(chars)).alias("text")
    )
    return picked.dropDuplicates(["mark"]).select("text").limit(rows)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def shard_keys(keys: DataFrame) -> list[tuple]:
    """Where the shards after the first begin, ascending: keys of `doc_id` and `tie` that cut the rows evenly.

    One row per shard is collected, at most as many as the session has shuffle partitions.
    """
    most = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, min(most, keys.count() // SHARD_ROWS))
    if shards == 1:
        return []
    ranges = keys.repartitionByRange(shards, "doc_id", "tie").groupBy(F.spark_partition_id().alias("range"))
    return sorted(_key(*r["key"]) for r in ranges.agg(F.min(F.struct("doc_id", "tie")).alias("key")).collect())[1:]


def _key(doc_id: int | None, tie: int) -> tuple:
    """Sorts as Spark does, null first."""
    return doc_id is not None, doc_id or 0, tie


def write_tokens(
    encoded: DataFrame, path: str, vocabulary: int, data: bytes, *, doc_id: str = "doc_id", ids: str = "ids",
    tie: str | None = None, keys: DataFrame | None = None, block_bytes: int = BLOCK_BYTES,
) -> None:
    """Write the documents' ids in ascending order of `doc_id` as a token data set; `data` is the
    dictionary.

    Frames are compressed where the ids are, and only compressed bytes are sorted. Null ids: a
    document without ids. Null `doc_id`: before all others. Ties and repeated rows: each is a
    document; rows of one id are ordered by the long column `tie` (default: a hash of their ids),
    which also lets them lie in several shards. An empty table gives an empty `blocks` table.
    Other columns are not written.

    Where shards begin is found first, from `keys`: columns `doc_id` and `tie` of the same rows.
    Without it they come from `encoded`, which is then run more than once. Frames need no copy on
    disk that way, for they go from where they are made to their shard.
    """
    spark = encoded.sparkSession
    width = _width(vocabulary)
    documents = encoded.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        (F.xxhash64(F.col(f"`{ids}`")) if tie is None else F.col(f"`{tie}`")).alias("tie"),
        F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"),
    )
    begins = shard_keys(documents.select("doc_id", "tie") if keys is None else keys)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, data, width)], "hash string, data binary, width int").coalesce(1).write.parquet(
        f"{path}/dictionary"
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data)).compress
        for batch in slices(batches):
            arrays = list(arrow_rows(batch.column("ids")))
            frames = pa.array([frame(a.astype(f"<u{width}").tobytes()) for a in arrays], pa.binary())
            lengths = pa.array([len(a) for a in arrays], pa.int64())
            named = zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())
            shards = pa.array([bisect_right(begins, _key(*one)) for one in named], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [shards, batch.column("doc_id"), batch.column("tie"), lengths, frames],
                names=["shard", "doc_id", "tie", "length", "frame"],
            )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = 0, 0, 0
        held: list[tuple] = []
        held_bytes = 0

        def take() -> pa.RecordBatch:
            nonlocal block, before, held, held_bytes
            names, lengths, frames = zip(*held)
            starts = before + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            known = [n for n in names if n is not None]
            row = {
                "shard": shard, "block": block, "first_id": min(known, default=None), "last_id": max(known, default=None),
                "dictionary": digest, "payload": b"".join(frames), "doc_ids": list(names),
                "ends": np.cumsum([len(f) for f in frames]).tolist(),
                "starts": starts.astype(int).tolist(), "lengths": list(lengths),
            }
            block, before, held, held_bytes = block + 1, before + sum(lengths), [], 0
            return pa.RecordBatch.from_pylist([row], schema)

        longs = pa.list_(pa.int64())
        schema = pa.schema([
            ("shard", pa.int64()), ("block", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()),
            ("dictionary", pa.string()), ("payload", pa.binary()), ("doc_ids", longs), ("ends", longs),
            ("starts", longs), ("lengths", longs),
        ])
        for batch in slices(batches):
            for of, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "length", "frame"))):
                if of != shard:
                    if held:
                        yield take()
                    shard, block, before = of, 0, 0
                held.append(tuple(row))
                held_bytes += len(row[2]) + 64
                if held_bytes >= block_bytes:
                    yield take()
        if held:
            yield take()

    frames = documents.mapInArrow(compress, "shard int, doc_id long, tie long, length long, frame binary")
    ordered = frames.repartitionById(len(begins) + 1, "shard").sortWithinPartitions("shard", "doc_id", "tie")
    ordered.select("shard", "doc_id", "length", "frame").mapInArrow(blocks, _BLOCKS).write.parquet(f"{path}/blocks")


def write_texts(
    df: DataFrame, path: str, tokenizer: str, end_id: int, *, doc_id: str = "doc_id", text: str = "text",
    sample_rows: int = 1000, sample_chars: int = 8192,
) -> None:
    """Encode whole texts, append `end_id` to each and write them as a token data set."""
    vocabulary = max(encoder(tokenizer).size, end_id + 1)

    def ids(frame: DataFrame, carry: list[str]) -> DataFrame:
        encoded = encode_texts(frame, tokenizer, output="ids", carry=carry)
        return encoded.withColumn("ids", F.concat("ids", F.array(F.lit(end_id))))

    sample = sample_texts(df, text=text, rows=sample_rows, chars=sample_chars)
    trained = train_dictionary(ids(sample, ["text"]), vocabulary)
    documents = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(whole_text(f"`{text}`")).alias("tie"),
        F.col(f"`{text}`").alias("text"),
    )
    write_tokens(
        ids(documents, ["doc_id", "tie"]), path, vocabulary, trained, tie="tie", keys=documents.select("doc_id", "tie")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a token data set: doc_id, start (ids of all documents before it), ids.

    Reads the files alone. Where a shard begins is the sum of the shards before it, one row per
    shard.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    hashed, data, width = spark.read.parquet(f"{path}/dictionary").first()
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(data)))
        for batch in slices(batches, 1):
            for block in batch.to_pylist():
                if block["dictionary"] != hashed:
                    raise ValueError(f"block {block['shard']}/{block['block']} needs dictionary {block['dictionary']}")
                payload, begin, found = block["payload"], 0, []
                for end in block["ends"]:
                    found.append(np.frombuffer(reader.decompress(payload[begin:end]), f"<u{width}").astype(np.int32))
                    begin = end
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array([block["base"] + s for s in block["starts"]], pa.int64()),
                        pa.array(found, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    return blocks.join(F.broadcast(bases), "shard").mapInArrow(documents, "doc_id long, start long, ids array<int>")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with this id), by the offset index alone."""
    _, data, width = spark.read.parquet(f"{path}/dictionary").first()
    found = (
        spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
        .where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
        .select("shard", "block", "payload", F.posexplode(F.arrays_zip("doc_ids", "ends")).alias("place", "entry"), "ends")
        .where(F.col("entry.doc_ids") == doc_id)
        .withColumn("begin", F.when(F.col("place") > 0, F.get("ends", F.col("place") - 1)).otherwise(F.lit(0)))
        .withColumn("frame", F.expr("substring(payload, int(begin) + 1, int(entry.ends - begin))"))
        .orderBy("shard", "block", "place").select("frame").collect()
    )
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(data)))
    return [np.frombuffer(reader.decompress(bytes(r["frame"])), f"<u{width}").tolist() for r in found]


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return ids.map(lambda row: zlib.crc32(np.asarray(row, "<u4").tobytes()))

"""BPE encoding and decoding of whole texts, long ones in parallel (tree concatenation)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from xmlindex.llm.support import whole_text
from xmlindex.llm.tokenizer import LEAF_CHARS, encoder

_IDS = T.ArrayType(T.IntegerType())


def arrow_ids(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what is made of one at a time stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def arrow_rows(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The arrays of a list column without nulls, without building Python lists."""
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for start, end in zip(offsets[:-1], offsets[1:]):
        yield values[start:end]


def encode_texts(
    df: DataFrame, tokenizer: str, *, text: str = "text", output: str = "ids", carry: list[str] | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """The columns `carry` (default: all) and `output` array<int>: the ids of the whole text as the
    tokenizer file's library gives them.

    A text of up to `leaf_chars` characters is one leaf and is encoded where it is read. A longer
    one is cut into leaves that are dealt out over all tasks; then its leaves' ids meet again.
    Leaves are halves of halves, cut wherever the middle falls, and are joined pairwise up a tree: a
    growing window around each join is encoded again until its ids agree with both sides.

    Null text and empty text: no ids. Repeated rows stay repeated. An empty table gives an empty
    table. Other columns are kept, whatever their names; one that is called `output` is replaced.
    `carry` without the text keeps whole texts out of both shuffles, where they would travel beside
    their leaves. A document's ids are one row, so the longest document bounds the memory of a task.
    """
    kept = [c for c in (df.columns if carry is None else carry) if c.lower() != output.lower()]
    source = df.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("kept"), whole_text(f"`{text}`").alias("whole")
    )
    kept_field = T.StructField("kept", source.schema["kept"].dataType)  # null beside later leaves

    def encode_short(batches):
        encode = encoder(tokenizer).encode
        for batch in slices(batches):
            ids = [encode(t, leaf_chars) for t in batch.column("whole").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), arrow_ids(ids)], names=["kept", "ids"])

    def cut(batches):
        cutter = encoder(tokenizer)
        leaf = pa.list_(pa.struct([("kind", pa.string()), ("piece", pa.string())]))
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                found = cutter.leaves(one.column("whole")[0].as_py(), leaf_chars)
                pieces = pa.array([[{"kind": k, "piece": p} for k, p in found]], leaf)
                yield pa.RecordBatch.from_arrays(
                    [one.column("number"), one.column("kept"), pieces], names=["number", "kept", "leaves"]
                )

    def encode_leaves(batches):
        encode = encoder(tokenizer).encode_leaf
        for batch in slices(batches):
            pieces = zip(batch.column("kind").to_pylist(), batch.column("piece").to_pylist())
            ids = arrow_ids([encode(kind, piece) for kind, piece in pieces])
            names = ["number", "leaf", "kept", "kind"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], names=[*names, "ids"])

    def join_leaves(batches):
        assemble = encoder(tokenizer).assemble
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                leaves = one.column("leaves")[0].values
                ids = assemble(list(zip(leaves.field("kind").to_pylist(), arrow_rows(leaves.field("ids")))))
                yield pa.RecordBatch.from_arrays([one.column("kept"), arrow_ids([ids])], names=["kept", "ids"])

    encoded = T.StructType([kept_field, T.StructField("ids", _IDS)])
    short = source.where(F.length("whole") <= leaf_chars).mapInArrow(encode_short, encoded)

    # The number only tells the long rows of this scan apart. Their columns travel once, with
    # the first leaf.
    leaf_type = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("piece", T.StringType())]))
    number = T.StructField("number", T.LongType())
    dealt = (
        source.where(F.length("whole") > leaf_chars)
        .withColumn("number", F.monotonically_increasing_id())
        .mapInArrow(cut, T.StructType([number, kept_field, T.StructField("leaves", leaf_type)]))
        .select("number", "kept", F.posexplode("leaves").alias("leaf", "one"))
        .select("number", "leaf", F.when(F.col("leaf") == 0, F.col("kept")).alias("kept"), "one.kind", "one.piece")
        .repartition("number", "leaf")
    )
    gathered = (
        dealt.mapInArrow(encode_leaves, T.StructType([
            number, T.StructField("leaf", T.IntegerType()), kept_field,
            T.StructField("kind", T.StringType()), T.StructField("ids", _IDS),
        ]))
        .groupBy("number")
        .agg(
            F.first("kept", ignorenulls=True).alias("kept"),
            F.sort_array(F.collect_list(F.struct("leaf", "kind", "ids"))).alias("leaves"),
        )
    )
    joined = gathered.select("kept", "leaves").mapInArrow(join_leaves, encoded)
    whole = short.unionByName(joined)
    return whole.select(*(F.col("kept").getField(c).alias(c) for c in kept), F.col("ids").alias(output))


def decode_ids(df: DataFrame, tokenizer: str, *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add `output` string: the ids decoded, special tokens included, as the library decodes them.

    Null or empty ids: the empty text. Bytes that are no UTF-8 become U+FFFD. Other columns are
    kept; one that is called `output` is replaced.
    """

    @F.pandas_udf(T.StringType())
    def decode(column):
        decoder = encoder(tokenizer).decode
        return column.map(lambda row: decoder(np.asarray(row, np.uint32)), na_action=None)

    present: Column = F.coalesce(F.col(f"`{ids}`"), F.array().cast(_IDS))
    return df.withColumn(output, decode(present))

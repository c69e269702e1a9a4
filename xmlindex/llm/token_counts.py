"""Token counts through a digest cache: each distinct text is encoded once per tokenizer version."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from xmlindex.llm.support import unused, whole_text
from xmlindex.llm.tokenizer import LEAF_CHARS, encoder, file_version
from xmlindex.session import materialize
from xmlindex.sources.files import exists

# A text that more than one in so many rows hold is a frequent one.
FREQUENT = 1000
_SCHEMA = "digest binary, version string, n_tokens long"


class CountCache:
    """Stored counts by content digest and tokenizer version, in a folder every executor reaches.

    Each run appends a folder of its own, so a repeated or failed run never harms another's
    counts; two runs that both store a text store the same count.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def counts(self, version: str) -> DataFrame:
        """One row per digest stored for this tokenizer version."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], "digest binary, n_tokens long")
        stored = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/run=*")
        return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        rows = counts.select("digest", F.lit(version).alias("version"), "n_tokens")
        rows.write.mode("errorifexists").parquet(f"{self.path}/run={uuid.uuid4().hex}")


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    cache: CountCache,
    *,
    text: str = "text",
    output: str = "n_tokens",
    normalise: Callable[[Column], Column] | None = None,
    carry: list[str] | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """The columns `carry` (default: all) and `output` long: the tokens of the whole text, as the
    tokenizer file's library counts them.

    Texts are known by the SHA-256 digest of their normalised content, and counts by that and by
    the digest of the tokenizer file. Digests alone decide what is missing; then each missing text
    is encoded once, and the counts are appended to the cache before they are joined back. The
    missing digests are a written table: if it is small enough to broadcast, it filters the texts
    where they are read, and no text that has its count is moved.

    `normalise` may only join texts that the tokenizer itself cannot tell apart (by default
    nothing but null, which counts as empty). Null and empty text: the count of the empty text.
    Repeated rows stay repeated; an empty table gives an empty table and appends nothing of
    weight. Other columns are kept; one that is called `output` is replaced. A text that more than
    one row in `FREQUENT` holds gets its count from a broadcast table, which has fewer than
    `FREQUENT` rows; the others by an equi-join on the digest. `carry` without the text keeps the
    texts out of that join.
    """
    version = file_version(tokenizer)
    columns = [c for c in (df.columns if carry is None else carry) if c.lower() != output.lower()]
    digest, known, place = (unused(df.columns, name) for name in ("_digest", "_known", "_place"))

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        encode = encoder(tokenizer).encode
        return texts.map(lambda t: len(encode(t, leaf_chars)))

    content = whole_text(f"`{text}`")
    if normalise is not None:
        content = normalise(content)
    key = F.unhex(F.sha2(content, 256))

    # Equal texts are joined where they are read, before any row moves, so a text that a third of
    # all rows hold does not meet in one task.
    keyed = df.select(content.alias("content"), key.alias("digest"))
    held = materialize(keyed.groupBy("digest").agg(F.count("*").alias("n")), "digests")
    missing = materialize(held.select("digest").join(cache.counts(version), "digest", "left_anti"), "missing")
    texts = keyed.groupBy("digest").agg(F.max("content").alias("content")).join(missing, "digest", "left_semi")
    counted = texts.select("digest", tokens("content").alias("n_tokens"))
    cache.append(counted, version)

    stored = cache.counts(version)
    rows = held.agg(F.sum("n")).first()[0] or 0
    often = held.where(F.col("n") * FREQUENT > rows).select("digest").join(stored, "digest")
    # Rows whose count is known from the broadcast table need no partner: they go anywhere.
    anywhere = F.concat(F.lit(b"known"), F.monotonically_increasing_id().cast("string").cast("binary"))
    return (
        df.select(*(F.col(f"`{c}`") for c in columns), key.alias(digest))
        .join(F.broadcast(often.select(F.col("digest").alias(digest), F.col("n_tokens").alias(known))), digest, "left")
        .withColumn(place, F.when(F.col(known).isNull(), F.col(digest)).otherwise(anywhere))
        .join(stored.select(F.col("digest").alias(place), F.col("n_tokens").alias(output)), place, "left")
        .select(*(F.col(f"`{c}`") for c in columns), F.coalesce(F.col(known), F.col(f"`{output}`")).alias(output))
    )

"""Importance resampling towards a target: documents drawn by how their hashed n-grams resemble it.

Counts of hashed n-grams give each bucket a gain, the log ratio of its share in the target to its
share in the documents. A document's weight is the mean gain of its n-grams; with Gumbel noise
added, the highest scores are a draw without replacement. The cutoff is found exactly by weighted
median-of-medians selection over the staged keys, so only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from xmlindex.operators.ranking import with_positions
from xmlindex.session import materialize

# Bytes of a text that are split at a time, words a worker remembers, and keys of one median.
BLOCK_BYTES = 1 << 20
HELD_WORDS = 1 << 17
GROUP_KEYS = 1 << 16

# A word is a run of digits, letters and anything beyond ASCII; A-Z become a-z.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Resampling:
    """n-grams up to `longest` words, hashed into `buckets`; of documents with at least
    `least_words` words, `percent` in a hundred are drawn with noise from `seed`."""

    longest: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


def word_blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, a block at a time; blocks end between words."""
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        block = data[start:end].translate(_FOLDED)
        while end < len(data) and not block.endswith(b" "):
            more = data[end:end + size].translate(_FOLDED)
            cut = more.find(b" ")
            taken = len(more) if cut < 0 else cut + 1
            block, end = block + more[:taken], end + taken
        yield block.split()
        start = end


class _Buckets(dict):
    """The bucket of an n-gram, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= HELD_WORDS:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def feature_blocks(data: bytes, longest: int, buckets: _Buckets) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the n-grams that end in them) of each block of a text."""
    tail: list[bytes] = []
    for words in word_blocks(data):
        found = [np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))]
        around = tail + words
        for length in range(2, longest + 1):
            first = max(0, len(tail) - length + 1)
            grams = [b" ".join(around[i:i + length]) for i in range(first, len(around) - length + 1)]
            found.append(np.fromiter(map(buckets.__getitem__, grams), np.int64, len(grams)))
        tail = around[max(0, len(around) - longest + 1):] if longest > 1 else []
        yield len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, how: Resampling, text: str = "text") -> np.ndarray:
    """How many n-grams of all texts fall into each bucket: one bounded array at the driver."""
    longest, size = how.longest, how.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = _Buckets(size), np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column(0):
                for _, found in feature_blocks(data.as_py(), longest, buckets):
                    total += np.bincount(found, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    parts = texts.select(_bytes(text).alias("data")).mapInArrow(count, "bucket int, n long")
    counts = np.zeros(size, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")


def bucket_gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each of B buckets."""
    size = len(source)
    above, below = float(int(source.sum()) + size), float(int(target.sum()) + size)
    return [
        math.floor(1000 * math.log(float(t + 1) * above / (float(s + 1) * below)))
        for s, t in zip(source.tolist(), target.tolist())
    ]


def noise(seed: int, name: str) -> int:
    """Gumbel noise of a document in thousandths, from a digest of its id."""
    drawn = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _scored(documents: DataFrame, gains: list[int], how: Resampling, id: str, text: str) -> DataFrame:
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != text)).alias("kept"),
        F.col(f"`{id}`").cast("long").alias("name"), _bytes(text).alias("data"),
    )
    longest, size, seed = how.longest, how.buckets, how.seed

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, table = _Buckets(size), np.array(gains, np.int64)
        for batch in batches:
            found = []
            for name, data in zip(batch.column("name").to_pylist(), batch.column("data")):
                n_words = n_features = total = 0
                for words, block in feature_blocks(data.as_py(), longest, buckets):
                    n_words, n_features, total = n_words + words, n_features + len(block), total + int(table[block].sum())
                weight = total // n_features if n_features else 0
                found.append((n_words, n_features, weight, weight + noise(seed, "" if name is None else str(name))))
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), batch.column("name"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["kept", "name", "n_words", "n_features", "weight", "score"],
            )

    numbers = [T.StructField(c, T.LongType()) for c in ("name", "n_words", "n_features", "weight", "score")]
    return rows.mapInArrow(score, T.StructType([rows.schema["kept"], *numbers]))


# The order of a draw: rising in these columns, and no two rows are equal in all.
_KEY = ["falling", "nameless", "named", "row"]
_SUMMARY = [f"{side}_{c}" for side in ("low", "high") for c in ["size", *_KEY]]


def _median(keys: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """The lower (weighted) median of rows of keys."""
    order = np.lexsort(keys.T[::-1])
    if weights is None:
        return keys[order[(len(order) - 1) // 2]]
    sums = np.cumsum(weights[order])
    return keys[order[np.searchsorted(sums, -(-int(sums[-1]) // 2))]]


def _before(keys: np.ndarray, bound: tuple | None) -> np.ndarray:
    """Which rows come before `bound`."""
    less, equal = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    for n, value in enumerate(bound):
        less |= equal & (keys[:, n] < value)
        equal &= keys[:, n] == value
    return less


class _Side:
    """Medians of the keys on one side of the pivot, group by group."""

    def __init__(self) -> None:
        self.waiting: list[np.ndarray] = []
        self.medians: list[np.ndarray] = []
        self.sizes: list[int] = []

    def add(self, keys: np.ndarray, last: bool = False) -> None:
        if len(keys):
            self.waiting.append(keys)
        size = sum(map(len, self.waiting))
        if size >= GROUP_KEYS or last and size:
            self.medians.append(_median(np.concatenate(self.waiting)))
            self.sizes.append(size)
            self.waiting = []

    def summary(self) -> list[int]:
        self.add(np.empty((0, len(_KEY)), np.int64), last=True)
        if not self.sizes:
            return [0, *[0] * len(_KEY)]
        return [sum(self.sizes), *_median(np.stack(self.medians), np.array(self.sizes)).tolist()]


def _round(keys: DataFrame, low: tuple | None, pivot: tuple | None, high: tuple | None) -> list:
    """Per partition: size and median of the keys between `low` and `pivot`, and `pivot` and `high`."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, upper = _Side(), _Side()
        for batch in batches:
            held = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in _KEY], axis=1)
            if high is not None:
                held = held[_before(held, high)]
            if low is not None:
                held = held[~_before(held, (*low[:-1], low[-1] + 1))]
            first = _before(held, pivot) if pivot is not None else np.zeros(len(held), bool)
            lower.add(held[first])
            after = ~first if pivot is None else ~_before(held, (*pivot[:-1], pivot[-1] + 1))
            upper.add(held[after])
        found = lower.summary() + upper.summary()
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in found], names=_SUMMARY)

    return keys.select(*_KEY).mapInArrow(summarise, ", ".join(f"{c} long" for c in _SUMMARY)).collect()


def cutoff_key(keys: DataFrame, wanted: int) -> tuple | None:
    """The `wanted`-th smallest key of a written table, None if `wanted` is 0.

    Each round takes the weighted median of the partitions' medians as pivot. A partition's median
    is that of its groups' medians, so at least an eighth of the remaining keys lies on either
    side and one side is discarded for certain. One job a round counts both sides and finds
    their medians; a partition sends two keys and two counts.
    """
    if wanted <= 0:
        return None
    low = pivot = high = None
    taken = 0
    while True:
        rows = _round(keys, low, pivot, high)
        sizes = {side: sum(r[f"{side}_size"] for r in rows) for side in ("low", "high")}
        side = "high"
        if pivot is not None:
            before = taken + sizes["low"]
            if before + 1 == wanted:
                return pivot
            if before >= wanted:
                high, side = pivot, "low"
            else:
                low, taken = pivot, before + 1
        if sizes[side] == 0:
            raise ValueError(f"fewer than {wanted} keys")
        held = [r for r in rows if r[f"{side}_size"]]
        medians = np.array([[r[f"{side}_{c}"] for c in _KEY] for r in held], np.int64)
        pivot = tuple(int(v) for v in _median(medians, np.array([r[f"{side}_size"] for r in held])))


def resample(
    documents: DataFrame, target: DataFrame, how: Resampling = Resampling(), id: str = "doc_id", text: str = "text",
    target_text: str = "text", output: str = "resampling",
) -> DataFrame:
    """All documents without their text, and a struct `output` with `n_words`, `n_features`,
    `weight`, `score` and `rank`, which is null for those not drawn.

    Ids are integers. Ties in score go to the smaller id, a null id last (its noise is that of an
    empty name); repeated rows each take part, in the order of the staged table. Null and empty
    texts have no n-grams and weight 0. An empty target gives every bucket T = t = 0; without
    documents the result is empty. A column named like `output` is replaced; other columns stay.
    Texts are read twice, to count and to score; afterwards only ids and numbers move.
    """
    documents = documents.drop(output)
    gains = bucket_gains(bucket_counts(documents, how, text), bucket_counts(target, how, target_text))
    scored = _scored(documents, gains, how, id, text)
    # Written before it is read again, the number of a row never changes.
    staged = materialize(
        scored.select(
            "kept", "n_words", "n_features", "weight", "score",
            (-F.col("score")).alias("falling"), F.col("name").isNull().cast("long").alias("nameless"),
            F.coalesce("name", F.lit(0)).alias("named"), F.monotonically_increasing_id().alias("row"),
        ),
        "resampling",
    )
    eligible = staged.where(F.col("n_words") >= how.least_words)
    cutoff = cutoff_key(eligible, how.percent * eligible.count() // 100)
    drawn = F.lit(False)
    if cutoff is not None:
        bound = F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip(_KEY, cutoff)))
        drawn = (F.col("n_words") >= how.least_words) & (F.struct(*_KEY) <= bound)
    numbers = ["n_words", "n_features", "weight", "score"]

    def finished(rows: DataFrame, rank: Column) -> DataFrame:
        return rows.select("kept.*", F.struct(*numbers, rank.alias("rank")).alias(output))

    rest = finished(staged.where(~drawn), F.lit(None).cast("long"))
    if cutoff is None:
        return rest
    winners = with_positions(staged.where(drawn), *_KEY)
    return finished(winners, F.col("position").cast("long")).unionByName(rest)

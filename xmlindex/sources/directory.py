"""An extendible hash directory: which bucket a document's rows are in.

A table of 2^depth slots, one for each beginning of a document's hash, names the buckets. A bucket
that is too full is split by the next bit of the hash; the others keep their slots, and the table
doubles only when the deepest bucket splits.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, functions as F

# Slots are literals of a plan and lines of a manifest, so the table stays small.
DEEPEST = 17


def slot_of(depth: int, *key: str) -> Column:
    """The first `depth` bits of the hash of a document key."""
    if depth == 0:
        return F.lit(0)
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - depth).cast("int")


@dataclass(frozen=True)
class Directory:
    depth: int = 0
    slots: tuple[int, ...] = (0,)

    def bucket(self, *key: str) -> Column:
        if len(set(self.slots)) == 1:
            return F.lit(self.slots[0])
        return F.get(F.array(*(F.lit(b) for b in self.slots)), slot_of(self.depth, *key))

    def split(self, counts: dict[int, tuple[int, int]], depth: int, capacity: int) -> Directory:
        """The directory after splitting every bucket of more than `capacity` rows.

        `counts` has rows and documents by the first `depth` bits, at least as many as the
        directory's. A bucket with one document cannot be split.
        """
        fine = [self.slots[slot >> (depth - self.depth)] for slot in range(1 << depth)]
        following = max(fine) + 1

        def divide(low: int, high: int) -> None:
            """Split the bucket that has the slots from `low` to `high` of the fine table."""
            nonlocal following
            rows = sum(counts.get(slot, (0, 0))[0] for slot in range(low, high))
            documents = sum(counts.get(slot, (0, 0))[1] for slot in range(low, high))
            if rows <= capacity or documents <= 1 or high - low == 1:
                return
            middle = (low + high) // 2
            fine[middle:high] = [following] * (high - middle)
            following += 1
            divide(low, middle)
            divide(middle, high)

        start = 0
        while start < len(fine):
            end = start
            while end < len(fine) and fine[end] == fine[start]:
                end += 1
            divide(start, end)
            start = end
        needed = depth
        while needed > self.depth and fine[0::2] == fine[1::2]:
            fine, needed = fine[0::2], needed - 1
        return Directory(needed, tuple(fine))

    def to_text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_text(cls, text: str) -> Directory:
        raw = json.loads(text)
        return cls(raw["depth"], tuple(raw["slots"]))

"""Near-duplicate groups from bottom-k sketches of one hash function."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from xmlindex.llm.bpe import arrow_rows, slices
from xmlindex.llm.components import connected_components
from xmlindex.llm.support import held, unused, whole_text
from xmlindex.session import materialize

_CACHED_WORDS = 200_000
# Entries that one batch of inverted lists may have.
_ENTRIES = 100_000
# 64-bit words of a set's parities.
_PARITY_WORDS = 16


@dataclass(frozen=True)
class Sketching:
    """What counts as near, and how candidates are found.

    Two texts are linked if 100 * intersection >= percent * union of their shingle sets.
    """

    words: int = 5
    percent: int = 80
    # Values a sketch retains.
    retained: int = 64
    # Retained values that make up the key of an inverted list.
    per_key: int = 2
    # Chance that a pair just at the limit shares no list, at most; sets the number of lists.
    missed: float = 1e-6
    # Every list gives the pairs of its hub. Where these leave it in parts and all but so many of
    # its texts are in one part, the others give their pairs; else rare shingles decide on pairs.
    few: int = 16
    # Standard deviations of the sketch's estimate that a pair may fall short by and still be
    # verified.
    deviations: float = 6.0

    @property
    def limit(self) -> float:
        return self.percent / 100

    @property
    def lists(self) -> int:
        """The fewest lists a sketch has to be entered in for `missed` to hold."""
        if self.loss(10_000) > self.missed:
            raise ValueError("sketches retain too few values for so small a chance of missing a pair")
        return next(n for n in range(1, 10_001) if self.loss(n) <= self.missed)

    def loss(self, lists: int) -> float:
        """The chance that a pair at the limit shares none of so many lists, where one contains the other.

        Of the larger set's sketch, each value is in the smaller set with a chance of `limit`, and then
        in its sketch too. All lists of a pair depend on how many are. Sets of equal size share more.
        """
        r, loss = self.retained, 0.0
        for common in range(r + 1):
            chance = math.comb(r, common) * self.limit**common * (1 - self.limit) ** (r - common)
            alike = math.prod(max(0, common - i) / (2 * r - common - i) for i in range(self.per_key))
            loss += chance * (1 - alike) ** lists
        return loss

    @staticmethod
    def similarity_at(sizes: Column, differences: Column) -> Column:
        """The similarity of two sets by the sum of their sizes and the size of their difference."""
        return (sizes - differences) / (sizes + differences)

    def possible(self, x: str, y: str) -> Column:
        """May the sets of two rows be linked, by their sizes and parities? Never false for linked ones."""
        n_x, n_y = F.col(f"{x}n_shingles"), F.col(f"{y}n_shingles")
        return (100 * F.least(n_x, n_y) >= self.percent * F.greatest(n_x, n_y)) & (
            (100 + self.percent) * _differences(x, y) <= (100 - self.percent) * (n_x + n_y)
        )

    @property
    def estimate_floor(self) -> float:
        return self.limit - self.margin

    @property
    def margin(self) -> float:
        return self.deviations * (self.limit * (1 - self.limit) / self.retained) ** 0.5


class _Words(dict):
    """Word hashes, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The hashes of the distinct shingles of a text, ascending.

    Words are runs of other than ASCII white space, with A-Z in lower case. A shingle is `words`
    words in a row; fewer words are one shingle; no words are none.
    """
    known = held(("word hashes",), _Words)
    hashes = np.fromiter(map(known.__getitem__, (text or "").encode().lower().split()), np.uint64)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    rolled = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        rolled = _mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - width + 1 + i])
    return np.unique(rolled)


def _permuted(values: np.ndarray, seed: int) -> np.ndarray:
    return _mix(values ^ _mix(np.array([seed + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0])


def list_keys(sketches: list[np.ndarray], lists: int, per_key: int) -> np.ndarray:
    """The inverted lists that each sketch is entered in, one row per sketch.

    A list's key is made of the `per_key` retained values that come first in the list's own order
    of values, so two sketches share a list if they retain the same ones there.
    """
    filler = np.uint64(0xFFFFFFFFFFFFFFFF)
    width = max([per_key, *map(len, sketches)])
    values = np.full((len(sketches), width), filler)
    for row, sketch in zip(values, sketches):
        row[: len(sketch)] = sketch
    missing = values == filler
    keys = np.empty((len(sketches), lists), np.uint64)
    for j in range(lists):
        order = _permuted(values, j)
        order[missing] = filler
        first = np.sort(np.partition(order, per_key - 1, axis=1)[:, :per_key], axis=1)
        key = np.full(len(sketches), j + 1, np.uint64)
        for i in range(per_key):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + first[:, i])
        keys[:, j] = key
    return keys


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.view(np.int64) for r in rows], pa.list_(pa.int64()))


def _node(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def parities(shingles: np.ndarray) -> np.ndarray:
    """Bits that say of each slot of hashes whether an odd number of the shingles falls there.

    Where two sets' bits differ, some shingle is in one set only, so the count of such bits is at
    most the size of their symmetric difference. It holds for sets of any size, and comes close
    as long as the sets differ in fewer shingles than there are bits.
    """
    bits = 64 * _PARITY_WORDS
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differences(x: str, y: str) -> Column:
    """How many shingles the sets of two rows differ in, at least."""
    return sum(
        (F.bit_count(F.col(f"{x}parity")[i].bitwiseXOR(F.col(f"{y}parity")[i])) for i in range(_PARITY_WORDS)), F.lit(0)
    ).cast("long")


def sketch_texts(df: DataFrame, how: Sketching) -> DataFrame:
    """doc_id, mark, node (a digest of the shingle set), n_shingles, sketch and parity of rows of doc_id, mark, text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_hashes(t, how.words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("mark"),
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _lists([s[: how.retained] for s in sets]),
                    _lists([parities(s) for s in sets]),
                ],
                names=["doc_id", "mark", "node", "n_shingles", "sketch", "parity"],
            )

    return df.select("doc_id", "mark", "text").mapInArrow(
        sketch, "doc_id long, mark long, node binary, n_shingles long, sketch array<long>, parity array<long>"
    )


def _enter(rows: DataFrame, lists: int, per_key: int) -> DataFrame:
    """key, node: the inverted lists of rows of (node, sketch)."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, _ENTRIES // lists)
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                sketches = [x.view(np.uint64) for x in arrow_rows(batch.column("sketch"))]
                keys = list_keys(sketches, lists, per_key).reshape(-1).view(np.int64)
                owner = pa.array(np.repeat(np.arange(batch.num_rows), lists))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), batch.column("node").take(owner)], names=["key", "node"]
                )

    return rows.select("node", "sketch").mapInArrow(enter, "key long, node binary")


def _members(entries: DataFrame) -> DataFrame:
    """key, hub, node, a, b: the lists of two nodes or more, each with a hub; a and b are hub and node
    in order.

    The hub is the node that meets most others in all its lists. In a group of copies that is one
    close to what they were copied from, so that its pairs join most of the group.
    """
    several = (
        entries.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("n"))
        .where(F.col("first") < F.col("last")).select("key", "n")
    )
    listed = materialize(entries.join(several, "key"), "listed")
    met = listed.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = (
        listed.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("hub"))
        .select("key", F.col("hub.node").alias("hub"))
    )
    return materialize(
        listed.join(hubs, "key").where(F.col("node") != F.col("hub")).select(
            "key", "hub", "node", F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")
        ),
        "members",
    )


def _shingle_sets(df: DataFrame, how: Sketching, wanted: DataFrame) -> DataFrame:
    """node, shingles: the full sets of the wanted (doc_id, node)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingle_hashes(t, how.words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in found], pa.binary()), _lists(found)], names=["node", "shingles"]
            )

    ids = wanted.select("doc_id").distinct()
    rows = df.alias("d").join(ids.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")), "left_semi")
    found = rows.select("text").mapInArrow(sets, "node binary, shingles array<long>")
    return (
        found.groupBy("node").agg(F.max("shingles").alias("shingles")).join(wanted.select("node"), "node", "left_semi")
    )


def _estimate(retained: int):
    """The similarity that two sketches give: the share of the union's sketch that both retain."""

    @F.pandas_udf("double")
    def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
        def of(x: np.ndarray, y: np.ndarray) -> float:
            x, y = np.asarray(x, np.int64).view(np.uint64), np.asarray(y, np.int64).view(np.uint64)
            union = np.union1d(x, y)[:retained]
            return np.isin(union, np.intersect1d(x, y, assume_unique=True), assume_unique=True).sum() / max(1, len(union))

        return pd.Series([of(x, y) for x, y in zip(a, b)], dtype="float64")

    return estimate


class _Search:
    """The links between distinct shingle sets; every step is written."""

    def __init__(self, df: DataFrame, nodes: DataFrame, how: Sketching):
        self.df, self.nodes, self.how = df, nodes, how
        self.verdicts: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> DataFrame:
        """a, b, linked, low, high: whether pairs are linked, and bounds of their distance.

        Sizes, parities and the estimate from the sketches rule out what lies far below the limit;
        the rest is decided on the full sets.
        """
        how = self.how
        side = lambda name: self.nodes.select(
            F.col("node").alias(name), F.col("n_shingles").alias(f"n_{name}"),
            F.col("sketch").alias(f"sketch_{name}"), F.col("doc_id").alias(f"doc_{name}"),
            F.col("parity").alias(f"{name}_parity"),
        )
        sizes = F.least("n_a", "n_b") / F.greatest("n_a", "n_b")
        apart = _differences("a_", "b_")
        judged = materialize(
            pairs.join(side("a"), "a").join(side("b"), "b")
            .withColumn("estimate", _estimate(how.retained)("sketch_a", "sketch_b"))
            .select(
                "a", "b", "n_a", "n_b", "doc_a", "doc_b", "estimate",
                F.least(sizes, how.similarity_at(F.col("n_a") + F.col("n_b"), apart)).alias("most"),
            )
            .withColumn("near", (F.col("estimate") >= how.estimate_floor) & (F.col("most") >= how.limit - 1e-9)),
            "judged",
        )
        near = judged.where("near")
        wanted = materialize(
            near.select(F.col("a").alias("node"), F.col("doc_a").alias("doc_id"))
            .union(near.select(F.col("b").alias("node"), F.col("doc_b").alias("doc_id"))).distinct(),
            "wanted",
        )
        sets = materialize(_shingle_sets(self.df, how, wanted), "sets")
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        exact = (
            near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("shingles_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("shingles_a")), "a")
            .select("a", "b", common.cast("long").alias("common"), (F.col("n_a") + F.col("n_b")).alias("sum"))
            .select("a", "b", "common", (F.col("sum") - F.col("common")).alias("union"))
            .select(
                "a", "b", (100 * F.col("common") >= how.percent * F.col("union")).alias("linked"),
                (1 - F.col("common") / F.col("union")).alias("low"), (1 - F.col("common") / F.col("union")).alias("high"),
            )
        )
        far = judged.where("not near").select(
            "a", "b", F.lit(False).alias("linked"),
            F.greatest(1 - F.col("estimate") - how.margin, 1 - F.col("most"), F.lit(0.0)).alias("low"),
            F.lit(1.0).alias("high"),
        )
        return materialize(exact.unionByName(far), "verdicts")

    def links(self) -> DataFrame:
        how, nodes = self.how, self.nodes.where("n_shingles > 0")
        members = _members(_enter(nodes, how.lists, how.per_key))
        self.verdicts = self.verify(materialize(members.select("a", "b").distinct(), "pairs"))
        roots = connected_components(self.verdicts.where("linked"))
        open_ = self.still_open(members, roots)
        pairs = self.of_strays(open_.where(F.col("strays") <= how.few)).unionByName(
            self.of_rare_shingles(open_.where((F.col("strays") > how.few) & F.col("undecided")))
        )
        fresh = materialize(pairs.distinct().join(self.verdicts, ["a", "b"], "left_anti"), "pairs")
        if fresh.isEmpty():
            return roots
        found = self.verify(fresh)
        return connected_components(self.verdicts.unionByName(found).where("linked"))

    def of_strays(self, lists: DataFrame) -> DataFrame:
        """a, b: each stray of a list with its nodes of other parts that it may be linked with.

        At most `few` strays meet a node, and only pairs that sizes and parities allow are made.
        """
        rows = lists.join(self.nodes.select("node", "n_shingles", "parity"), "node")
        stray = rows.where(F.col("root") != F.col("main"))
        return stray.alias("x").join(rows.alias("y"), "key").where(
            (F.col("x.root") != F.col("y.root"))
            & ((F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
            & self.how.possible("x.", "y.")
        ).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    def with_parts(self, lists: DataFrame) -> DataFrame:
        """`lists` in several parts, with the root of the largest part and how many nodes lie outside it."""
        sizes = lists.groupBy("key", "root").agg(F.count("*").alias("size"))
        parts = sizes.groupBy("key").agg(
            F.max(F.struct("size", "root")).alias("largest"), F.sum("size").alias("n")
        ).select("key", F.col("largest.root").alias("main"), (F.col("n") - F.col("largest.size")).alias("strays"))
        return lists.join(parts.where("strays > 0"), "key")

    def still_open(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """key, node, root, undecided, main, strays: the nodes but the hub of lists in several parts.

        A node linked with the hub needs no further pair if every node outside the hub's part is
        farther from the hub than it by more than a link may span (Jaccard distance is a metric).
        """
        root = lambda name, as_: roots.select(F.col("node").alias(name), F.col("root").alias(as_))
        rows = (
            members.join(self.verdicts.select("a", "b", "low", "high"), ["a", "b"], "left")
            .join(root("node", "node_root"), "node", "left").join(root("hub", "hub_root"), "hub", "left")
            .select(
                "key", "node", F.coalesce("node_root", "node").alias("root"),
                (F.coalesce("node_root", "node") != F.coalesce("hub_root", "hub")).alias("outside"),
                F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(1.0)).alias("high"),
            )
        )
        outside = rows.groupBy("key").agg(F.min(F.when(F.col("outside"), F.col("low"))).alias("nearest")).where(
            F.col("nearest").isNotNull()
        )
        reach = 1 - self.how.limit
        undecided = F.col("outside") | (F.col("high") >= F.col("nearest") - reach - 1e-9)
        lists = rows.join(outside, "key").select("key", "node", "root", undecided.alias("undecided"))
        return materialize(self.with_parts(materialize(lists, "lists")), "open")

    def of_rare_shingles(self, lists: DataFrame) -> DataFrame:
        """a, b: the pairs of strays that may be linked at all, from lists with many strays.

        Shingles are put in order of how few nodes of the lists hold them. Two linked sets share
        one of the first n - ceil(limit * n) + 1 shingles of each, so only those are looked up, and
        from the first that they share on, both have room for enough common ones. Sizes and
        parities have to allow a link too before a pair is made. A stray differs from the rest of
        its list, mostly in shingles that hardly any other has.
        """
        pool = materialize(
            lists.groupBy("node").agg(F.min("root").alias("root"), F.max(F.col("root") != F.col("main")).alias("stray"))
            .join(self.nodes.select("node", "doc_id", "n_shingles", "parity"), "node"),
            "pool",
        )
        held = materialize(
            _shingle_sets(self.df, self.how, pool.select("node", "doc_id")).select("node", F.explode("shingles").alias("shingle")),
            "shingles",
        )
        common = held.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
        of_node = Window.partitionBy("node")
        n = F.col("n_shingles")
        least = F.ceil(n * self.how.percent / 100)
        # Shingles that one node alone holds come first and lead nowhere.
        alone = n - F.count("*").over(of_node)
        place = alone + F.row_number().over(of_node.orderBy("holders", "shingle"))
        first = materialize(
            held.join(common, "shingle").join(pool, "node")
            .select("shingle", "node", "root", "stray", "n_shingles", "parity", place.alias("place"), (place <= n - least + 1).alias("early"))
            .where("early").drop("early"),
            "rare",
        )
        # What two nodes share comes no earlier than the first shingle that they share, in both.
        left = lambda side: F.col(f"{side}.n_shingles") - F.col(f"{side}.place") + 1
        most = F.least(left("x"), left("y"))
        room = 100 * most >= self.how.percent * (F.col("x.n_shingles") + F.col("y.n_shingles") - most)
        return first.where("stray").alias("x").join(first.alias("y"), "shingle").where(
            (F.col("x.node") != F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & room
            & self.how.possible("x.", "y.")
        ).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def near_duplicates(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", how: Sketching = Sketching()
) -> DataFrame:
    """One row per row of `df`: doc_id, mark, n_shingles, root, component_id, kept.

    `id` is an integer. `mark` is the 64-bit hash of the text, which tells rows of one id apart.
    `root` tells groups apart, also those without an id or whose smallest ids are equal.
    Two documents are linked if the Jaccard similarity of their whole shingle sets reaches the
    limit; `component_id` is the smallest id reachable over links, and `kept` says that it is the
    document's own.

    Each document's shingles are hashed with one function and the smallest values retained. Equal
    sets are one node from then on. Every sketch is entered in inverted lists under keys of
    retained values. A list gives the pairs of its hub, so a group of near copies costs a
    pair per node. If these pairs leave a list in several parts, the few texts outside its largest
    part give their other pairs; where they are many, only pairs that share a rare shingle. Pairs are estimated on the sketch of their union, and those that may
    reach the limit are decided on the full sets.

    Null text, empty text and text without words: no shingles, linked with nothing, kept.
    Null id: linked like any other, never the id of a group that has another one. Ties and
    repeated rows: equal texts are in one group; rows of the smallest id are all kept. An empty
    table gives an empty table. Other columns are ignored.
    """
    source = df.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
        F.xxhash64(whole_text(f"`{text}`")).alias("mark"),
    )
    rows = materialize(sketch_texts(source, how), "sketches")
    nodes = materialize(
        rows.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"),
            F.max("parity").alias("parity"),
        ),
        "nodes",
    )
    roots = _Search(source, nodes, how).links()
    smallest = (
        roots.join(nodes.select("node", "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    )
    of_node = nodes.join(roots, "node", "left").join(smallest, "root", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("smallest", "doc_id").alias("smallest")
    )
    component = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return rows.join(of_node, "node").select(
        "doc_id", "mark", "n_shingles", "root", component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_duplicates(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", how: Sketching = Sketching()
) -> DataFrame:
    """The rows of `df` of which one per group stays: the one with the smallest id.

    Rows without words all stay. Of rows that share the smallest id of a group, the one whose
    text has the smallest hash stays, and of equal ones any. Groups are told apart by their root,
    so those that share an id, or have none, keep a row each.
    """
    found = materialize(near_duplicates(df, id=id, text=text, how=how).where("n_shingles > 0"), "verdicts")
    chosen = found.where("kept").groupBy("root").agg(F.min("mark").alias("chosen"))
    # Few rows are left to act on: those that go, and those that stay once but were repeated.
    several = found.groupBy("doc_id", "mark", "root", "kept").agg(F.count("*").alias("n")).join(chosen, "root")
    stays = F.col("kept") & (F.col("mark") == F.col("chosen"))
    acts = materialize(
        several.where(~stays | (F.col("n") > 1)).groupBy("doc_id", "mark").agg(F.max(stays).alias("once")), "acts"
    )
    names = {n: unused(df.columns, n) for n in ("_id", "_mark", "_once")}
    side = acts.select(
        F.col("doc_id").alias(names["_id"]), F.col("mark").alias(names["_mark"]), F.col("once").alias(names["_once"])
    )
    joined = df.join(
        side,
        F.col(f"`{id}`").cast("long").eqNullSafe(F.col(names["_id"]))
        & (F.xxhash64(whole_text(f"`{text}`")) == F.col(names["_mark"])),
        "left",
    )
    columns = [F.col(f"`{c}`") for c in df.columns]
    untouched = joined.where(F.col(names["_once"]).isNull()).select(*columns)
    repeated = joined.where(F.col(names["_once"])).dropDuplicates([names["_id"], names["_mark"]]).select(*columns)
    return untouched.unionByName(repeated)

"""Best-fit packing of documents into sequences (grouping genetic algorithm).

How documents pack depends on their lengths alone, and there are at most as many lengths as a
sequence has tokens. So a packing is a list of patterns, each a way to fill one sequence (so many
pieces of these lengths) with the number of sequences filled that way. Islands search over such
packings, whatever the number of documents; pieces are then given their places by their position
among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from xmlindex.llm.bpe import arrow_rows, encode_texts, slices
from xmlindex.session import materialize

# A pattern: pieces as (length, how many), longest first.
Pattern = tuple[tuple[int, int], ...]
Packing = dict[Pattern, int]


@dataclass(frozen=True)
class Evolution:
    islands: int = 6
    population: int = 6
    # The search ends when it has as few sequences as the tokens need, or after so many epochs
    # that did not save one.
    stall: int = 2
    generations: int = 6
    migrants: int = 1
    seed: int = 7


def used(pattern: Pattern) -> int:
    return sum(length * n for length, n in pattern)


def n_sequences(packing: Packing) -> int:
    return sum(packing.values())


def fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer sequences first, then fuller ones (mean square fill), larger is better."""
    total = n_sequences(packing)
    fill = sum(m * (used(p) / capacity) ** 2 for p, m in packing.items())
    return -total, fill / max(1, total)


def best_fit(
    counts: dict[int, int], capacity: int, open_: Packing | None = None, rng: Random | None = None, slip: float = 0.0
) -> Packing:
    """Pack pieces by best fit, longest first: every sequence takes the longest piece that still fits.

    `open_` are sequences begun already. Equal sequences are filled together, so each step uses
    up a length or all equal sequences. With `slip`, a choice goes to the next shorter length by
    chance, which gives other packings of the same kind.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    todo = sorted((open_ or {}).items(), key=lambda x: (-used(x[0]), x[0]))
    done: Packing = {}

    def fill(pattern: Pattern, times: int) -> None:
        """Fill `times` sequences that begin as `pattern`; what differs is put aside."""
        held = Counter(dict(pattern))
        room = capacity - used(pattern)
        while room > 0 and lengths:
            at = bisect_right(lengths, room) - 1
            if at < 0:
                break
            if rng is not None and at > 0 and rng.random() < slip:
                at -= 1
            length = lengths[at]
            have = left[length]
            each = min(room // length, max(1, have // times))
            if have < times:
                # Only `have` of these sequences get one; the others go on without.
                todo.append((tuple(sorted(held.items(), reverse=True)), times - have))
                times = have
                each = 1
            held[length] += each
            room -= each * length
            left[length] = have - each * times
            if not left[length]:
                del left[length]
                lengths.pop(at)
        key = tuple(sorted(held.items(), reverse=True))
        done[key] = done.get(key, 0) + times

    while todo or lengths:
        if todo:
            pattern, times = todo.pop(0)
        else:
            pattern, times = (), left[lengths[-1]] if rng is None or rng.random() >= slip else max(1, left[lengths[-1]] // 2)
            length = lengths[-1]
            left[length] -= times
            if not left[length]:
                del left[length]
                lengths.pop()
            pattern = ((length, 1),)
        fill(pattern, times)
    return done


def crossover(mother: Packing, father: Packing, counts: dict[int, int], capacity: int, rng: Random) -> Packing:
    """Inject well-filled sequences of the father into the mother.

    The father's fullest patterns come in whole. Pieces are then there twice, so the mother's
    sequences that hold one of them go, emptiest first kept out; their other pieces are displaced
    and packed again by best fit.
    """
    fullest = sorted(father, key=lambda p: (-used(p), rng.random()))
    injected: Packing = {}
    share = rng.uniform(0.2, 0.8) * n_sequences(father)
    for pattern in fullest:
        if share <= 0:
            break
        if rng.random() < 0.7:
            injected[pattern] = father[pattern]
            share -= father[pattern]
    left = Counter(counts)
    for pattern, times in injected.items():
        for length, n in pattern:
            left[length] -= n * times
    child = dict(injected)
    # Of the mother's sequences, as many stay as the remaining pieces allow, fullest first.
    for pattern in sorted(mother, key=lambda p: (-used(p), rng.random())):
        if not pattern:
            continue
        times = min(mother[pattern], *(left[length] // n for length, n in pattern))
        if times > 0:
            child[pattern] = child.get(pattern, 0) + times
            for length, n in pattern:
                left[length] -= n * times
    return _repack(child, +left, capacity, rng)


def _repack(child: Packing, displaced: dict[int, int], capacity: int, rng: Random) -> Packing:
    """Best-fit the displaced pieces into the child's sequences that have room, then new ones."""
    full = {p: m for p, m in child.items() if used(p) == capacity}
    rest = {p: m for p, m in child.items() if used(p) < capacity}
    packed = best_fit(displaced, capacity, rest, rng, 0.02)
    for pattern, times in full.items():
        packed[pattern] = packed.get(pattern, 0) + times
    return packed


def mutate(packing: Packing, capacity: int, rng: Random) -> Packing:
    """Empty some of the worst filled sequences and pack their pieces again."""
    worst = sorted(packing, key=lambda p: (used(p), rng.random()))
    child = dict(packing)
    displaced: Counter = Counter()
    for pattern in worst[: max(1, len(worst) // 8)]:
        times = child.pop(pattern)
        for length, n in pattern:
            displaced[length] += n * times
    return _repack(child, displaced, capacity, rng)


def evolve(population: list[Packing], counts: dict[int, int], capacity: int, generations: int, rng: Random) -> list[Packing]:
    """Each generation the better half breeds and its children replace the worst."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    rank = lambda p: fitness(p, capacity)
    for _ in range(generations):
        population = sorted(population, key=rank, reverse=True)
        if n_sequences(population[0]) <= least:
            break
        parents = population[: max(2, len(population) // 2)]
        children = [
            mutate(crossover(*rng.sample(parents, 2), counts, capacity, rng), capacity, rng)
            for _ in range(len(population) - len(parents))
        ]
        population = parents + children
    return sorted(population, key=rank, reverse=True)


def _as_row(island: int, packing: Packing) -> dict:
    return {
        "island": island, "patterns": ["/".join(f"{a}x{b}" for a, b in p) for p in packing],
        "times": list(packing.values()),
    }


def _packing(patterns: list[str], times: list[int]) -> Packing:
    read = (tuple(tuple(map(int, x.split("x"))) for x in p.split("/")) for p in patterns)
    return {p: int(m) for p, m in zip(read, times)}


def find_packing(spark, counts: dict[int, int], capacity: int, how: Evolution = Evolution()) -> Packing:
    """The best packing found for so many pieces of each length.

    Islands evolve in parallel, in partitions by ranges of their numbers, which adaptive execution
    leaves apart; after every epoch each one's elite moves to the next island. Seeds depend on island
    and epoch alone, so a lost task gives the same again. The search ends at the lower bound or when
    `how.stall` epochs have not saved a sequence.
    """
    if not counts:
        return {}
    schema = "island int, patterns array<string>, times array<long>"

    def epoch(number: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            island = int(rows["island"].iloc[0])
            rng = Random(how.seed * 1_000_003 + island * 1009 + number)
            population = [
                _packing(p, t) for p, t in sorted((list(p), list(t)) for p, t in zip(rows["patterns"], rows["times"]))
                if len(p)
            ]
            while len(population) < how.population:
                slip = 0.0 if not population and island == 0 else rng.uniform(0.0, 0.15)
                population.append(best_fit(counts, capacity, rng=rng, slip=slip))
            population = evolve(population, counts, capacity, how.generations, rng)[: how.population]
            return pd.DataFrame([_as_row(island, p) for p in population])

        return run

    rank = Window.partitionBy("island").orderBy("n", "patterns")
    state = spark.createDataFrame([(i, [], []) for i in range(how.islands)], schema)
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    fewest, number, stalled = None, 0, 0
    while stalled < how.stall and fewest != least:
        dealt = state.repartitionByRange(how.islands, "island")
        state = materialize(dealt.groupBy("island").applyInPandas(epoch(number), schema), "islands")
        sequences = F.aggregate("times", F.lit(0).cast("long"), lambda a, b: a + b)
        ranked = state.withColumn("n", sequences).withColumn("rank", F.row_number().over(rank))
        elite = ranked.where(F.col("rank") <= how.migrants).withColumn("island", (F.col("island") + 1) % how.islands)
        state = ranked.select("island", "patterns", "times").union(elite.select("island", "patterns", "times"))
        best = ranked.orderBy("n", "island", "rank").first()
        stalled = 0 if fewest is None or best["n"] < fewest else stalled + 1
        fewest, number = best["n"], number + 1
    return _packing(best["patterns"], best["times"])


class Places:
    """Where the pieces of each length go: sequence and offset by position among them."""

    def __init__(self, packing: Packing):
        entries: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for pattern in sorted(packing, reverse=True):
            offset = 0
            for length, each in pattern:
                entries.setdefault(length, []).append((sequence, each, offset))
                offset += length * each
            sequence += packing[pattern]
        times = {}
        sequence = 0
        for pattern in sorted(packing, reverse=True):
            times[sequence] = packing[pattern]
            sequence += packing[pattern]
        self.tables = {}
        for length, rows in entries.items():
            first, each, offset = (np.array(c, np.int64) for c in zip(*rows))
            n = each * np.array([times[s] for s in first.tolist()], np.int64)
            self.tables[length] = (np.cumsum(n) - n, first, each, offset)

    def of(self, lengths: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty_like(positions), np.empty_like(positions)
        for length in np.unique(lengths):
            here = lengths == length
            start, first, each, offset = self.tables[int(length)]
            entry = np.searchsorted(start, positions[here], side="right") - 1
            within = positions[here] - start[entry]
            sequences[here] = first[entry] + within // each[entry]
            offsets[here] = offset[entry] + within % each[entry] * length
        return sequences, offsets


def pack(
    pieces: DataFrame, capacity: int, *, length: str = "length", how: Evolution = Evolution(), slice_rows: int = 20_000
) -> DataFrame:
    """Add `sequence_id` long and `offset` long: a place for every piece, gapless from 0.

    `pieces` has the `length` of each piece, from 1 to `capacity`, and should be a written table,
    as it is read twice. Only the number of pieces of each length goes to the driver, at most
    `capacity` rows. Pieces of a length are numbered in slices of bounded size with offsets, so a
    length that a third of all pieces have is spread over tasks.

    Null lengths and lengths out of range are an error. Ties and repeated rows: each piece has a
    place of its own. An empty table gives an empty table. Other columns are kept; ones called
    `sequence_id` or `offset` are replaced. Which of several pieces of one length takes which
    place has no meaning.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    rows = pieces.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("kept"), F.col(f"`{length}`").cast("long").alias("length")
    )
    found = rows.groupBy("length").agg(F.count("*").alias("n")).where(
        F.col("length").between(1, capacity) | F.raise_error(F.lit(f"a piece is not 1 to {capacity} long")).isNull()
    ).collect()
    counts = {r["length"]: r["n"] for r in found}
    places = Places(find_packing(spark, counts, capacity, how))
    slices = max(64, sum(counts.values()) // slice_rows)

    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("kept"), F.lit(slices)).cast("int"))
    sums = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("length", "slice").agg(F.count("*").alias("n"))
        .select("length", "slice", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("before"))
    )
    number = F.row_number().over(Window.partitionBy("length", "slice").orderBy(F.xxhash64("kept")))
    numbered = dealt.withColumn("number", number).join(before, ["length", "slice"]).select(
        "kept", "length", (F.col("before") + F.col("number") - 1).alias("position")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequences, offsets = places.of(
                    batch.column("length").to_numpy(zero_copy_only=False), batch.column("position").to_numpy(zero_copy_only=False)
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kept"), pa.array(sequences), pa.array(offsets)], names=["kept", "sequence_id", "offset"]
                )

    schema = numbered.select("kept", F.col("position").alias("sequence_id"), F.col("position").alias("offset")).schema
    placed = numbered.mapInArrow(place, schema)
    return placed.select(*(F.col("kept").getField(c).alias(c) for c in kept), "sequence_id", "offset")


def cut_pieces(encoded: DataFrame, capacity: int, *, ids: str = "ids", with_ids: bool = True) -> DataFrame:
    """The pieces of each document's ids: other columns, piece (from 0), start, length, ids_crc32, ids.

    Ids that fit into `capacity` are one piece; longer ones are cut into pieces of `capacity`, of
    which the first takes the remainder. Null or empty ids: no piece. `ids_crc32` is over the ids
    as little-endian unsigned 32-bit integers. Columns of these names are replaced.
    """
    made = {"piece", "start", "length", "ids_crc32", ids.lower()}
    kept = [c for c in encoded.columns if c.lower() not in made]
    rows = encoded.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("kept"),
        F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, numbers, starts, lengths, sums, parts = [], [], [], [], [], []
            for row, values in enumerate(arrow_rows(batch.column("ids"))):
                n = len(values)
                pieces = -(-n // capacity)
                first = n - capacity * (pieces - 1)
                for k in range(pieces):
                    start = 0 if k == 0 else first + capacity * (k - 1)
                    part = values[start:first + capacity * k]
                    owner.append(row)
                    numbers.append(k)
                    starts.append(start)
                    lengths.append(len(part))
                    sums.append(zlib.crc32(part.astype("<u4").tobytes()))
                    parts.append(part)
            columns = [
                batch.column("kept").take(pa.array(owner, pa.int64())), pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
            ]
            names = ["kept", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(parts, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    empty = rows.select(
        "kept", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("length"),
        F.lit(0).cast("long").alias("ids_crc32"), *(["ids"] if with_ids else []),
    )
    pieces = rows.mapInArrow(cut, empty.schema)
    return pieces.select(
        *(F.col("kept").getField(c).alias(c) for c in kept), "piece", "start", "length", "ids_crc32",
        *([F.col("ids").alias(ids)] if with_ids else []),
    )


def pack_texts(
    df: DataFrame, tokenizer: str, *, capacity: int = 1024, end_id: int = 2, text: str = "text",
    with_ids: bool = False, how: Evolution = Evolution(),
) -> DataFrame:
    """Pieces of the whole texts, encoded with `end_id` after each, and their places.

    Columns: those of `df` but the text, then piece, start, length, ids_crc32, sequence_id and
    offset; `with_ids` adds the ids. Null text: empty, so one piece of the end id alone.
    """
    others = [c for c in df.columns if c.lower() not in (text.lower(), "ids")]
    encoded = encode_texts(df, tokenizer, text=text, output="ids", carry=others)
    pieces = cut_pieces(encoded.withColumn("ids", F.concat("ids", F.array(F.lit(end_id)))), capacity, with_ids=with_ids)
    return pack(materialize(pieces, "pieces"), capacity, how=how)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, from packed pieces that carry their ids."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")
    )

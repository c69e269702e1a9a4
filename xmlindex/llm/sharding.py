"""Shards along a Hilbert curve over several metadata columns, for pruning in any of them.

Each column is quantised to equally filled steps, the steps of a row are a cell of a cube, and
the cells are visited along a Hilbert curve. Rows sorted by its index are cut into runs of equal
length: neighbours on the curve are neighbours in every column, so a run covers a small box and
a filter on any of the columns leaves most files unread. Expressions only, from end to end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from xmlindex.operators.ranking import with_positions
from xmlindex.session import materialize

DIMENSIONS = ("lang", "source", "n_chars")
BITS = 6

# Characters of a value that are looked at for what all values begin with, and bytes that follow.
_HEAD = 256
_CODED = 6


def _turned(value: int, by: int, width: int) -> int:
    """`value` of `width` bits turned right."""
    by %= width
    return ((value >> by) | (value << (width - by))) & ((1 << width) - 1)


def curve_tables(width: int) -> tuple[list[int], list[int]]:
    """Digit and next state for (state, corner), both flattened, of a curve in `width` dimensions.

    A state is the corner at which a cell is entered and the axis along which it is left. The
    corner of a point, seen from the entry and turned to that axis, is a Gray code, whose number
    is the digit; the entry and axis of the smaller cell follow from the number.
    """
    corners = 1 << width

    def gray(number: int) -> int:
        return number ^ (number >> 1)

    number_of = {gray(number): number for number in range(corners)}

    def entry(number: int) -> int:
        return gray(2 * ((number - 1) // 2)) if number else 0

    def axis(number: int) -> int:
        if number == 0:
            return 0
        odd = number if number % 2 else number - 1
        return ((odd ^ (odd + 1)).bit_length() - 1) % width

    digits, following = [], []
    for state in range(corners * width):
        start, along = divmod(state, width)
        for corner in range(corners):
            number = number_of[_turned(corner ^ start, along + 1, width)]
            new_start = start ^ _turned(entry(number), -(along + 1), width)
            new_along = (along + axis(number) + 1) % width
            digits.append(number)
            following.append(new_start * width + new_along)
    return digits, following


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """The place of a cell on the Hilbert curve through a cube of 2^bits steps a side.

    `axes` are integers from 0 to 2^bits - 1; bits times the number of axes is at most 62.
    """
    width = len(axes)
    if not 1 <= width * bits <= 62:
        raise ValueError(f"{width} axes of {bits} bits do not fit into a long")
    digits, following = (F.array(*(F.lit(v) for v in table)) for table in curve_tables(width))

    def corners(point: Column) -> Column:
        def corner(level: Column) -> Column:
            parts = [
                F.call_function("shiftright", F.get(point, F.lit(n)), level).bitwiseAND(1) * F.lit(1 << n) for n in range(width)
            ]
            return sum(parts[1:], parts[0])

        return F.transform(F.sequence(F.lit(bits - 1), F.lit(0)), corner)

    def step(seen: Column, at: Column) -> Column:
        where = seen["state"] * F.lit(1 << width) + at
        return F.struct(
            (seen["index"] * F.lit(1 << width) + F.get(digits, where)).cast("long").alias("index"),
            F.get(following, where).alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    point = F.array(*(axis.cast("int") for axis in axes))
    return _bound(point, lambda p: F.aggregate(corners(p), start, step, lambda seen: seen["index"]))


def _code(value: Column, shared: int) -> Column:
    """The bytes after the first `shared` ones as a number: the order of the values stays."""
    rest = F.hex(F.substring(value.cast("binary"), shared + 1, _CODED))
    return F.conv(F.rpad(rest, 2 * _CODED, "0"), 16, 10).cast("long")


def _step(value: Column, bounds: list[float], below: int = 0) -> Column:
    """How many sorted bounds are less than the value, by halving; 0 for null."""
    if not bounds:
        return F.lit(below)
    middle = len(bounds) // 2
    return F.when(F.lit(bounds[middle]) < value, _step(value, bounds[middle + 1:], below + middle + 1)).otherwise(
        _step(value, bounds[:middle], below)
    )


def _stepped(value: Column, bounds: list[float]) -> Column:
    return _bound(value, lambda one: _step(one, bounds))


def quantised(rows: DataFrame, columns: list[str], bits: int = BITS, accuracy: int = 10_000) -> list[Column]:
    """A step from 0 to 2^bits - 1 for each column, such that steps are about equally filled.

    The bounds are approximate quantiles, 2^bits - 1 numbers a column at the driver; a value's step
    is the number of bounds below it, which is its share of smaller rows whether values are many
    or few. Text is compared by the bytes that follow what all values begin with; dates and
    booleans as numbers. Null is in the first step. A value that a third of the rows share takes
    one step, the others keep theirs.
    """
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    texts = [c for c in columns if isinstance(kinds[c], (T.StringType, T.BinaryType))]
    heads = [F.substring(F.col(f"`{c}`").cast("binary"), 1, _HEAD) for c in texts]
    ends = rows.agg(*[f(head).alias(f"{name}{n}") for n, head in enumerate(heads) for name, f in (("low", F.min), ("high", F.max))]).first() if texts else None
    values = {}
    for c in columns:
        value = F.col(f"`{c}`")
        if c in texts:
            low, high = (bytes(ends[f"{side}{texts.index(c)}"] or b"") for side in ("low", "high"))
            shared = next((n for n, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
            values[c] = _code(value, shared)
        elif isinstance(kinds[c], (T.DateType, T.TimestampNTZType)):
            values[c] = F.unix_micros(value.cast("timestamp")).cast("double")
        elif isinstance(kinds[c], T.TimestampType):
            values[c] = F.unix_micros(value).cast("double")
        else:
            values[c] = value.cast("double")
    steps = 1 << bits
    shares = F.array(*(F.lit(n / steps) for n in range(1, steps)))
    found = rows.agg(*[
        F.percentile_approx(values[c], shares, F.lit(accuracy)).alias(f"b{n}") for n, c in enumerate(columns)
    ]).first()
    result = []
    for n, c in enumerate(columns):
        bounds = [float(b) for b in found[f"b{n}"] or []]
        result.append(_stepped(values[c].cast("double"), bounds))
    return result


def shard_rows(
    rows: DataFrame, shards: int, dimensions: tuple[str, ...] | list[str] = DIMENSIONS, ties: tuple[str, ...] | list[str] = (),
    bits: int = BITS, output: str = "sharding",
) -> DataFrame:
    """All rows and a struct `output`: `shard` from 0, `slot` in it from 0, and `curve`, the cell.

    Rows are in the order of the curve over `dimensions`; in a cell by `ties`, then as they are in
    the staged table, so a cell or a row that a third of the table shares is still split over
    tasks. The runs differ by one row at most (fewer rows than shards leave some empty). Nulls
    come first. Without rows the result is empty. A column named like `output` is replaced;
    others stay as they are, whatever their names. The dimensions are read once beforehand, for
    their quantiles. All columns given are sorted and written along with the row, so give only
    those that are wanted.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    kept = rows.drop(output)
    curve = hilbert_index(quantised(kept, list(dimensions), bits), bits)
    # Written with a number of its own, a row keeps its place when a task is repeated.
    staged = materialize(
        kept.select(
            F.struct(*(F.col(f"`{c}`") for c in kept.columns)).alias("kept"), curve.alias("curve"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    ordered = staged.select("*", *(F.col(f"kept.`{c}`").alias(f"tie{n}") for n, c in enumerate(ties)))
    placed = with_positions(ordered, "curve", *(f"tie{n}" for n in range(len(ties))), "row")
    n_rows = staged.count()
    place = F.col("position") - 1
    shard = F.call_function("div", place * shards, F.lit(max(n_rows, 1)))
    first = F.call_function("div", F.col("shard") * F.lit(n_rows) + F.lit(shards - 1), F.lit(shards))
    return placed.select("kept", "curve", place.alias("place"), shard.alias("shard")).select(
        "kept.*",
        F.struct(F.col("shard").cast("int").alias("shard"), (F.col("place") - first).cast("long").alias("slot"), "curve").alias(output),
    )


def write_shards(sharded: DataFrame, path: str, output: str = "sharding", rows_per_file: int = 1_000_000) -> None:
    """Parquet files below `path/shard=N`, each with a run of the curve, in its order.

    The rows arrive in runs as the sort left them; each task sorts what it has, and a file ends
    after `rows_per_file` rows, so the minima and maxima of files and row groups are narrow in
    every dimension. Repeating the call replaces the files. A column `shard` is renamed by the
    caller beforehand.
    """
    flat = sharded.select("*", F.col(f"`{output}`.shard").alias("shard"))
    (
        flat.sortWithinPartitions("shard", F.col(f"`{output}`.slot"))
        .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
    )

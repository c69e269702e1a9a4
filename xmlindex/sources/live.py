"""Records of the live index, from a dump of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from xmlindex.functions.records import let
from xmlindex.operators.snapshots import dedup_last_write
from xmlindex.session import Staging, materialize

_MEMBERS = {"object_id": "objectID", "collection": "collection", "document_id": "documentID"}


def _before(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add the sum of `value` over what comes before in the same file: within splits, splits offset."""
    split = ["file", "split"]
    rows = rows.withColumn("_value", value)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*split).agg(F.sum("_value").alias("_sum")).select(
        *split, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy(*split).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_within", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    return summed.join(offsets, split).withColumn(name, F.col("_offset") + F.col("_within")).drop("_value", "_within", "_offset")


def split_records(spark: SparkSession, path: str, staging: Staging) -> DataFrame:
    """The text of every record of dumps that are one JSON document each, one record a row.

    A file is cut at every `}`, wherever its splits begin, so it is read by many tasks. Of each
    piece it is known how many quotes it has and what it does to the depth, whether it begins
    inside a string or outside; sums over the pieces before tell which of the two is true, how
    deep the piece begins, and so which closing braces end a record. The pieces between two
    such braces are a record and what stands before it. Records are the objects of an array, or
    of the array `records` of an object; an object without that is one record.
    """
    pieces = staging.write(
        spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("id"), "value",
        ), "pieces",
    )
    escaped = F.contains("value", F.lit("\\"))
    plain = F.when(escaped, F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))

    def outside(parts: Column, inside: int) -> Column:
        return F.array_join(F.filter(parts, lambda _part, n: (n + inside) % 2 == 0), "")

    # `inline` computes the parts of a piece once, for whatever is asked of them.
    parted = pieces.select("file", "split", "id", F.inline(F.transform(F.array(F.split(plain, '"', -1)), lambda parts: F.struct(
        (F.size(parts) - 1).alias("quotes"), outside(parts, 0).alias("plain_0"), outside(parts, 1).alias("plain_1")))))

    def depth(inside: int) -> Column:
        text = F.col(f"plain_{inside}")
        count = lambda letters: F.length(text) - F.length(F.translate(text, letters, ""))
        # The brace that ends the piece closes something unless a string goes on.
        return count("[{") - count("]") - F.when((F.col("quotes") + inside) % 2 == 0, 1).otherwise(0)

    marked = staging.write(parted.select("file", "split", "id", "quotes", depth(0).alias("out"), depth(1).alias("in")), "marked")
    started = _before(marked, F.col("quotes"), "seen").withColumn("inside", F.col("seen") % 2)
    started = started.withColumn("change", F.when(F.col("inside") == 1, F.col("in")).otherwise(F.col("out")))
    started = staging.write(started.select("file", "split", "id", "quotes", "inside", "change"), "started")
    # A file of an array has its records in depth 1, one of an object in depth 2.
    first = pieces.groupBy("file").agg(F.min_by("value", F.struct("split", "id")).alias("value")).select(
        "file", F.when(F.regexp_extract("value", r"^\s*(.)", 1) == "[", 1).otherwise(2).alias("level")
    )
    deep = _before(started, F.col("change"), "depth").join(first, "file")
    closes = ((F.col("inside") + F.col("quotes")) % 2 == 0) & (F.col("depth") + F.col("change") == F.col("level"))
    closed = staging.write(deep.select("file", "split", "id", "level", closes.cast("int").alias("closes")), "closed")
    numbered = staging.write(_before(closed, F.col("closes"), "record"), "numbered")

    texts = (
        numbered.join(pieces, ["file", "split", "id"])
        .groupBy("file", "record", "level")
        .agg(F.max("closes").alias("closed"), F.array_sort(F.collect_list(F.struct("split", "id", "value"))).alias("pieces"))
        .where("closed = 1")
        .select("file", "record", "level", F.concat(F.array_join(F.col("pieces.value"), "}"), F.lit("}")).alias("text"))
    )
    # What comes before a record: a comma within the array, else how the array begins.
    opening = F.when((F.col("level") == 2) & (F.col("record") == 0), F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.col("text"))
    lead = F.regexp_extract("opening", r'^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)\{', 1)
    led = texts.withColumn("opening", opening).withColumn("lead", lead).select(
        "file", "record", "level", F.regexp_replace("lead", r"^\s+|\s+$", "").alias("lead"),
        F.expr("substring(opening, length(lead) + 1)").alias("text"),
    )
    led = staging.write(led, "records")
    name = F.regexp_extract("lead", r'"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*$', 1)
    # Where an array or another member begins: as many rows as the documents have members.
    begins = led.where("level = 2 and (record = 0 or lead <> ',')").select("file", F.col("record").alias("first"), name.alias("name"))
    ends = F.lead("first").over(Window.partitionBy("file").orderBy("first"))
    wanted = begins.withColumn("last", ends).where("name = 'records'").drop("name")
    inside = (F.col("l.file") == F.col("w.file")) & (F.col("record") >= F.col("first")) & (F.col("last").isNull() | (F.col("record") < F.col("last")))
    listed = led.alias("l").where("level = 2").join(wanted.alias("w"), inside, "left_semi")
    found = led.where("level = 1").unionByName(listed).select("file", "record", "text")
    # An object without `records` is a record itself; whether its last brace is a separator shows on parsing.
    single = first.where("level = 2").join(wanted, "file", "left_anti")
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("split", "id", "value")))["value"], "}")
    whole = pieces.join(single.select("file"), "file", "left_semi").groupBy("file").agg(joined.alias("text")).select(
        "file", F.lit(0).cast("bigint").alias("record"),
        F.when(F.try_parse_json("text").isNotNull(), F.col("text")).otherwise(F.concat("text", F.lit("}"))).alias("text"),
    )
    return found.unionByName(whole)


def read_live_index(spark: SparkSession, path: str, index_name: str, lines: bool = False) -> DataFrame:
    """`index_name, object_id, collection, document_id` of every valid record of a dump.

    The dump is JSON files that hold an array of records, an object with a `records` array or one
    record, or, with `lines`, one record per line; either way a file is read by as many tasks as it has
    splits (compressed files by one). Ids that are not strings count as absent.
    """
    def text(record: Column, member: str) -> Column:
        found = let(
            F.try_variant_get(record, f"$.{member}", "variant"),
            lambda value: F.when(F.schema_of_variant(value) == "STRING", value.cast("string")),
        )
        return F.nullif(found, F.lit(""))

    # `inline` parses a record once; a projection would do so for every use of every member.
    def members(record: Column) -> Column:
        return F.struct(*[text(record, member).alias(name) for name, member in _MEMBERS.items()])

    with Staging() as staging:
        if lines:
            texts = spark.read.text(path).select(F.col("value").alias("text"))
        else:
            texts = split_records(spark, path, staging)
        rows = texts.select(
            F.lit(index_name).alias("index_name"), F.inline(F.transform(F.array(F.try_parse_json("text")), members)),
        ).where("object_id is not null and collection is not null")
        # An index holds an object id once; should a dump repeat one, a fixed choice is made.
        found = dedup_last_write(rows, ["index_name", "object_id"], ["collection", "document_id"])
        return found if lines else materialize(found, "live")

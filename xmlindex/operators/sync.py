"""Compare the stored records with the live index for collection trees.

`local` rows are the newest stored records (`index_name, doc_key, object_id, collection,
document_id`), `live` rows those of the index (`index_name, object_id, collection,
document_id`, unique per object id as an index is), `trees` the collections asked about
(`index_name, tree`). `document_id` is the user-specified id or null.

Everything is keyed by object id or aggregated before it meets a tree, so a tree that holds
most of the records costs no more than the same records in many trees.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from xmlindex.functions.paths import ancestors, in_collection_tree
from xmlindex.operators.snapshots import dedup_last_write
from xmlindex.operators.status import status_for
from xmlindex.session import materialize, small_side

TREE_KEY = ["index_name", "tree"]
OBJECT_KEY = ["index_name", "object_id"]

# Trees in one number, leaving out the sign, and the numbers a set of trees may take.
_WORD_BITS = 63
_WORDS = 4


def valid_records(records: DataFrame) -> DataFrame:
    """Rows with a non-empty object id and collection."""
    return records.where("object_id <> '' and collection <> ''")


def collection_trees(rows: DataFrame, trees: DataFrame) -> DataFrame:
    """(index, collection, tree) for every collection of `rows` and every tree it lies in.

    The prefix test becomes an equi-join of each distinct collection's ancestors.
    """
    return (
        rows.select("index_name", "collection").distinct()
        .select("index_name", "collection", F.explode(ancestors("collection")).alias("tree"))
        .join(trees.select(*TREE_KEY).distinct(), TREE_KEY)
    )


def staged_sides(
    local: DataFrame, live: DataFrame, trees: DataFrame, live_staged: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The key columns of both sides, and the distinct trees, written once.

    A report reads them several times, and the newest records of a store, or a live dump, cost
    more than their keys. With `live_staged` the live side is such a table already.
    """
    local = valid_records(local).select("index_name", "doc_key", "object_id", "collection", "document_id")
    live = valid_records(live).select("index_name", "object_id", "collection", "document_id")
    trees = trees.select(*TREE_KEY).distinct()
    live = live if live_staged else materialize(live, "live")
    return materialize(local, "local"), live, materialize(trees, "trees")


class TreeSets:
    """The trees asked about that rows lie in, collected by an aggregate and grouped by.

    As long as few trees are asked about, they are the bits of some numbers: Spark aggregates these by
    hashing, and rows in the same trees make one group, whatever their collections. With more trees,
    the sorted array of the collections stands for them, which has no bound.
    """

    def __init__(self, local: DataFrame, live: DataFrame, trees: DataFrame):
        limit = _WORD_BITS * _WORDS
        found = sorted(r[0] for r in trees.select("tree").distinct().limit(limit + 1).collect())
        self.few = len(found) <= limit
        if not self.few:
            return
        self.bits = [(name, n // _WORD_BITS, 1 << n % _WORD_BITS) for n, name in enumerate(found)]
        self.words = range(max(1, -(-len(found) // _WORD_BITS)))
        cover = tree_cover(local, live, trees).select("collection", "tree").distinct()
        masks = [
            F.coalesce(F.bit_or(F.coalesce(*[F.when(F.col("tree") == t, F.lit(bit).cast("bigint")) for t, n, bit in self.bits if n == w],
                                           F.lit(0).cast("bigint"))), F.lit(0)).alias(f"_in_{w}")
            for w in self.words
        ]
        self.cover = small_side(materialize(cover.groupBy("collection").agg(*masks), "cover"))

    def placed(self, rows: DataFrame, inside: bool = True) -> DataFrame:
        """Rows as `collected` takes them; those `inside` no tree are left out, or kept."""
        return rows.join(self.cover, "collection", "inner" if inside else "left") if self.few else rows

    def columns(self, name: str) -> list[str]:
        return [f"{name}_{w}" for w in self.words] if self.few else [name]

    def collected(self, name: str, where: Column | None = None) -> list[Column]:
        """Aggregates that give the `columns` of a set: where those rows are."""
        where = F.lit(True) if where is None else where
        if not self.few:
            return [F.sort_array(F.collect_set(F.when(where, F.col("collection")))).alias(name)]
        return [F.coalesce(F.bit_or(F.when(where, F.col(f"_in_{w}"))), F.lit(0)).alias(f"{name}_{w}") for w in self.words]

    def per_tree(self, groups: DataFrame, trees: DataFrame, stored: str, live: str | None = None) -> DataFrame:
        """Groups once per tree asked for, with `in_local` and `in_live`."""
        if not self.few:
            nothing = F.array().cast("array<string>")
            return _per_tree(groups, trees, F.col(stored), nothing if live is None else F.col(live))

        def holds(name: str | None, word: int, bit: int) -> Column:
            return F.lit(False) if name is None else F.col(f"{name}_{word}").bitwiseAND(F.lit(bit)) != 0

        found = [
            F.when(holds(stored, word, bit) | holds(live, word, bit), F.struct(
                F.lit(tree).alias("tree"), holds(stored, word, bit).alias("in_local"), holds(live, word, bit).alias("in_live")))
            for tree, word, bit in self.bits
        ]
        if not found:
            found = [F.lit(None).cast("struct<tree:string,in_local:boolean,in_live:boolean>")]
        dropped = [c for name in (stored, live) if name for c in self.columns(name)]
        kept = [c for c in groups.columns if c not in dropped]
        return groups.select(*kept, F.inline(F.array_compact(F.array(*found)))).join(trees, TREE_KEY)


def tree_cover(local: DataFrame, live: DataFrame, trees: DataFrame) -> DataFrame:
    """`collection_trees` of both sides, to be joined several times."""
    key = ["index_name", "collection"]
    return small_side(collection_trees(local.select(*key).unionByName(live.select(*key)), trees))


def in_trees(rows: DataFrame, trees: DataFrame, cover: DataFrame | None = None) -> DataFrame:
    """Rows once per tree they lie in, with the `tree`."""
    cover = small_side(collection_trees(rows, trees)) if cover is None else cover
    return rows.join(cover, ["index_name", "collection"])


def missing_in_live(local: DataFrame, live: DataFrame) -> DataFrame:
    """Stored object ids the index lacks."""
    return local.select(*OBJECT_KEY).distinct().join(live.select(*OBJECT_KEY), OBJECT_KEY, "left_anti")


def unexpected_in_live(local: DataFrame, live: DataFrame) -> DataFrame:
    """Object ids of the index that are not stored."""
    return live.select(*OBJECT_KEY).distinct().join(local.select(*OBJECT_KEY), OBJECT_KEY, "left_anti")


def wrong_path_live(local: DataFrame, live: DataFrame, tree: str) -> DataFrame:
    """Live records of a document stored in the tree that sit outside of it."""
    stored = local.where(in_collection_tree("collection", tree)).where("document_id <> ''")
    outside = valid_records(live).where(~in_collection_tree("collection", tree))
    return outside.join(
        stored.select("index_name", "document_id").distinct(), ["index_name", "document_id"], "left_semi"
    )


def count_by_collection(records: DataFrame, *keys: str) -> DataFrame:
    return records.where("collection <> ''").groupBy(*keys, "collection").agg(F.count("*").alias("n"))


def matching_documents(local: DataFrame, trees: DataFrame) -> DataFrame:
    """Distinct stored documents per tree."""
    return in_trees(valid_records(local), trees).select(*TREE_KEY, "doc_key").distinct()


def object_states(local: DataFrame, live: DataFrame, trees: DataFrame) -> DataFrame:
    """One row per tree and object id with `is_local` and `is_live`."""
    cover = tree_cover(local, live, trees)

    def side(rows: DataFrame, is_local: bool) -> DataFrame:
        return in_trees(valid_records(rows), trees, cover).select(
            *TREE_KEY, "object_id", F.lit(is_local).alias("l"), F.lit(not is_local).alias("v")
        )

    return (
        side(local, True).unionByName(side(live, False))
        .groupBy(*TREE_KEY, "object_id")
        .agg(F.bool_or("l").alias("is_local"), F.bool_or("v").alias("is_live"))
    )


# A report never multiplies objects by the trees they lie in. Objects are first grouped by
# where they are (see `TreeSets`: where they are stored, where they are live); the groups are
# few, and only they are matched with trees.


def _first_ids(rows: DataFrame, key: list[str], limit: int, where: Column | None = None) -> DataFrame:
    """Number and first `limit` object ids per key; the row-number filter runs before the shuffle.

    Keys that do not hold `where` have no ids.
    """
    first = Window.partitionBy(*key).orderBy("object_id")
    ids = (
        (rows if where is None else rows.where(where)).select(*key, "object_id")
        .withColumn("rn", F.row_number().over(first))
        .where(F.col("rn") <= max(1, limit))
        .groupBy(*key)
        .agg(F.collect_list("object_id").alias("ids"))
    )
    return rows.groupBy(*key).agg(F.count("*").alias("n")).join(ids, key, "left")


def _trees_of(collections: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(collections, ancestors)))


def _per_tree(groups: DataFrame, trees: DataFrame, stored: Column, live: Column) -> DataFrame:
    """Groups once per tree asked for, with `in_local` and `in_live`."""
    return (
        groups.withColumn("lt", _trees_of(stored)).withColumn("vt", _trees_of(live))
        .withColumn("tree", F.explode(F.array_union("lt", "vt")))
        .withColumn("in_local", F.array_contains("lt", F.col("tree")))
        .withColumn("in_live", F.array_contains("vt", F.col("tree")))
        .drop("lt", "vt")
        .join(trees, TREE_KEY)
    )


def _sample(groups: DataFrame, limit: int, name: str) -> DataFrame:
    """The first ids of each tree, from the first ids of its groups."""
    first = Window.partitionBy(*TREE_KEY).orderBy("object_id")
    return (
        groups.select(*TREE_KEY, F.explode("ids").alias("object_id"))
        .withColumn("rn", F.row_number().over(first))
        .where(F.col("rn") <= limit)
        .groupBy(*TREE_KEY)
        .agg(F.sort_array(F.collect_list("object_id")).alias(name))
    )


def placement_groups(local: DataFrame, live: DataFrame, sample_limit: int, sets: TreeSets) -> DataFrame:
    """Objects by where they are stored and live: `n` and, if the two differ, first `ids`."""
    columns = [*OBJECT_KEY, "collection"]
    rows = local.select(*columns, F.lit(True).alias("l")).unionByName(live.select(*columns, F.lit(False).alias("l")))
    objects = sets.placed(rows).groupBy(*OBJECT_KEY).agg(
        *sets.collected("stored", F.col("l")), *sets.collected("live", ~F.col("l"))
    )
    # Counted and sorted for their first ids, so all that is read twice is written.
    objects = materialize(objects, "objects")
    stored, live_in = sets.columns("stored"), sets.columns("live")
    apart = F.array(*stored) != F.array(*live_in)
    return _first_ids(objects, ["index_name", *stored, *live_in], sample_limit, apart)


def wrong_path_groups(
    local: DataFrame, live: DataFrame, trees: DataFrame, sample_limit: int, sets: TreeSets
) -> DataFrame:
    """Wrong-path live records per tree and live collection: `n` and, if any are asked for, first `ids`.

    A live record is matched with the places its document is stored in, a set per document;
    a document with very many live records makes a skewed but splittable join partition.
    """
    document = ["index_name", "document_id"]
    stored = sets.placed(local.where("document_id <> ''")).groupBy(*document).agg(*sets.collected("stored"))
    held = live.where("document_id <> ''")
    if not sample_limit:
        held = held.groupBy(*document, "collection").agg(F.count("*").alias("records"))
    matched = sets.placed(held, inside=False).join(stored, document)
    if sets.few:
        # Trees that store the document and do not hold the record.
        outside = [
            F.col(f"stored_{w}").bitwiseAND(F.bitwise_not(F.coalesce(f"_in_{w}", F.lit(0)))).alias(f"stored_{w}") for w in sets.words
        ]
        matched = matched.select(*held.columns, *outside).where(reduce(or_, [F.col(c) != 0 for c in sets.columns("stored")]))
    else:
        # A record in the only collection of its document is where it should be, in every tree.
        matched = matched.where(~((F.size("stored") == 1) & (F.element_at("stored", 1) == F.col("collection"))))
    key = ["index_name", *sets.columns("stored"), "collection"]
    if sample_limit:
        groups = _first_ids(matched, key, sample_limit)
    else:
        groups = matched.groupBy(*key).agg(F.sum("records").alias("n")).withColumn("ids", F.array().cast("array<string>"))
    if sets.few:
        found = sets.per_tree(groups, trees, "stored")
    else:
        found = _per_tree(groups, trees, F.col("stored"), F.array("collection")).where("in_local and not in_live")
    return found.select(*TREE_KEY, "collection", "n", "ids")


def document_counts(local: DataFrame, trees: DataFrame, sets: TreeSets) -> DataFrame:
    """Stored documents, and user-specified document ids, per tree."""
    def counted(column: str, name: str) -> DataFrame:
        held = sets.placed(local.where(F.col(column) != "")).groupBy("index_name", column).agg(*sets.collected("stored"))
        groups = held.groupBy("index_name", *sets.columns("stored")).agg(F.count("*").alias("n"))
        return sets.per_tree(groups, trees, "stored").groupBy(*TREE_KEY).agg(F.sum("n").alias(name))

    return _merged(counted("doc_key", "document_dirs"), counted("document_id", "document_ids"))


def _merged(*parts: DataFrame) -> DataFrame:
    """Parts with one row per tree and columns of their own, as one table; one shuffle for all."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    columns = [c for c in rows.columns if c not in TREE_KEY]
    return rows.groupBy(*TREE_KEY).agg(*[F.max(c).alias(c) for c in columns])


def classify(report: DataFrame, with_status: bool) -> Column:
    """Classification of a report row; the first rule that holds wins."""
    stale = (
        F.col("status_state").isNull() | (F.col("status_state") != "current")
        if with_status
        else F.lit(False)
    )
    return (
        F.when(F.col("synced") & stale, "stale_status")
        .when(F.col("synced"), "synced")
        .when((F.col("local_count") == 0) & (F.col("live_count") > 0), "local_store_corruption")
        .when(F.col("wrong_path_count") > 0, "wrong_path_drift")
        .when((F.col("missing_count") > 0) & (F.col("unexpected_count") == 0), "true_live_loss")
        .otherwise("mismatch")
    )


def sync_report(
    local: DataFrame,
    live: DataFrame,
    trees: DataFrame,
    status: DataFrame | None = None,
    sample_limit: int = 5,
    live_staged: bool = False,
) -> DataFrame:
    """One row per tree: counts, samples, replay numbers, classification.

    Counts per collection and the documents of a tree are tables of their own
    (`sync_counts`, `matching_documents`), since they have no bound a row could rely on.
    """
    local, live, trees = staged_sides(local, live, trees, live_staged)
    sets = TreeSets(local, live, trees)
    # The groups are few, and read once per number or sample of the report.
    groups = materialize(placement_groups(local, live, sample_limit, sets), "groups")
    objects = sets.per_tree(groups, trees, "stored", "live")
    missing = F.col("in_local") & ~F.col("in_live")
    unexpected = F.col("in_live") & ~F.col("in_local")

    def number(where: Column, name: str) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(0)).alias(name)

    counts = objects.groupBy(*TREE_KEY).agg(
        number(F.col("in_local"), "local_count"),
        number(F.col("in_live"), "live_count"),
        number(missing, "missing_count"),
        number(unexpected, "unexpected_count"),
    )
    wrong = materialize(wrong_path_groups(local, live, trees, max(1, sample_limit), sets), "wrong")
    parts = [
        trees,
        counts,
        document_counts(local, trees, sets),
        wrong.groupBy(*TREE_KEY).agg(F.sum("n").alias("wrong_path_count")),
        _sample(objects.where(missing), sample_limit, "sample_missing"),
        _sample(objects.where(unexpected), sample_limit, "sample_unexpected"),
        _sample(wrong, sample_limit, "sample_wrong_path"),
    ]
    if status is not None:
        keys = trees.withColumnRenamed("tree", "collection")
        parts.append(status_for(status, keys).select(
            "index_name", F.col("collection").alias("tree"), F.col("state").alias("status_state")
        ))
    numbers = ["local_count", "live_count", "missing_count", "unexpected_count", "wrong_path_count",
               "document_dirs", "document_ids"]
    report = _merged(*parts).fillna(0, numbers)
    for name in ("sample_missing", "sample_unexpected", "sample_wrong_path"):
        report = report.withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    report = (
        report.withColumn("replay_delete_count", F.col("live_count") + F.col("wrong_path_count"))
        .withColumn("replay_upload_count", F.col("local_count"))
        .withColumn(
            "synced",
            (F.col("missing_count") == 0) & (F.col("unexpected_count") == 0) & (F.col("wrong_path_count") == 0),
        )
    )
    report = report.withColumn("classification", classify(report, status is not None))
    return report.drop("status_state")


def sync_counts(local: DataFrame, live: DataFrame, trees: DataFrame, live_staged: bool = False) -> DataFrame:
    """Records per tree, side (`local`, `live`, `wrong_path`) and collection."""
    local, live, trees = staged_sides(local, live, trees, live_staged)

    def side(rows: DataFrame, name: str) -> DataFrame:
        groups = count_by_collection(rows, "index_name").withColumn("where", F.array("collection"))
        placed = _per_tree(groups, trees, F.col("where"), F.col("where"))
        return placed.select(*TREE_KEY, F.lit(name).alias("side"), "collection", "n")

    wrong = (
        wrong_path_groups(local, live, trees, 0, TreeSets(local, live, trees))
        .groupBy(*TREE_KEY, "collection").agg(F.sum("n").alias("n"))
        .select(*TREE_KEY, F.lit("wrong_path").alias("side"), "collection", "n")
    )
    return side(local, "local").unionByName(side(live, "live")).unionByName(wrong)


def recommend_action(report: DataFrame) -> DataFrame:
    """Add `action`: nothing, a status refresh, or a replay with the numbers it would move."""
    replay = F.format_string(
        "inspect, then replay: deletes %d live object(s), uploads %d object(s)",
        "replay_delete_count", "replay_upload_count",
    )
    return report.withColumn(
        "action",
        F.when(F.col("classification") == "synced", "none")
        .when(F.col("classification") == "stale_status", "refresh status")
        .otherwise(replay),
    )


def replay_plan(local: DataFrame, live: DataFrame, tree: str) -> DataFrame:
    """Operations that rebuild a tree in the index: delete its live records and the misplaced
    ones of its documents, then add every stored record.

    In order of (`action_rank`, `object_id`) when written; see `replay_batches`.
    """
    inside = valid_records(live).where(in_collection_tree("collection", tree)).select(*OBJECT_KEY)
    deletes = inside.unionByName(wrong_path_live(local, live, tree).select(*OBJECT_KEY)).distinct()
    stored = valid_records(local).where(in_collection_tree("collection", tree))
    uploads = dedup_last_write(
        stored.select(*OBJECT_KEY, "doc_key", "node_key", "record_json"), OBJECT_KEY, ["doc_key", "node_key"]
    )
    return deletes.select(
        *OBJECT_KEY, F.lit(1).alias("action_rank"), F.lit("delete").alias("op"),
        F.lit(None).cast("string").alias("record_json"),
    ).unionByName(
        uploads.select(*OBJECT_KEY, F.lit(2).alias("action_rank"), F.lit("add").alias("op"), "record_json")
    )

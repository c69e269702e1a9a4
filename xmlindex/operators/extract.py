"""Root objects, fields, identifiers and JSON: from shredded documents to records.

Everything here is a narrow transformation: nodes arrive attached to their root element, the
configuration is a broadcast table with one row per root configuration, and one expression
serves all of them, so the plan does not grow with the configuration.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from xmlindex.config import CollectionConfig, path_predicates
from xmlindex.functions import records as R
from xmlindex.operators.shred import predicates_hold, scopes_of, shred_documents

_PREDICATES = "array<struct<op:string,value:string>>"
_SCOPE_SCHEMA = (
    "scope int, index_name string, root_path string, node_id_path string, root_preds "
    f"{_PREDICATES}, field_cfg array<struct<name:string,key:string,kind:string,type:string,"
    f"preds:array<{_PREDICATES}>>>, document_id_slot int, visible_by_slot int, batch_size int"
)
# What a marker row says of its document.
MARKER_COLUMNS = ("scope", "doc_values", "error", "config_no")
_SHRED_ONLY = ("scope", "root_node_id", "root_checks", "fields", "doc_values", "error", "config_no")


def _path_tree(configs: list[CollectionConfig]) -> list[tuple[int | None, dict[str, int]]]:
    """Configured collections as a tree of path parts: (configuration, child by part) of each node."""
    nodes: list[tuple[int | None, dict[str, int]]] = [(None, {})]
    for number, config in enumerate(configs):
        at = 0
        for part in config.collection.split("/"):
            children = nodes[at][1]
            if part not in children:
                children[part] = len(nodes)
                nodes.append((None, {}))
            at = children[part]
        if nodes[at][0] is not None:
            raise ValueError("two configurations for one collection")
        nodes[at] = (number, nodes[at][1])
    return nodes


def resolve_config(documents: DataFrame, configs: list[CollectionConfig]) -> DataFrame:
    """Add `config_no`: the configuration of the document's collection or of its nearest ancestor.

    The configured paths are one broadcast row, a tree that an expression walks along the parts
    of the collection, so the plan is the same for any number of configurations.
    """
    tree = documents.sparkSession.createDataFrame(
        [(_path_tree(configs),)], "_tree array<struct<config_no: int, children: map<string, int>>>"
    )

    def step(seen: Column, part: Column) -> Column:
        child = F.try_element_at(F.get(F.col("_tree"), seen["node"])["children"], part)
        return R.let(child, lambda node: F.struct(
            node.alias("node"), F.coalesce(F.get(F.col("_tree"), node)["config_no"], seen["found"]).alias("found")
        ))

    start = F.struct(F.lit(0).alias("node"), F.lit(None).cast("int").alias("found"))
    found = F.aggregate(F.split("collection", "/"), start, step, lambda seen: seen["found"])
    return documents.crossJoin(F.broadcast(tree)).withColumn("config_no", found).drop("_tree")


def unconfigured_documents(documents: DataFrame, configs: list[CollectionConfig]) -> DataFrame:
    """Documents no configuration covers; they are not indexed."""
    return resolve_config(documents, configs).where("config_no is null").drop("config_no", "xml")


def scope_table(spark: SparkSession, configs: list[CollectionConfig]) -> DataFrame:
    """One row per root configuration; its size is that of the configuration itself."""
    def predicates(steps):
        return [(p.operator, p.value) for _step, p in path_predicates(steps)]

    rows = [
        (
            scope, index.name, root.path, root.node_id_path, predicates(root.steps),
            [(f.name, json.dumps(f.name, ensure_ascii=False) + ":", f.kind, f.type, [predicates(steps) for steps in f.paths]) for f in root.fields],
            2 * index_no + 1 if index.document_id else None,
            2 * index_no + 2 if index.visible_by else None,
            index.batch_size,
        )
        for scope, (_config_no, index_no, index, root) in enumerate(scopes_of(configs))
    ]
    return spark.createDataFrame(rows, _SCOPE_SCHEMA)


def _selected(values: Column, field: Column) -> Column:
    """Values of one field whose predicates hold, in document order."""
    return F.filter(
        values, lambda v: predicates_hold(v["checks"], F.element_at(field["preds"], v["alt"] + 1))
    )


def _merged(child: Column) -> Column:
    """Values of a field without attributes whose own element is a value too."""
    def parent(v: Column) -> Column:
        return F.regexp_replace(v["node_id"], r"\.[^.]*$", "")

    mixed = F.exists(child["values"], lambda v: v["element"]) & F.exists(
        child["values"], lambda v: ~v["element"]
    )
    elements = F.transform(F.filter(child["values"], lambda v: v["element"]), lambda v: v["node_id"])
    return F.when(
        mixed,
        R.let(
            elements,
            lambda ids: F.filter(
                child["values"], lambda v: v["element"] | ~F.array_contains(ids, parent(v))
            ),
        ),
    ).otherwise(child["values"])


def _value_json(field: Column, value: Column) -> Column:
    return F.when(
        field["kind"] == "object", R.object_json(value["node_id"], value["element"], value["content"])
    ).otherwise(R.typed_json(value["content"], field["type"]))


def _literals(child: Column) -> Column:
    """JSON of each value, null where it is not a literal of the configured type; null for plain text."""
    is_plain = (child["kind"] == "attribute") & (child["type"] == "string")
    return F.when(~is_plain, F.transform(child["values"], lambda v: _value_json(child, v)))


def _field_json(child: Column, literals: Column) -> Column:
    """`"name":value`, null if no value is a literal of the configured type.

    Plain text, the usual case, takes one serialiser call for all values of the field.
    """
    many = F.size(child["values"]) > 1
    texts = F.to_json(F.transform(child["values"], lambda v: v["content"]))
    plain = R.let(texts, lambda t: F.when(many, t).otherwise(F.btrim(t, F.lit("[]"))))
    other = R.array_or_scalar(F.filter(literals, lambda json: json.isNotNull()))
    return F.concat(child["key"], F.when(literals.isNull(), plain).otherwise(other))


def build_records(
    shredded: DataFrame, configs: list[CollectionConfig], mode: str = "drop", drop_empty: bool = False,
    markers: bool = False,
) -> DataFrame:
    """Records of shredded documents.

    `children` lists the fields in the order of their first node (objects before attributes
    when one node feeds both). A value that is not a literal of its type is left out and
    counted in `bad_literals`; `mode="fail"` raises instead. `drop_empty` leaves out root
    objects none of whose fields matched. With `markers` the marker row of every document stays, with
    the columns it has from shredding (`MARKER_COLUMNS`), so that one table holds all that is asked later.
    """
    if mode not in ("drop", "fail"):
        raise ValueError("mode is 'drop' or 'fail'")
    numeric = shredded.schema["document_id"].dataType.typeName() not in ("string",)
    kept = [c for c in shredded.columns if c not in _SHRED_ONLY or markers and c in MARKER_COLUMNS]
    configured = F.broadcast(scope_table(shredded.sparkSession, configs))

    def with_values(field: Column, values: Column) -> Column:
        names = ("name", "key", "kind", "type")
        return F.struct(*[field[n].alias(n) for n in names], values.alias("values"))

    # Steps that no field of the configuration needs are left out of the plan.
    fields = [f for config in configs for index in config.indexes for root in index.roots for f in root.fields]
    has_predicates = any(path_predicates(steps) for f in fields for steps in f.paths)
    has_mixed = any(len({steps[-1].attribute for steps in f.paths}) > 1 for f in fields)
    # Each step binds the one before to a lambda variable, so nothing is computed twice.
    selected = F.zip_with(
        F.slice("fields", F.lit(1), F.size("field_cfg")),
        F.col("field_cfg"),
        lambda values, field: with_values(field, _selected(values, field) if has_predicates else values),
    )
    present = F.filter(selected, lambda child: F.coalesce(F.size(child["values"]), F.lit(0)) > 0)
    # Fields are configured objects first, and the sort keeps that order for equal nodes.
    ordered = F.array_sort(
        present, lambda a, b: F.signum(a["values"][0]["ord"] - b["values"][0]["ord"]).cast("int")
    )
    children = F.transform(ordered, lambda child: with_values(child, _merged(child))) if has_mixed else ordered
    node_ids = F.filter(F.element_at("fields", -1), lambda v: v["content"] != "")
    if markers:
        rows = shredded.withColumn("fields", F.when(F.col("scope").isNotNull(), F.col("fields"))).join(configured, "scope", "left")
    else:
        rows = shredded.where("scope is not null").join(configured, "scope")
    out = (
        rows
        .where(predicates_hold(F.col("root_checks"), F.col("root_preds")))
        .select(
            *kept,
            "index_name",
            "root_path",
            "node_id_path",
            F.col("root_node_id").alias("node_id"),
            F.when(F.col("node_id_path").isNotNull(),
                   F.try_element_at(node_ids, F.lit(1))["content"]).alias("user_node_id"),
            F.try_element_at("doc_values", F.col("document_id_slot")).alias("user_document_id"),
            F.try_element_at("doc_values", F.col("visible_by_slot")).alias("visible_by"),
            children.alias("children"),
        )
    )
    if drop_empty:
        out = out.where((F.size("children") > 0) | F.col("scope").isNull() if markers else F.size("children") > 0)
    out = out.withColumn("object_id", R.object_id("user_node_id", "collection_id", "document_id", "node_id"))
    # Records and counts of bad literals both read these.
    out = out.withColumn("_literals", F.transform("children", _literals))
    members = F.concat(
        F.array(
            F.concat(F.lit('"objectID":'), R.json_string("object_id")),
            F.concat(F.lit('"collection":'), R.json_string("collection")),
            F.concat(F.lit('"documentID":'), R.document_id_json("user_document_id", "document_id", numeric)),
            F.concat(F.lit('"visible_by":'), R.json_string("visible_by")),
        ),
        F.zip_with("children", "_literals", _field_json),
    )
    # `array_join` leaves out nulls: a missing visible_by, a field without a valid literal.
    record_json = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    bad = F.aggregate(
        "_literals",
        F.lit(0),
        lambda n, literals: n + F.when(
            literals.isNotNull(), F.size(F.filter(literals, lambda json: json.isNull()))
        ).otherwise(0),
    )
    out = (
        out.withColumn("record_json", record_json)
        .withColumn("bad_literals", bad)
        .withColumn("doc_key", R.doc_key("user_document_id", "document_id"))
        .withColumn("node_key", R.node_key("user_node_id", "node_id"))
        .withColumn("md5", F.md5("record_json"))
        .drop("_literals")
    )
    if mode == "fail":
        out = out.withColumn(
            "record_json",
            F.when(F.col("bad_literals") == 0, F.col("record_json")).otherwise(
                F.raise_error(F.concat(F.lit("a value does not have its type in record "), F.col("object_id")))
            ),
        )
    return out


def extract_records(
    documents: DataFrame,
    configs: list[CollectionConfig],
    mode: str = "drop",
    on_malformed: str = "fail",
    drop_empty: bool = False,
) -> DataFrame:
    """Documents (`collection`, `collection_id`, `document_id`, `xml`) to records."""
    shredded = shred_documents(resolve_config(documents, configs), configs, on_malformed, markers=False)
    return build_records(shredded, configs, mode, drop_empty)


def index_table(spark: SparkSession, configs: list[CollectionConfig]) -> DataFrame:
    """One row per configured index, with the slot its document id is found in."""
    return spark.createDataFrame(
        [
            (config_no, index.name, 2 * index_no + 1 if index.document_id else None)
            for config_no, config in enumerate(configs)
            for index_no, index in enumerate(config.indexes)
        ],
        "config_no int, index_name string, document_id_slot int",
    )


def skipped_documents(shredded: DataFrame, configs: list[CollectionConfig]) -> DataFrame:
    """(index, document) pairs left out because the document is not well-formed."""
    indexes = F.broadcast(index_table(shredded.sparkSession, configs))
    return (
        shredded.where("error is not null")
        .join(indexes, "config_no")
        .select("index_name", "collection", "collection_id", "document_id", "error")
    )


def processed_documents(shredded: DataFrame, configs: list[CollectionConfig], *carried: str) -> DataFrame:
    """(index, document) pairs seen, with their document key, whether or not they gave a record.

    `carried` names further columns of the documents to keep.
    """
    return (
        shredded.where("scope is null and error is null")
        .join(F.broadcast(index_table(shredded.sparkSession, configs)), "config_no")
        .select(
            "index_name", "collection", "collection_id", "document_id", *carried,
            R.doc_key(
                F.try_element_at("doc_values", F.col("document_id_slot")), "document_id"
            ).alias("doc_key"),
        )
    )


def extraction_report(processed: DataFrame, records: DataFrame) -> DataFrame:
    """Emitted root objects per document and index, including documents that gave none."""
    counts = records.groupBy("index_name", "document_id", "collection").agg(F.count("*").alias("n"))
    return processed.join(counts, ["index_name", "document_id", "collection"], "left").select(
        "index_name", "collection", "document_id", F.coalesce("n", F.lit(0)).alias("root_objects")
    )


def fallback_report(records: DataFrame) -> DataFrame:
    """Root objects that lack their configured node id, per index, document and configured path."""
    return (
        records.where("node_id_path is not null and user_node_id is null")
        .groupBy(
            "index_name", "collection", "document_id",
            F.concat_ws("/", "root_path", "node_id_path").alias("configured_path"),
        )
        .agg(F.count("*").alias("affected"))
    )


def duplicate_object_ids(records: DataFrame) -> DataFrame:
    """Object ids given to more than one record of an index (user node ids are not document-scoped)."""
    return (
        records.groupBy("index_name", "object_id").agg(F.count("*").alias("n")).where("n > 1")
    )

"""Every operator run over the given tables, each with the SQL that says what it must return.

The tables are read whole. Events stand for snapshot writes and status events, orders for
stored records, line items for the live index, and documents, conversations and orders are
rendered as XML and extracted again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from xmlindex.config import CollectionConfig, load_config
from xmlindex.functions import paths as P, records as R
from xmlindex.operators import batches as B, extract as X, removal as M, snapshots as S, status as T, sync as Y
from xmlindex.operators.publish import CallPublisher, FilePublisher, TransportError, batch_digest
from xmlindex.operators.shred import malformed_documents, select_nodes, shred_documents, shred_xml
from xmlindex.plans.indexing import index_documents, reindex_collection, remove_documents
from xmlindex.plans.job import Job
from xmlindex.plans.removing import drop_index, remove_collections
from xmlindex.plans.repairing import reconcile, replay_batches, report_for
from xmlindex.session import materialize, ship_package, spread, staging_path
from xmlindex.sources.archives import write_archives
from xmlindex.sources.documents import documents_from_table, read_documents, stream_documents, upserts, write_documents
from xmlindex.sources.files import list_names, replace_with_pieces
from xmlindex.sources.live import read_live_index
from xmlindex.sources.snapshots import import_snapshot_files
from xmlindex.sources.status import read_status_document, write_status_document
from xmlindex.streaming.incremental import apply_events, start_incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package()
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Derived inputs, in Spark and in SQL ----------------------------------------------------

# Each event writes the record of one user and event type into the snapshot of its day.
EVENT_WRITES_SQL = """
writes AS (
  SELECT 'events' AS index_name, CAST(user_id AS VARCHAR) AS doc_key,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS snapshot_ts,
         event_type AS node_key, user_id || '/' || event_type AS object_id,
         '/db/events/' || event_type AS collection, CAST(user_id AS VARCHAR) AS document_id,
         event_id AS written,
         '{"objectID":"' || user_id || '/' || event_type || '","props":' || props || '}' AS record_json
  FROM events),
snapshots AS (
  SELECT * EXCLUDE (rn), md5(record_json) AS md5 FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_key, snapshot_ts, node_key ORDER BY written DESC) AS rn
    FROM writes) WHERE rn = 1),
times AS (
  SELECT doc_key, snapshot_ts, dense_rank() OVER (PARTITION BY doc_key ORDER BY snapshot_ts DESC) AS age
  FROM (SELECT DISTINCT doc_key, snapshot_ts FROM snapshots)),
latest AS (SELECT s.* FROM snapshots s JOIN times t USING (doc_key, snapshot_ts) WHERE age = 1),
previous AS (SELECT s.* FROM snapshots s JOIN times t USING (doc_key, snapshot_ts) WHERE age = 2),
changes AS (
  SELECT 'events' AS index_name, coalesce(c.doc_key, p.doc_key) AS doc_key,
         coalesce(c.node_key, p.node_key) AS node_key,
         CASE WHEN p.md5 IS NULL THEN 'add' WHEN c.md5 IS NULL THEN 'delete' ELSE 'update' END AS op,
         coalesce(c.object_id, p.object_id) AS object_id,
         coalesce(c.collection, p.collection) AS collection,
         coalesce(c.document_id, p.document_id) AS document_id, c.record_json AS record_json
  FROM previous p FULL OUTER JOIN latest c ON p.doc_key = c.doc_key AND p.node_key = c.node_key
  WHERE p.md5 IS DISTINCT FROM c.md5)
"""


def event_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    object_id = F.concat_ws("/", user, "event_type")
    return events.select(
        F.lit("events").alias("index_name"),
        user.alias("doc_key"),
        F.datediff(F.to_date("ts"), F.to_date(F.lit("1970-01-01"))).cast("bigint").alias("snapshot_ts"),
        F.col("event_type").alias("node_key"),
        object_id.alias("object_id"),
        F.concat(F.lit("/db/events/"), "event_type").alias("collection"),
        user.alias("document_id"),
        F.col("event_id").alias("written"),
        F.concat(F.lit('{"objectID":'), R.json_string(object_id), F.lit(',"props":'), "props", F.lit("}"))
        .alias("record_json"),
    )


def event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = [*S.RECORD_KEY, "snapshot_ts"]
    return S.dedup_last_write(event_writes(spark, sf_dir), key, "written").withColumn("md5", F.md5("record_json"))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = event_snapshots(spark, sf_dir)
    return S.diff_snapshots(S.previous_snapshot(snapshots), S.latest_snapshot(snapshots))


# Orders are what is stored; line items say what the live index holds, and where.
SYNC_SQL = """
local AS (
  SELECT 'orders' AS index_name, CAST(o_custkey AS VARCHAR) AS doc_key, 'o' || o_orderkey AS object_id,
         'o' || o_orderkey AS node_key,
         '/db/orders/' || o_orderstatus || '/' || year(o_orderdate) AS collection,
         'c' || o_custkey AS document_id,
         '{"objectID":"o' || o_orderkey || '","priority":"' || o_orderpriority || '"}' AS record_json,
         o_orderkey, o_orderpriority
  FROM orders),
live AS (
  SELECT 'orders' AS index_name, 'o' || l_orderkey AS object_id,
         '/db/orders/' || max(l_linestatus) || '/' || year(min(l_shipdate)) AS collection,
         'c' || max(o_custkey) AS document_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey),
leaves AS (SELECT DISTINCT collection FROM (SELECT collection FROM local UNION ALL SELECT collection FROM live)),
trees AS (
  SELECT 'orders' AS index_name, unnest(['/db', '/db/orders']) AS tree
  UNION SELECT 'orders', collection FROM leaves
  UNION SELECT 'orders', substr(collection, 1, length('/db/orders/F')) FROM leaves),
local_t AS (SELECT t.tree, l.* FROM local l JOIN trees t
            ON l.collection = t.tree OR starts_with(l.collection, t.tree || '/')),
live_t AS (SELECT t.tree, v.* FROM live v JOIN trees t
           ON v.collection = t.tree OR starts_with(v.collection, t.tree || '/')),
states AS (
  SELECT coalesce(l.tree, v.tree) AS tree, coalesce(l.object_id, v.object_id) AS object_id,
         l.object_id IS NOT NULL AS is_local, v.object_id IS NOT NULL AS is_live
  FROM local_t l FULL OUTER JOIN live_t v ON l.tree = v.tree AND l.object_id = v.object_id),
wrong AS (
  SELECT d.tree, v.object_id, v.collection
  FROM (SELECT DISTINCT tree, document_id FROM local_t) d JOIN live v USING (document_id)
  WHERE NOT (v.collection = d.tree OR starts_with(v.collection, d.tree || '/'))),
order_status AS (
  SELECT 'orders' AS index_name, collection,
         arg_max(CASE o_orderpriority WHEN '5-LOW' THEN 'degraded' ELSE 'current' END, o_orderkey) AS state
  FROM local GROUP BY collection),
counts AS (
  SELECT tree, count(*) FILTER (is_local) AS local_count, count(*) FILTER (is_live) AS live_count,
         count(*) FILTER (is_local AND NOT is_live) AS missing_count,
         count(*) FILTER (is_live AND NOT is_local) AS unexpected_count
  FROM states GROUP BY tree),
report AS (
  SELECT 'orders' AS index_name, t.tree, coalesce(local_count, 0) AS local_count,
         coalesce(live_count, 0) AS live_count, coalesce(missing_count, 0) AS missing_count,
         coalesce(unexpected_count, 0) AS unexpected_count, coalesce(wrong_path_count, 0) AS wrong_path_count,
         coalesce(document_dirs, 0) AS document_dirs, coalesce(document_ids, 0) AS document_ids,
         s.state AS status_state
  FROM trees t
  LEFT JOIN counts USING (tree)
  LEFT JOIN (SELECT tree, count(*) AS wrong_path_count FROM wrong GROUP BY tree) USING (tree)
  LEFT JOIN (SELECT tree, count(DISTINCT doc_key) AS document_dirs,
                    count(DISTINCT document_id) AS document_ids FROM local_t GROUP BY tree) USING (tree)
  LEFT JOIN order_status s ON s.collection = t.tree),
flagged AS (
  SELECT *, missing_count = 0 AND unexpected_count = 0 AND wrong_path_count = 0 AS synced FROM report),
classified AS (
  SELECT *, CASE WHEN synced AND coalesce(status_state, '') <> 'current' THEN 'stale_status'
                 WHEN synced THEN 'synced'
                 WHEN local_count = 0 AND live_count > 0 THEN 'local_store_corruption'
                 WHEN wrong_path_count > 0 THEN 'wrong_path_drift'
                 WHEN missing_count > 0 AND unexpected_count = 0 THEN 'true_live_loss'
                 ELSE 'mismatch' END AS classification
  FROM flagged)
"""


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    object_id = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("index_name"),
        F.col("o_custkey").cast("string").alias("doc_key"),
        object_id.alias("object_id"),
        object_id.alias("node_key"),
        F.concat(F.lit("/db/orders/"), "o_orderstatus", F.lit("/"), F.year("o_orderdate").cast("string"))
        .alias("collection"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("document_id"),
        F.concat(
            F.lit('{"objectID":'), R.json_string(object_id), F.lit(',"priority":'),
            R.json_string("o_orderpriority"), F.lit("}"),
        ).alias("record_json"),
        "o_orderkey",
        "o_orderpriority",
    )


def live_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A status is one letter; the greatest number is found by hashing, the greatest string by sorting.
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.ascii("l_linestatus")).alias("letter"), F.min("l_shipdate").alias("shipped")
    ).withColumn("status", F.char("letter"))
    owners = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return shipped.join(owners, "l_orderkey").select(
        F.lit("orders").alias("index_name"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("object_id"),
        F.concat(F.lit("/db/orders/"), "status", F.lit("/"), F.year("shipped").cast("string")).alias("collection"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("document_id"),
    )


def order_trees(local: DataFrame, live: DataFrame) -> DataFrame:
    leaves = local.select("index_name", "collection").unionByName(live.select("index_name", "collection"))
    return leaves.distinct().select("index_name", F.explode(P.ancestors("collection")).alias("tree")).distinct()


def order_status(local: DataFrame) -> DataFrame:
    state = F.when(F.col("o_orderpriority") == "5-LOW", "degraded").otherwise("current")
    events = local.select(
        "index_name", "collection", F.lit("batch_write").alias("operation"), state.alias("state"),
        F.col("o_orderkey").cast("string").alias("ts"), F.col("o_orderkey").alias("seq"),
        F.lit(1).cast("bigint").alias("object_count"), F.lit(None).cast("string").alias("failure_class"),
        F.lit(None).cast("string").alias("failure_message"),
    )
    return T.fold_status(T.newest_events(events))


def sync_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    local, live = stored_orders(spark, sf_dir), materialize(live_orders(spark, sf_dir), "live")
    return local, live, order_trees(local, live)


# Documents as XML: one numbered element per line of text.
DOC_NAMESPACE = "urn:documents"


def xml_text(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


def element(name: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>"))


def attribute(name: str, value: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), value, F.lit('"'))


def document_xml(spark: SparkSession, sf_dir: str, *extra: Column, rows: DataFrame | None = None) -> DataFrame:
    rows = spread(table(spark, sf_dir, "documents")) if rows is None else rows
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, n: F.concat(
            F.lit('<p n="'), (n + 1).cast("string"), F.lit('">'), element("t", xml_text(line)), F.lit("</p>")
        ),
    )
    xml = F.concat(
        F.lit(f'<doc xmlns="{DOC_NAMESPACE}"'),
        attribute("xml:id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))),
        attribute("lang", F.col("lang")),
        *extra,
        F.lit(">"),
        element("source", F.col("source")),
        F.array_join(lines, ""),
        F.lit("</doc>"),
    )
    collection = F.concat(F.lit("/db/"), "lang", F.lit("/"), "source")
    return documents_from_table(rows, collection, "lang", "doc_id", xml)


def document_config(*roots: dict, **index: str) -> CollectionConfig:
    return load_config({
        "collection": "/db",
        "namespaces": {"d": DOC_NAMESPACE},
        "indexes": [{"name": "documents", "roots": list(roots), **index}],
    })


WHOLE_DOCUMENT = {"path": "/", "fields": [
    {"name": "line", "path": "/d:doc/d:p/d:t"}, {"name": "lang", "path": "/d:doc/@lang"}]}
LINES = {"path": "/d:doc/d:p", "fields": [
    {"name": "text", "path": "/d:t"}, {"name": "n", "path": "@n", "type": "integer"}]}

# Line n is child n + 3 of the document element, after two attributes and the source.
LINES_SQL = """
docs AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, lang, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS n FROM docs)
"""


# Orders as XML, one document per row, typed fields.
def order_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "orders"))
    xml = F.concat(
        F.lit("<?xml version='1.0'?><?order?><orders><order"),
        attribute("id", F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))),
        attribute("status", F.col("o_orderstatus")),
        F.lit(">"),
        element("customer", F.col("o_custkey").cast("string")),
        element("placed", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("Z"))),
        element("total", F.col("o_totalprice").cast("string")),
        element("priority", F.col("o_orderpriority")),
        element("urgent", (F.col("o_orderpriority") == "1-URGENT").cast("string")),
        F.lit("</order></orders>"),
    )
    collection = F.concat(F.lit("/db/orders/"), "o_orderstatus")
    return documents_from_table(rows, collection, F.lit(7), "o_orderkey", xml)


def order_config(*roots: dict) -> CollectionConfig:
    return load_config({"collection": "/db/orders", "indexes": [{"name": "orders", "roots": list(roots)}]})


TYPED_ORDER = {"path": "/orders/order", "nodeId": "@id", "fields": [
    {"name": "customer", "path": "customer", "type": "integer"},
    {"name": "placed", "path": "placed", "type": "date"},
    {"name": "total", "path": "/total", "type": "float"},
    {"name": "rank", "path": "priority", "type": "integer"},
    {"name": "urgent", "path": "urgent", "type": "boolean"},
    {"name": "status", "path": "@status"}]}


# Turns of conversations as XML, one document per row; user turns have an id.
def turn_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "conversations"))
    key = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    xml = F.concat(
        F.lit("<talk><turn"),
        attribute("role", F.col("role")),
        F.when(F.col("role") == "user", attribute("id", key)).otherwise(F.lit("")),
        F.lit(">"),
        element("text", xml_text("text")),
        F.lit("</turn></talk>"),
    )
    collection = F.concat(F.lit("/db/talk/"), F.col("conv_id").cast("string"))
    return documents_from_table(rows, collection, "conv_id", key, xml)


def turn_config(*roots: dict) -> CollectionConfig:
    return load_config({"collection": "/db/talk", "indexes": [{"name": "turns", "roots": list(roots)}]})


# --- Collection paths, filters, keys --------------------------------------------------------

ORDER_COLLECTION = """'/db/orders/' || o_orderstatus || '/' || year(o_orderdate)"""


@query(f"""SELECT o_orderkey, {ORDER_COLLECTION} AS collection FROM orders
WHERE {ORDER_COLLECTION} = '/db/orders/F' OR starts_with({ORDER_COLLECTION}, '/db/orders/F/')""")
def collection_tree_filter(spark, sf_dir):
    rows = stored_orders(spark, sf_dir)
    return rows.where(P.in_collection_tree("collection", "/db/orders/F")).select("o_orderkey", "collection")


@query("""SELECT page_id,
  TRUE AS under_site,
  TRUE AS under_root,
  regexp_matches(url, '^/*http:(/|$)') AS under_http
FROM pages""")
def path_prefix_test(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    site = F.array_join(F.slice(F.filter(F.split("url", "/"), lambda p: p != ""), 1, 2), "/")
    return pages.select(
        "page_id",
        P.path_starts_with("url", site).alias("under_site"),
        P.path_starts_with("url", F.lit("")).alias("under_root"),
        P.path_starts_with("url", F.lit("http:")).alias("under_http"),
    )


@query("""SELECT page_id, regexp_replace(regexp_replace(url, '^/', ''), '[^A-Za-z0-9._-]', '_', 'g') AS slug,
  '20240101T000000Z__' || regexp_replace(regexp_replace(url, '^/', ''), '[^A-Za-z0-9._-]', '_', 'g') AS quarantine,
  'collection:"' || replace(replace(url, '\\', '\\\\'), '"', '\\"') || '"' AS filter,
  'collection:' || url AS facet, 'documentID = ' || page_id AS numeric_filter, url_encode(url) AS segment
FROM pages""")
def names_and_filters(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        P.slug("url").alias("slug"),
        P.quarantine_name("url", F.lit("20240101T000000Z")).alias("quarantine"),
        P.collection_filter("url").alias("filter"),
        P.collection_facet_filter("url").alias("facet"),
        P.document_filter("page_id").alias("numeric_filter"),
        P.quoted_index_name("url").alias("segment"),
    )


@query("WITH " + SYNC_SQL + """SELECT object_id FROM local WHERE collection = '/db/orders/F/1995'""")
def delete_by_collection(spark, sf_dir):
    return M.delete_by_collection(stored_orders(spark, sf_dir), "/db/orders/F/1995").select("object_id")


@query("WITH " + SYNC_SQL + """SELECT object_id FROM local WHERE document_id = 'c10'""")
def delete_by_document(spark, sf_dir):
    stored = stored_orders(spark, sf_dir).withColumnRenamed("document_id", "user_document_id")
    return M.delete_by_document(stored, "c10").select("object_id")


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'u' || user_id WHEN 'view' THEN 'v' || user_id END AS object_id
FROM events WHERE event_type IN ('click', 'view')""")
def valid_records(spark, sf_dir):
    """Object ids are text for clicks and views, a number, empty or missing for the rest."""
    user = F.col("user_id").cast("string")
    object_id = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('"objectID":"u'), user, F.lit('",')))
        .when(F.col("event_type") == "view", F.concat(F.lit('"objectID":"v'), user, F.lit('",')))
        .when(F.col("event_type") == "error", F.concat(F.lit('"objectID":'), user, F.lit(",")))
        .when(F.col("event_type") == "signup", F.lit('"objectID":"",'))
        .otherwise(F.lit(""))
    )
    record = F.concat(F.lit("{"), object_id, F.lit('"collection":"/db/events","props":'), "props", F.lit("}"))
    rows = table(spark, sf_dir, "events").select("event_id", record.alias("record_json"))
    parsed = rows.select(
        "event_id",
        R.record_text("record_json", "objectID").alias("object_id"),
        R.record_text("record_json", "collection").alias("collection"),
    )
    return Y.valid_records(parsed).select("event_id", "object_id")


@query(f"""WITH configs(path) AS (VALUES ('/db'), ('/db/orders/F'), ('/db/orders/F/1995'), ('/db/orders/O'))
SELECT o_orderkey, arg_max(path, length(path)) AS config
FROM (SELECT o_orderkey, {ORDER_COLLECTION} AS collection FROM orders) o
JOIN configs c ON o.collection = c.path OR starts_with(o.collection, c.path || '/')
GROUP BY o_orderkey""")
def config_resolution(spark, sf_dir):
    paths = ["/db", "/db/orders/F", "/db/orders/F/1995", "/db/orders/O"]
    configs = [load_config({"collection": p, "indexes": []}) for p in paths]
    resolved = X.resolve_config(stored_orders(spark, sf_dir), configs)
    path = F.array(*[F.lit(p) for p in paths])[F.col("config_no")]
    return resolved.select("o_orderkey", path.alias("config"))


@query(f"""SELECT o_orderkey, {ORDER_COLLECTION} AS collection FROM orders WHERE o_orderstatus <> 'F'""")
def unconfigured_documents(spark, sf_dir):
    configs = [load_config({"collection": "/db/orders/F", "indexes": []})]
    documents = stored_orders(spark, sf_dir).select("o_orderkey", "collection", F.lit("").alias("xml"))
    return X.unconfigured_documents(documents, configs)


@query(f"""SELECT DISTINCT 'orders' AS index_name, {ORDER_COLLECTION} AS tree FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW'""")
def removal_scope(spark, sf_dir):
    """Low-priority requests stand for those of a re-index; one status has no configuration."""
    configs = [
        load_config({"collection": c, "indexes": [{"name": "orders", "roots": []}]})
        for c in ("/db/orders/F", "/db/orders/O")
    ]
    requests = stored_orders(spark, sf_dir).select(
        "collection", (F.col("o_orderpriority") == "5-LOW").alias("reindex")
    ).distinct()
    return M.removal_scope(requests, configs).select("index_name", "tree")


@query("""SELECT event_id, coalesce(CASE WHEN event_type = 'click' THEN 'n' || user_id END,
    '3/' || user_id || '/' || coalesce(CASE WHEN event_type <> 'view' THEN '1.' || event_id END, '0')) AS object_id,
  coalesce(CASE WHEN event_type = 'error' THEN 'x' || user_id END, CAST(user_id AS VARCHAR)) AS doc_key,
  coalesce(CASE WHEN event_type = 'click' THEN 'n' || user_id END,
           CASE WHEN event_type <> 'view' THEN '1.' || event_id END, '0') AS node_key,
  coalesce('"' || CASE WHEN event_type = 'error' THEN 'x' || user_id END || '"', CAST(user_id AS VARCHAR)) AS document_json,
  'events|' || coalesce(CASE WHEN event_type <> 'view' THEN '/db/' || event_type END, '*') AS status_key
FROM events""")
def object_ids_and_keys(spark, sf_dir):
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(kind == "click", F.concat(F.lit("n"), user)).alias("user_node_id"),
        F.when(kind != "view", F.concat(F.lit("1."), F.col("event_id").cast("string"))).alias("node_id"),
        F.when(kind == "error", F.concat(F.lit("x"), user)).alias("user_document_id"),
        F.when(kind != "view", F.concat(F.lit("/db/"), kind)).alias("collection"),
    )
    return rows.select(
        "event_id",
        R.object_id("user_node_id", F.lit(3), "user_id", "node_id").alias("object_id"),
        R.doc_key("user_document_id", "user_id").alias("doc_key"),
        R.node_key("user_node_id", "node_id").alias("node_key"),
        R.document_id_json("user_document_id", "user_id").alias("document_json"),
        P.status_key(F.lit("events"), "collection").alias("status_key"),
    )


@query("""SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents""")
def checksum_algorithms(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        R.checksum("text", "MD5").alias("md5"),
        R.checksum("text", "SHA-1").alias("sha1"),
        R.checksum("text", "SHA-256").alias("sha256"),
    )


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey, CAST(NULL AS VARCHAR) AS no_integer,
  CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS total,
  CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' END AS flag,
  CAST(epoch_ms(o_orderdate) AS VARCHAR) AS day, CAST(epoch_ms(o_orderdate) + 3723000 AS VARCHAR) AS moment,
  CAST(epoch_ms(o_orderdate) - 7200000 AS VARCHAR) AS zoned, '"' || o_orderpriority || '"' AS text
FROM orders""")
def typed_literals(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    flag = F.when(status == "F", "True").when(status == "O", "false").otherwise("1")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        R.typed_json(F.col("o_custkey").cast("string"), "integer").alias("custkey"),
        R.typed_json("o_orderpriority", "integer").alias("no_integer"),
        R.typed_json(F.col("o_totalprice").cast("string"), "float").cast("float").cast("double").alias("total"),
        R.typed_json(flag, "boolean").alias("flag"),
        R.typed_json(F.concat(day, F.lit("Z")), "date").alias("day"),
        R.typed_json(F.concat(day, F.lit("T01:02:03Z")), "dateTime").alias("moment"),
        R.typed_json(F.concat(day, F.lit("+02:00")), "date").alias("zoned"),
        R.typed_json("o_orderpriority", "string").alias("text"),
    )


# --- Snapshots and differences --------------------------------------------------------------

_SNAPSHOT = ["index_name", "doc_key", "snapshot_ts", "node_key", "object_id", "collection", "md5"]


@query("WITH " + EVENT_WRITES_SQL + f"SELECT {', '.join(_SNAPSHOT)} FROM snapshots")
def dedup_last_write(spark, sf_dir):
    return event_snapshots(spark, sf_dir).select(*_SNAPSHOT)


@query("WITH " + EVENT_WRITES_SQL + f"SELECT {', '.join(_SNAPSHOT)} FROM latest")
def latest_snapshot(spark, sf_dir):
    return S.latest_snapshot(event_snapshots(spark, sf_dir)).select(*_SNAPSHOT)


@query("WITH " + EVENT_WRITES_SQL + f"SELECT {', '.join(_SNAPSHOT)} FROM previous")
def previous_snapshot(spark, sf_dir):
    return S.previous_snapshot(event_snapshots(spark, sf_dir)).select(*_SNAPSHOT)


@query("WITH " + EVENT_WRITES_SQL + f"""SELECT {', '.join(_SNAPSHOT)} FROM snapshots s
JOIN (SELECT doc_key, max(snapshot_ts) AS snapshot_ts FROM snapshots
      WHERE snapshot_ts < date_diff('day', DATE '1970-01-01', DATE '2024-01-15') GROUP BY doc_key)
USING (doc_key, snapshot_ts)""")
def snapshot_before(spark, sf_dir):
    """The snapshot each document had before a day in the middle of the table."""
    day = F.datediff(F.to_date(F.lit("2024-01-15")), F.to_date(F.lit("1970-01-01")))
    return S.latest_snapshot(event_snapshots(spark, sf_dir), before=day).select(*_SNAPSHOT)


@query("WITH " + EVENT_WRITES_SQL + """SELECT index_name, doc_key, node_key, op, object_id, collection,
  CASE WHEN op <> 'delete' THEN record_json END AS record_json FROM changes""")
def diff_changes(spark, sf_dir):
    snapshots = event_snapshots(spark, sf_dir)
    latest = S.latest_snapshot(snapshots)
    changes = S.diff_snapshots(S.previous_snapshot(snapshots), latest)
    return S.with_record_json(changes, latest).drop("document_id")


@query("WITH " + EVENT_WRITES_SQL + """SELECT collection, count(*) FILTER (op = 'add') AS additions,
  count(*) FILTER (op = 'update') AS updates, count(*) FILTER (op = 'delete') AS deletions
FROM changes GROUP BY collection""")
def diff_counts_by_collection(spark, sf_dir):
    return B.batch_totals(event_changes(spark, sf_dir), ["collection"])


@query("WITH " + EVENT_WRITES_SQL + "SELECT doc_key, node_key, 'add' AS op, object_id FROM latest")
def first_snapshot(spark, sf_dir):
    latest = S.latest_snapshot(event_snapshots(spark, sf_dir))
    nothing = latest.where(F.lit(False))
    return S.diff_snapshots(nothing, latest).select("doc_key", "node_key", "op", "object_id")


@query("WITH " + EVENT_WRITES_SQL + """, ranked AS (
  SELECT doc_key, collection, node_key, CASE op WHEN 'add' THEN 0 ELSE 1 END AS r FROM changes WHERE op <> 'delete'
  UNION ALL SELECT doc_key, collection, node_key, 2 FROM latest
  UNION ALL SELECT doc_key, collection, node_key, 3 FROM previous)
SELECT 'events' AS index_name, doc_key, arg_min(collection, r || node_key) AS collection FROM ranked GROUP BY doc_key""")
def document_collection(spark, sf_dir):
    snapshots = event_snapshots(spark, sf_dir)
    previous, latest = S.previous_snapshot(snapshots), S.latest_snapshot(snapshots)
    return S.document_collection(previous, latest, S.diff_snapshots(previous, latest))


# --- Batches ---------------------------------------------------------------------------------

_RANKED_SQL = """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY collection ORDER BY list_position(['add', 'update', 'delete'], op),
                               md5(object_id), object_id) AS position,
         count(*) OVER (PARTITION BY collection) AS operations FROM changes)
"""


@query("WITH " + EVENT_WRITES_SQL + _RANKED_SQL + """SELECT collection, object_id, op, position,
  (position - 1) // 10 + 1 AS chunk, (operations - 1) // 10 + 1 AS total_chunks FROM ranked""")
def plan_batches(spark, sf_dir):
    planned = B.plan_batches(event_changes(spark, sf_dir), 10, ("index_name", "collection"))
    return planned.select("collection", "object_id", "op", "position", "chunk", "total_chunks")


@query("WITH " + EVENT_WRITES_SQL + _RANKED_SQL + """SELECT index_name, collection, (position - 1) // 10 + 1 AS chunk,
  any_value((operations - 1) // 10 + 1) AS total_chunks, count(*) FILTER (op = 'add') AS additions,
  count(*) FILTER (op = 'update') AS updates, count(*) FILTER (op = 'delete') AS deletions
FROM ranked GROUP BY index_name, collection, chunk""")
def chunk_plan(spark, sf_dir):
    group = ("index_name", "collection")
    return B.chunk_plan(B.plan_batches(event_changes(spark, sf_dir), 10, group), group)


@query("WITH " + EVENT_WRITES_SQL + """SELECT index_name, doc_key, count(*) FILTER (op = 'add') AS additions,
  count(*) FILTER (op = 'update') AS updates, count(*) FILTER (op = 'delete') AS deletions
FROM changes GROUP BY index_name, doc_key""")
def batch_totals(spark, sf_dir):
    return B.batch_totals(event_changes(spark, sf_dir), ["index_name", "doc_key"])


@query("WITH " + EVENT_WRITES_SQL + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY list_position(['add', 'update', 'delete'], op),
                               md5(object_id), object_id) AS position FROM changes),
requests AS (SELECT doc_key, position, (position - 1) // 3 + 1 AS chunk, '{"body":' || CASE op
    WHEN 'delete' THEN '{"objectID":"' || object_id || '"}' ELSE record_json END || ',"action":"' || CASE op
    WHEN 'add' THEN 'addObject' WHEN 'update' THEN 'updateObject' ELSE 'deleteObject' END || '"}' AS request
  FROM ranked)
SELECT doc_key, chunk, count(*) AS requests,
  '{"requests":[' || string_agg(request, ',' ORDER BY position) || ']}' AS body
FROM requests GROUP BY doc_key, chunk""")
def assemble_batches(spark, sf_dir):
    snapshots = event_snapshots(spark, sf_dir)
    latest = S.latest_snapshot(snapshots)
    changes = S.with_record_json(S.diff_snapshots(S.previous_snapshot(snapshots), latest), latest)
    group = ("index_name", "doc_key")
    batches = B.assemble_batches(B.plan_batches(changes, 3, group), group)
    return batches.select("doc_key", "chunk", "requests", "body")


@query("WITH " + EVENT_WRITES_SQL + """SELECT DISTINCT index_name, collection FROM (
  SELECT index_name, collection FROM changes WHERE op <> 'delete'
  UNION ALL SELECT index_name, collection FROM latest)""")
def touched_collections(spark, sf_dir):
    latest = S.latest_snapshot(event_snapshots(spark, sf_dir))
    return B.touched_collections(event_changes(spark, sf_dir), latest)


# --- Store against live index ----------------------------------------------------------------


@query("WITH " + SYNC_SQL + "SELECT collection, count(*) AS n FROM live GROUP BY collection")
def count_by_collection(spark, sf_dir):
    return Y.count_by_collection(live_orders(spark, sf_dir))


@query("WITH " + SYNC_SQL + """SELECT object_id, doc_key, collection FROM local
WHERE starts_with(collection, '/db/orders/F/')""")
def local_state(spark, sf_dir):
    return S.local_state(stored_orders(spark, sf_dir), "/db/orders/F").select("object_id", "doc_key", "collection")


@query("WITH " + SYNC_SQL + """SELECT object_id FROM local
WHERE NOT EXISTS (SELECT 1 FROM live WHERE live.object_id = local.object_id)""")
def missing_in_live(spark, sf_dir):
    return Y.missing_in_live(stored_orders(spark, sf_dir), live_orders(spark, sf_dir)).select("object_id")


@query("WITH " + SYNC_SQL + "SELECT object_id FROM states WHERE tree = '/db/orders/O' AND is_live AND NOT is_local")
def unexpected_in_live(spark, sf_dir):
    local = M.delete_by_tree(stored_orders(spark, sf_dir), "/db/orders/O")
    live = M.delete_by_tree(live_orders(spark, sf_dir), "/db/orders/O")
    return Y.unexpected_in_live(local, live).select("object_id")


@query("WITH " + SYNC_SQL + "SELECT object_id, collection FROM wrong WHERE tree = '/db/orders/P'")
def wrong_path_live(spark, sf_dir):
    found = Y.wrong_path_live(stored_orders(spark, sf_dir), live_orders(spark, sf_dir), "/db/orders/P")
    return found.select("object_id", "collection")


@query("WITH " + SYNC_SQL + "SELECT tree, object_id, is_local, is_live FROM states")
def object_states(spark, sf_dir):
    return Y.object_states(*sync_inputs(spark, sf_dir)).drop("index_name")


@query("WITH " + SYNC_SQL + "SELECT DISTINCT tree, doc_key FROM local_t")
def matching_documents(spark, sf_dir):
    local, _live, trees = sync_inputs(spark, sf_dir)
    return Y.matching_documents(local, trees).select("tree", "doc_key")


@query("WITH " + SYNC_SQL + """SELECT tree, 'local' AS side, collection, count(*) AS n FROM local_t GROUP BY ALL
UNION ALL SELECT tree, 'live', collection, count(*) FROM live_t GROUP BY ALL
UNION ALL SELECT tree, 'wrong_path', collection, count(*) FROM wrong GROUP BY ALL""")
def sync_counts(spark, sf_dir):
    counted = Y.sync_counts(*sync_inputs(spark, sf_dir), live_staged=True)
    return counted.select("tree", "side", "collection", F.col("n").cast("bigint").alias("n"))


def _sample_sql(source: str, where: str, name: str) -> str:
    return f"""LEFT JOIN (SELECT tree, string_agg(object_id, ',' ORDER BY object_id) AS {name} FROM (
  SELECT tree, object_id, row_number() OVER (PARTITION BY tree ORDER BY object_id) AS rn FROM {source} {where})
  WHERE rn <= 5 GROUP BY tree) USING (tree) """


@query("WITH " + SYNC_SQL + """SELECT tree, local_count, live_count, missing_count, unexpected_count,
  CAST(wrong_path_count AS BIGINT) AS wrong_path_count, document_dirs, document_ids,
  CAST(live_count + wrong_path_count AS BIGINT) AS replay_delete_count, local_count AS replay_upload_count, synced,
  classification, coalesce(sample_missing, '') AS sample_missing, coalesce(sample_unexpected, '') AS sample_unexpected,
  coalesce(sample_wrong_path, '') AS sample_wrong_path FROM classified """
       + _sample_sql("states", "WHERE is_local AND NOT is_live", "sample_missing")
       + _sample_sql("states", "WHERE is_live AND NOT is_local", "sample_unexpected")
       + _sample_sql("wrong", "", "sample_wrong_path"))
def sync_report(spark, sf_dir):
    local, live, trees = sync_inputs(spark, sf_dir)
    report = Y.sync_report(local, live, trees, order_status(local), live_staged=True)
    samples = ("sample_missing", "sample_unexpected", "sample_wrong_path")
    for name in samples:
        report = report.withColumn(name, F.array_join(name, ","))
    return report.drop("index_name")


@query("WITH " + SYNC_SQL + """SELECT tree, classification, CASE classification WHEN 'synced' THEN 'none'
  WHEN 'stale_status' THEN 'refresh status' ELSE 'inspect, then replay: deletes ' || (live_count + wrong_path_count)
  || ' live object(s), uploads ' || local_count || ' object(s)' END AS action FROM classified""")
def recommend_action(spark, sf_dir):
    local, live, trees = sync_inputs(spark, sf_dir)
    report = Y.sync_report(local, live, trees, order_status(local), live_staged=True)
    return Y.recommend_action(report).select("tree", "classification", "action")


_REPLAY_SQL = """, plan AS (
  SELECT 1 AS action_rank, 'delete' AS op, object_id, CAST(NULL AS VARCHAR) AS record_json FROM (
    SELECT object_id FROM live_t WHERE tree = '/db/orders/F'
    UNION SELECT object_id FROM wrong WHERE tree = '/db/orders/F')
  UNION ALL SELECT 2, 'add', object_id, record_json FROM local_t WHERE tree = '/db/orders/F')
"""


@query("WITH " + SYNC_SQL + _REPLAY_SQL + "SELECT * FROM plan")
def replay_plan(spark, sf_dir):
    plan = Y.replay_plan(stored_orders(spark, sf_dir), live_orders(spark, sf_dir), "/db/orders/F")
    return plan.drop("index_name")


@query("WITH " + SYNC_SQL + _REPLAY_SQL + """, placed AS (
  SELECT *, row_number() OVER (ORDER BY action_rank, object_id) AS position, count(*) OVER () AS total FROM plan)
SELECT (position - 1) // 500 + 1 AS chunk, any_value((total - 1) // 500 + 1) AS total_chunks, count(*) AS requests,
  CASE WHEN min(action_rank) <> max(action_rank) THEN 2 WHEN min(action_rank) = 1 THEN 1 ELSE 3 END AS phase,
  md5('{"requests":[' || string_agg(CASE op WHEN 'delete' THEN '{"body":{"objectID":"' || object_id
    || '"},"action":"deleteObject"}' ELSE '{"body":' || record_json || ',"action":"addObject"}' END, ','
    ORDER BY position) || ']}') AS body_md5
FROM placed GROUP BY chunk""")
def replay_in_batches(spark, sf_dir):
    plan = Y.replay_plan(stored_orders(spark, sf_dir), live_orders(spark, sf_dir), "/db/orders/F")
    batches = replay_batches(plan)
    return batches.select("chunk", "total_chunks", "requests", "phase", F.md5("body").alias("body_md5"))


# --- Status ----------------------------------------------------------------------------------

STATUS_SQL = """
status_events AS (
  SELECT 'users' AS index_name, CASE WHEN event_type <> 'view' THEN '/db/users/' || user_id END AS collection,
         event_type AS operation, CASE event_type WHEN 'error' THEN 'degraded' WHEN 'signup' THEN 'stale_local_store'
           ELSE 'current' END AS state,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id AS seq,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS object_count,
         CASE WHEN event_type = 'error' THEN 'Rejected' END AS failure_class,
         CASE WHEN event_type = 'error' THEN props END AS failure_message
  FROM events),
status AS (
  SELECT e.index_name, e.collection, e.operation, e.state, e.ts, s.last_success_ts, e.object_count,
         e.failure_class, e.failure_message
  FROM (SELECT *, row_number() OVER (PARTITION BY index_name, collection ORDER BY seq DESC) AS rn
        FROM status_events) e
  JOIN (SELECT index_name, collection, arg_max(ts, seq) FILTER (state = 'current') AS last_success_ts
        FROM status_events GROUP BY ALL) s
  ON e.index_name = s.index_name AND e.collection IS NOT DISTINCT FROM s.collection
  WHERE rn = 1)
"""


def user_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    error = kind == "error"
    events = table(spark, sf_dir, "events").select(
        F.lit("users").alias("index_name"),
        F.when(kind != "view", F.concat(F.lit("/db/users/"), F.col("user_id").cast("string"))).alias("collection"),
        kind.alias("operation"),
        F.when(error, T.DEGRADED).when(kind == "signup", T.STALE).otherwise(T.CURRENT).alias("state"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.col("event_id").alias("seq"),
        F.get_json_object("props", "$.k").cast("bigint").alias("object_count"),
        F.when(error, F.lit("Rejected")).alias("failure_class"),
        F.when(error, F.col("props")).alias("failure_message"),
    )
    return T.fold_status(events)


@query("WITH " + STATUS_SQL + "SELECT * FROM status")
def status_fold(spark, sf_dir):
    return user_status(spark, sf_dir)


@query("WITH " + STATUS_SQL + """SELECT 'records' AS list, * FROM status
UNION ALL SELECT 'health', * FROM status WHERE collection IS NOT NULL""")
def status_document(spark, sf_dir):
    """The status table as one JSON document, written over an older one and read back."""
    path = f"{staging_path(spark, 'status')}/status.json"
    status = user_status(spark, sf_dir)
    for rows in (status.limit(0), status):
        write_status_document(rows, path)
    records, health = read_status_document(spark, path)
    return records.withColumn("list", F.lit("records")).unionByName(health.withColumn("list", F.lit("health")))


@query("WITH " + STATUS_SQL + """SELECT index_name, collection, state, failure_class FROM status
WHERE state IN ('degraded', 'stale_local_store')""")
def status_gate(spark, sf_dir):
    return T.status_gate(user_status(spark, sf_dir)).select("index_name", "collection", "state", "failure_class")


@query("WITH " + STATUS_SQL + """SELECT 'users' AS index_name, '/db/users/' || c_custkey AS collection, state, ts
FROM customer LEFT JOIN status ON status.collection = '/db/users/' || c_custkey""")
def status_lookup(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select(
        F.lit("users").alias("index_name"),
        F.concat(F.lit("/db/users/"), F.col("c_custkey").cast("string")).alias("collection"),
    )
    return T.status_for(user_status(spark, sf_dir), keys).select("index_name", "collection", "state", "ts")


@query("WITH " + SYNC_SQL + """SELECT tree AS collection, 'manual_refresh' AS operation, 'current' AS state,
  'now' AS last_success_ts, count(*) AS object_count
FROM (SELECT t.tree, l.object_id FROM local l JOIN (
  SELECT DISTINCT unnest(['/db', '/db/orders', substr(collection, 1, 12), collection]) AS tree FROM local) t
  ON l.collection = t.tree OR starts_with(l.collection, t.tree || '/')) GROUP BY tree""")
def refresh_status(spark, sf_dir):
    """The stored orders compared with themselves are in step, so every tree may be refreshed."""
    local = stored_orders(spark, sf_dir).withColumn("document_id", F.lit(None).cast("string"))
    status = order_status(local)
    report = Y.sync_report(local, local, order_trees(local, local), status)
    fresh = T.refresh_status(report, status, "now")
    return fresh.select("collection", "operation", "state", "last_success_ts", "object_count")


# --- Removal ---------------------------------------------------------------------------------


@query("WITH " + SYNC_SQL + """SELECT DISTINCT tree, object_id FROM local_t l
WHERE NOT EXISTS (SELECT 1 FROM local_t u WHERE u.tree = l.tree AND u.doc_key = l.doc_key
                  AND u.o_orderpriority = '1-URGENT')""")
def removal_candidates(spark, sf_dir):
    """Customers with an urgent order in a tree stand for documents written again since."""
    local, _live, trees = sync_inputs(spark, sf_dir)
    urgent = local.where("o_orderpriority = '1-URGENT'")
    touched = Y.in_trees(urgent, trees).select("index_name", "tree", "doc_key").distinct()
    return M.removal_candidates(local, trees, touched).select("tree", "object_id")


@query("WITH " + SYNC_SQL + """SELECT DISTINCT '/db/orders/' || l_returnflag AS tree FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM local WHERE starts_with(local.collection, '/db/orders/' || l_returnflag || '/'))""")
def stale_removals(spark, sf_dir):
    """Line items ask for trees named by status and by return flag; only the former hold orders."""
    items = table(spark, sf_dir, "lineitem")
    names = items.select(F.explode(F.array("l_linestatus", "l_returnflag")).alias("name")).distinct()
    requests = names.select(F.lit("orders").alias("index_name"), F.concat(F.lit("/db/orders/"), "name").alias("tree"))
    return M.stale_removals(stored_orders(spark, sf_dir), requests).select("tree")


@query("WITH " + SYNC_SQL + """SELECT o_orderkey, doc_key FROM local l
WHERE o_orderkey > (SELECT coalesce(max(r.o_orderkey), -1) FROM local r
  WHERE r.o_orderpriority = '5-LOW' AND r.collection = l.collection)""")
def events_after_removal(spark, sf_dir):
    """Low-priority orders stand for removals of their collection; order keys are the sequence."""
    local = stored_orders(spark, sf_dir)
    events = local.select("doc_key", "collection", F.col("o_orderkey").alias("sequence"))
    removals = local.where("o_orderpriority = '5-LOW'").select(
        F.col("collection").alias("tree"), F.col("o_orderkey").alias("sequence")
    )
    kept = M.covered_by_removal(events, removals)
    return kept.select(F.col("sequence").alias("o_orderkey"), "doc_key")


@query("WITH " + EVENT_WRITES_SQL + """SELECT doc_key, node_key, object_id FROM latest
WHERE doc_key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def document_removals(spark, sf_dir):
    """Users who are customers of one segment are removed; the others asked for have nothing stored."""
    latest = S.latest_snapshot(event_snapshots(spark, sf_dir))
    asked = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.lit("events").alias("index_name"), F.col("c_custkey").cast("string").alias("doc_key")
    )
    return M.document_removals(latest, asked).select("doc_key", "node_key", "object_id")


# --- XML to records --------------------------------------------------------------------------


@query("WITH " + LINES_SQL + """SELECT doc_id, '1.' || (n + 3) || '.2' AS node_id, 'element' AS kind, 3 AS depth,
  line AS value FROM lines""")
def select_nodes_by_path(spark, sf_dir):
    nodes = select_nodes(document_xml(spark, sf_dir), "/d:doc/d:p/d:t", {"d": DOC_NAMESPACE})
    return nodes.select(F.col("document_id").alias("doc_id"), "node_id", "kind", "depth", "value")


@query("WITH " + LINES_SQL + """SELECT doc_id, '//d:t' AS path, '1.' || (n + 3) || '.2' AS node_id, line AS value FROM lines
UNION ALL SELECT doc_id, '/*/@lang', '1.2', lang FROM documents
UNION ALL SELECT doc_id, '//d:p[@n = ''2'']//d:t', '1.5.2', line FROM lines WHERE n = 2
UNION ALL SELECT doc_id, '/d:doc[@lang ne ''en'']/d:source', '1.3', source FROM documents WHERE lang <> 'en'
UNION ALL SELECT doc_id, '/d:doc/d:source', '1.3', '"#text":"' || source || '"' FROM documents""")
def node_table(spark, sf_dir):
    """Wildcards, descendants, predicates on any step, and the JSON body of an object."""
    paths = ["//d:t", "/*/@lang", "//d:p[@n = '2']//d:t", "/d:doc[@lang ne 'en']/d:source"]
    nodes = shred_xml(document_xml(spark, sf_dir), paths, {"d": DOC_NAMESPACE}, ["/d:doc/d:source"])
    return nodes.select(F.col("document_id").alias("doc_id"), "path", "node_id", "value")


@query("WITH " + LINES_SQL + """SELECT doc_id, '1.' || (n + 3) AS node_key,
  lang || '/' || doc_id || '/1.' || (n + 3) AS object_id, CAST(doc_id AS VARCHAR) AS doc_key,
  md5('{"objectID":"' || lang || '/' || doc_id || '/1.' || (n + 3) || '","collection":"/db/' || lang || '/' || source
      || '","documentID":' || doc_id || ',"n":' || n || ',"text":' || CAST(to_json(line) AS VARCHAR) || '}') AS md5
FROM lines""")
def xml_line_records(spark, sf_dir):
    """One record per line of text, identified by its node number; the attribute comes first in the document."""
    records = X.extract_records(document_xml(spark, sf_dir), [document_config(LINES)])
    return records.select(F.col("document_id").alias("doc_id"), "node_key", "object_id", "doc_key", "md5")


@query("WITH " + LINES_SQL + """SELECT doc_id, 'd' || doc_id AS user_document_id, source AS visible_by,
  '{"objectID":"' || lang || '/' || doc_id || '/0","collection":"/db/' || lang || '/' || source
  || '","documentID":"d' || doc_id || '","visible_by":"' || source || '","lang":"' || lang || '","line":'
  || CASE WHEN len(lines) > 1 THEN CAST(to_json(lines) AS VARCHAR) ELSE CAST(to_json(lines[1]) AS VARCHAR) END
  || '}' AS record_json
FROM docs""")
def xml_document_records(spark, sf_dir):
    """One record per document, with ids of its own, all lines in one field, scalar if there is one."""
    config = document_config(WHOLE_DOCUMENT, documentId="/d:doc/@xml:id", visibleBy="/d:doc/d:source")
    records = X.extract_records(document_xml(spark, sf_dir), [config])
    return records.select(
        F.col("document_id").alias("doc_id"), "user_document_id", "visible_by", "record_json"
    )


@query("""SELECT o_orderkey, 'o' || o_orderkey AS object_id, '{"objectID":"o' || o_orderkey
  || '","collection":"/db/orders/' || o_orderstatus || '","documentID":' || o_orderkey || ',"status":"'
  || o_orderstatus || '","customer":' || o_custkey || ',"placed":' || epoch_ms(o_orderdate) || ',"total":#,"urgent":'
  || CASE o_orderpriority WHEN '1-URGENT' THEN 'true' ELSE 'false' END || '}' AS record_json,
  CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS total, 1 AS bad_literals
FROM orders""")
def xml_typed_records(spark, sf_dir):
    """Typed fields; the priority is not an integer, so that field is left out and counted.

    Engines write floats differently, so that number is compared as one.
    """
    records = X.extract_records(order_xml(spark, sf_dir), [order_config(TYPED_ORDER)])
    return records.select(
        F.col("document_id").alias("o_orderkey"),
        "object_id",
        F.regexp_replace("record_json", '"total":[0-9.]+', '"total":#').alias("record_json"),
        F.get_json_object("record_json", "$.total").cast("float").cast("double").alias("total"),
        "bad_literals",
    )


@query("""SELECT o_orderkey, '{"objectID":"7/' || o_orderkey || '/0","collection":"/db/orders/' || o_orderstatus
  || '","documentID":' || o_orderkey || ',"order":{"nodeId":"2.1","id":"o' || o_orderkey || '","status":"'
  || o_orderstatus || '","customer":"' || o_custkey || '","placed":"' || strftime(o_orderdate, '%Y-%m-%d')
  || 'Z","total":"' || o_totalprice || '","priority":"' || o_orderpriority || '","urgent":"'
  || CASE o_orderpriority WHEN '1-URGENT' THEN 'true' ELSE 'false' END || '"}}' AS record_json
FROM orders""")
def xml_object_records(spark, sf_dir):
    """The order element as a nested object; a processing instruction before the root is node 1."""
    root = {"path": "/", "fields": [{"name": "order", "path": "/orders/order", "kind": "object"}]}
    records = X.extract_records(order_xml(spark, sf_dir), [order_config(root)])
    return records.select(F.col("document_id").alias("o_orderkey"), "record_json")


@query("""SELECT conv_id || '-' || turn AS document_id, CASE role WHEN 'user' THEN text END AS question,
  CASE role WHEN 'assistant' THEN text END AS answer, CASE WHEN role <> 'user' THEN text END AS other
FROM conversations""")
def xml_predicates(spark, sf_dir):
    """`eq`, `=` and `ne` on an inner step of field paths."""
    root = {"path": "/talk", "fields": [
        {"name": "question", "path": "/turn[@role eq 'user']/text"},
        {"name": "answer", "path": "/turn[@role = 'assistant']/text"},
        {"name": "other", "path": "/turn[@role ne 'user']/text"}]}
    records = X.extract_records(turn_xml(spark, sf_dir), [turn_config(root)])
    return records.select(
        "document_id", *[F.get_json_object("record_json", f"$.{n}").alias(n) for n in ("question", "answer", "other")]
    )


@query("""SELECT conv_id || '-' || turn AS document_id, '/talk/turn[@role eq ''user'']' AS root_path,
  conv_id || '-' || turn AS node_key FROM conversations WHERE role = 'user'
UNION ALL SELECT conv_id || '-' || turn, '/talk/*', '1.1' FROM conversations""")
def xml_root_objects(spark, sf_dir):
    """Two root configurations of one index, one with a predicate and a node id, one with a wildcard."""
    roots = ({"path": "/talk/turn[@role eq 'user']", "nodeId": "@id"}, {"path": "/talk/*"})
    records = X.extract_records(turn_xml(spark, sf_dir), [turn_config(*roots)])
    return records.select("document_id", "root_path", "node_key")


@query("""SELECT 'turns' AS index_name, '/db/talk/' || conv_id AS collection, conv_id || '-' || turn AS document_id,
  '/talk/turn/@id' AS configured_path, CAST(1 AS BIGINT) AS affected FROM conversations WHERE role <> 'user'""")
def xml_fallback_report(spark, sf_dir):
    """Only user turns carry the configured node id."""
    root = {"path": "/talk/turn", "nodeId": "@id"}
    return X.fallback_report(X.extract_records(turn_xml(spark, sf_dir), [turn_config(root)]))


@query("""SELECT 'turns' AS index_name, '/db/talk/' || conv_id AS collection, conv_id || '-' || turn AS document_id,
  CAST(CASE role WHEN 'user' THEN 1 ELSE 0 END AS BIGINT) AS root_objects FROM conversations""")
def xml_extraction_report(spark, sf_dir):
    configs = [turn_config({"path": "/talk/turn[@role eq 'user']"})]
    documents = X.resolve_config(turn_xml(spark, sf_dir), configs)
    shredded = shred_documents(documents, configs)
    return X.extraction_report(X.processed_documents(shredded, configs), X.build_records(shredded, configs))


@query("""SELECT 'turns' AS index_name, role || '-' || length(text) AS object_id, count(*) AS n
FROM conversations GROUP BY ALL HAVING count(*) > 1""")
def xml_duplicate_ids(spark, sf_dir):
    """Node ids a user chose need not be unique: here role and length of a turn."""
    rows = table(spark, sf_dir, "conversations")
    key = F.concat("role", F.lit("-"), F.length("text").cast("string"))
    xml = F.concat(F.lit("<turn"), attribute("id", key), F.lit("/>"))
    where = F.concat(F.lit("/db/talk/"), F.col("conv_id").cast("string"))
    documents = documents_from_table(rows, where, "conv_id", "turn", xml)
    root = {"path": "/turn", "nodeId": "@id"}
    return X.duplicate_object_ids(X.extract_records(documents, [turn_config(root)]))


@query("""SELECT doc_id FROM documents d JOIN labels USING (doc_id) WHERE toxic = 1""")
def xml_malformed_documents(spark, sf_dir):
    """Documents labelled toxic are rendered without their closing tag."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    closing = F.when(F.col("toxic") == 1, "").otherwise("</d>")
    xml = F.concat(F.lit("<d>"), xml_text("text"), closing)
    documents = documents_from_table(rows, F.lit("/db"), "lang", "doc_id", xml)
    return malformed_documents(documents).select(F.col("document_id").alias("doc_id"))


# --- Whole flows -----------------------------------------------------------------------------


def _job(spark: SparkSession, *configs: CollectionConfig) -> Job:
    path = staging_path(spark, "job")
    return Job.at(spark, path, list(configs), FilePublisher(f"{path}/requests"))


def labelled_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality as one more attribute, where it is known."""
    rows = spread(table(spark, sf_dir, "documents")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    quality = F.when(F.col("quality").isNotNull(), attribute("quality", F.col("quality").cast("string")))
    return document_xml(spark, sf_dir, F.coalesce(quality, F.lit("")), rows=rows)


QUALITY_DOCUMENT = {"path": "/d:doc", "nodeId": "@xml:id", "fields": [
    {"name": "quality", "path": "@quality", "type": "integer"}, {"name": "line", "path": "/d:p/d:t"}]}


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_key, 'current' AS state, CAST(1 AS BIGINT) AS object_count
FROM documents JOIN labels USING (doc_id)""")
def index_changed_documents(spark, sf_dir):
    """All documents are indexed, then once more with labels: only labelled ones are sent again."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    outcomes = index_documents(job, labelled_xml(spark, sf_dir), "second", 2)
    return outcomes.select("doc_key", "state", "object_count")


@query("""SELECT doc_id, lang, CAST(CASE WHEN quality IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS snapshot_ts
FROM documents LEFT JOIN labels USING (doc_id)
WHERE lang <> 'en' AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = doc_id AND c_mktsegment = 'BUILDING')""")
def stored_after_removals(spark, sf_dir):
    """Two runs, then one collection tree and some documents are removed; the rest stays stored."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    index_documents(job, labelled_xml(spark, sf_dir), "second", 2)
    tree = spark.createDataFrame([("documents", "/db/en")], "index_name string, tree string")
    remove_collections(job, tree, "third", 3)
    gone = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.lit("documents").alias("index_name"), F.col("c_custkey").cast("string").alias("doc_key")
    )
    remove_documents(job, gone, "fourth", 4)
    return job.store.latest().select(
        F.col("doc_key").cast("bigint").alias("doc_id"), F.split("collection", "/")[2].alias("lang"), "snapshot_ts"
    )


@query("""SELECT CAST(c_custkey AS VARCHAR) AS doc_key, d.doc_id IS NOT NULL AS moved,
  CASE WHEN d.doc_id IS NULL THEN 'missing-source' END AS reason
FROM customer LEFT JOIN documents d ON d.doc_id = c_custkey""")
def quarantine_documents(spark, sf_dir):
    """Documents named by customer keys are set aside; keys without a document are reported."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    asked = table(spark, sf_dir, "customer").select(
        F.lit("documents").alias("index_name"), F.col("c_custkey").cast("string").alias("doc_key")
    )
    return job.store.quarantine(asked, "20240101T000000Z__db").select("doc_key", "moved", "reason")


@query("""SELECT '/db/' || lang || '/' || source AS collection, 'current' AS state, count(*) AS object_count
FROM documents GROUP BY ALL""")
def status_after_indexing(spark, sf_dir):
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    return job.status.read().select("collection", "state", "object_count")


@query("""SELECT 'd' || doc_id AS object_id, '/db/' || lang || '/' || source AS collection FROM documents
WHERE lang <> 'de'""")
def stream_incremental(spark, sf_dir):
    """Documents arrive as a stream of events; then one collection tree is removed."""
    path = staging_path(spark, "stream")
    job = Job.at(spark, path, [document_config(QUALITY_DOCUMENT)], FilePublisher(f"{path}/requests"))
    # As a pattern the table may be one file or a folder of parts.
    arriving = (
        spark.readStream.schema(table(spark, sf_dir, "documents").schema)
        .parquet(f"{sf_dir.rstrip('/')}/{{documents}}.parquet")
    )
    events = document_xml(spark, sf_dir, rows=arriving).select(
        F.col("document_id").alias("sequence"), F.lit("upsert").alias("op"), "collection",
        "collection_id", "document_id", F.lit(None).cast("string").alias("user_document_id"), "xml",
    )
    start_incremental(job, events, f"{path}/checkpoint", availableNow=True).awaitTermination()
    tree = spark.createDataFrame([("documents", "/db/de")], "index_name string, tree string")
    remove_collections(job, tree, "removal", job.now_millis() + 10)
    return job.store.latest().select("object_id", "collection")


# --- Files, publishing, repair: whole flows ---------------------------------------------------

# Documents as files in two folders with equal names.
FILE_SQL = """
files AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS folder, CAST(doc_id // 2 AS VARCHAR) || '.xml' AS name
          FROM documents)
"""


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with every document as an XML file."""
    path = staging_path(spark, "files")
    number = F.regexp_extract(F.col("xml"), 'xml:id="d([0-9]+)"', 1).cast("bigint")
    folder = F.when(number % 2 == 0, "even/").otherwise("odd/")
    name = F.concat(folder, F.floor(number / 2).cast("string"), F.lit(".xml"))
    materialize(write_documents(document_xml(spark, sf_dir).select(name.alias("name"), F.col("xml").alias("content")), path), "written")
    return path


@query("WITH " + FILE_SQL + """SELECT folder || '/' || name AS document_id, '/db/' || folder AS collection,
  'd' || doc_id AS object_id, md5('{"objectID":"d' || doc_id || '","collection":"/db/' || folder || '","documentID":"' || folder
    || '/' || name || '","line":' || CASE WHEN contains(text, chr(10)) THEN CAST(to_json(string_split(text, chr(10))) AS VARCHAR)
    ELSE CAST(to_json(text) AS VARCHAR) END || '}') AS md5
FROM files""")
def records_from_files(spark, sf_dir):
    """Documents are written as files, read back by folder and extracted."""
    documents = read_documents(spark, document_files(spark, sf_dir), "/db")
    records = X.extract_records(documents, [document_config(QUALITY_DOCUMENT)])
    return records.select(F.col("document_id").cast("string").alias("document_id"), "collection", "object_id", "md5")


@query("WITH " + FILE_SQL + """SELECT 'd' || doc_id AS object_id, '/db/' || folder AS collection,
  folder || '/' || name AS document_id FROM files WHERE folder <> 'odd'""")
def index_from_file_stream(spark, sf_dir):
    """Files arrive as a stream of events and are indexed; then one of the two folders is removed."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    path = document_files(spark, sf_dir)
    events = upserts(stream_documents(spark, path, "/db"))
    start_incremental(job, events, f"{job.store.path}/checkpoint", availableNow=True).awaitTermination()
    tree = spark.createDataFrame([("documents", "/db/odd")], "index_name string, tree string")
    remove_collections(job, tree, "removal", job.now_millis() + 10)
    return job.store.listing().select("object_id", "collection", "document_id")


@query("""SELECT doc_id, 'now' AS seen, CAST(CASE WHEN quality IS NULL THEN 100 ELSE 200 END AS BIGINT) AS snapshot_ts
FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT doc_id, 'then', 100 FROM documents
UNION ALL SELECT doc_id, 'sent late', 100 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def late_documents(spark, sf_dir):
    """The later version comes first, where there is one: the earlier one only joins the history."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("document_id"))
    later = labelled_xml(spark, sf_dir).join(labels, "document_id", "left_semi").withColumn("at", F.lit(200))
    index_documents(job, later, "first", event_time="at")
    sent = index_documents(job, document_xml(spark, sf_dir).withColumn("at", F.lit(100)), "second", event_time="at")

    def rows(df: DataFrame, seen: str, ts: Column) -> DataFrame:
        return df.select(F.col("doc_key").cast("bigint").alias("doc_id"), F.lit(seen).alias("seen"), ts.cast("bigint").alias("snapshot_ts"))

    return (
        rows(job.store.latest(), "now", F.col("snapshot_ts"))
        .unionByName(rows(job.store.latest(F.lit(150)), "then", F.col("snapshot_ts")))
        .unionByName(rows(sent, "sent late", F.lit(100)))
    )


@query("WITH " + LINES_SQL + """SELECT 'lines' AS index_name, doc_id, count(*) AS n, 'listed' AS seen FROM lines GROUP BY doc_id
UNION ALL SELECT 'lines', doc_id, count(*), 'stored' FROM lines GROUP BY doc_id""")
def drop_one_of_two_indexes(spark, sf_dir):
    """Every document feeds two indexes; one of them is dropped, the other is left whole."""
    job = _job(spark, load_config({
        "collection": "/db", "namespaces": {"d": DOC_NAMESPACE},
        "indexes": [{"name": "documents", "roots": [QUALITY_DOCUMENT]}, {"name": "lines", "roots": [LINES]}],
    }))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    drop_index(job, "documents")

    def counts(rows: DataFrame, seen: str) -> DataFrame:
        found = rows.groupBy("index_name", F.col("doc_key").cast("bigint").alias("doc_id")).agg(F.count("*").alias("n"))
        return found.withColumn("seen", F.lit(seen))

    return counts(job.store.listing(), "listed").unionByName(counts(job.store.latest(), "stored"))


@query("WITH " + EVENT_WRITES_SQL + """, batches AS (
  SELECT doc_key, (row_number() OVER (PARTITION BY doc_key ORDER BY list_position(['add', 'update', 'delete'], op),
                   md5(object_id), object_id) - 1) // 2 + 1 AS chunk FROM changes)
SELECT doc_key, CAST(chunk AS BIGINT) AS chunk, CASE WHEN CAST(doc_key AS INT) % 3 = 0 THEN 'degraded' ELSE 'current' END AS first_state,
  CASE WHEN CAST(doc_key AS INT) % 3 = 0 THEN 3 WHEN CAST(doc_key AS INT) % 3 = 1 THEN 2 ELSE 1 END AS first_attempts,
  'current' AS second_state, CASE WHEN CAST(doc_key AS INT) % 3 = 1 THEN 2 ELSE 1 END AS second_attempts,
  CAST(1 AS BIGINT) AS acknowledgements, CASE WHEN CAST(doc_key AS INT) % 3 = 0 THEN 2 ELSE 1 END AS run
FROM (SELECT DISTINCT doc_key, chunk FROM batches)""")
def publish_acknowledged(spark, sf_dir):
    """A transport that fails by a rule, run twice: every batch is accepted once, what was is not sent again.

    Keys that divide by three are refused throughout the first run; the next ones once.
    """
    def transport(failing: str):
        tried = set()

        def call(index_name: str, body: str) -> str:
            user = int(re.search(r'"objectID":"(\d+)/', body).group(1))
            if failing and (user % 3 == 0 or user % 3 == 1 and body not in tried):
                tried.add(body)
                raise TransportError("busy", 503)
            return failing or "second"

        return call

    snapshots = event_snapshots(spark, sf_dir)
    latest = S.latest_snapshot(snapshots)
    changes = S.with_record_json(S.diff_snapshots(S.previous_snapshot(snapshots), latest), latest)
    group = ("index_name", "doc_key")
    batches = materialize(B.assemble_batches(B.plan_batches(changes, 2, group), group), "batches")
    acks = staging_path(spark, "acks")
    runs = [
        CallPublisher(transport(name), first_delay=0.0, lanes=4, acks=acks).publish(batches, "c").select(
            "doc_key", "chunk", F.col("state").alias(f"{state}_state"), F.col("attempts").alias(f"{state}_attempts"),
            F.col("ack").alias(f"{state}_ack"))
        for name, state in (("first", "first"), ("", "second"))
    ]
    kept = spark.read.json(f"{acks}/commit=c").groupBy("digest").agg(F.count("*").alias("acknowledgements"))
    both = runs[0].join(runs[1], ["doc_key", "chunk"]).join(
        batches.select("doc_key", "chunk", batch_digest(batches).alias("digest")), ["doc_key", "chunk"]
    )
    return both.join(kept, "digest").select(
        "doc_key", F.col("chunk").cast("bigint").alias("chunk"), "first_state", "first_attempts", "second_state", "second_attempts",
        "acknowledgements", F.when(F.col("second_ack") == "first", 1).otherwise(2).alias("run"),
    )


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_key, 'current' AS state FROM documents JOIN labels USING (doc_id) WHERE lang = 'en'""")
def reindex_one_collection(spark, sf_dir):
    """All documents are indexed; with labels only those of one tree are indexed anew."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    index_documents(job, document_xml(spark, sf_dir), "first", 1)
    outcomes, _blocking = reindex_collection(job, labelled_xml(spark, sf_dir), "/db/en", "second", 2)
    return outcomes.select("doc_key", "state")


@query("""SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)""")
def replaced_documents(spark, sf_dir):
    """Two versions of every document come in one batch of events; the later one is stored."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))

    def events(documents: DataFrame, sequence: int) -> DataFrame:
        return documents.select(
            F.lit(sequence).cast("bigint").alias("sequence"), F.lit("upsert").alias("op"), "collection", "collection_id",
            "document_id", F.lit(None).cast("string").alias("user_document_id"), "xml",
        )

    batch = events(labelled_xml(spark, sf_dir), 2).unionByName(events(document_xml(spark, sf_dir), 1))
    apply_events(job, batch, "b0", 1)
    return job.store.latest().select(
        F.col("doc_key").cast("bigint").alias("doc_id"), F.get_json_object("record_json", "$.quality").cast("int").alias("quality")
    )


def sent_requests(job: Job, read: dict[str, DataFrame]) -> DataFrame:
    """Keys of all requests in the publisher's files, which do not change; `read` keeps those of commits read before."""
    requests = "array<struct<action: string, body: struct<objectID: string, collection: string, documentID: string>>>"
    for folder in list_names(job.spark, job.publisher.path):
        if folder.startswith("commit=") and folder not in read:
            bodies = job.spark.read.text(f"{job.publisher.path}/{folder}")
            rows = bodies.select(F.explode(F.from_json("value", f"requests {requests}")["requests"]).alias("r"))
            read[folder] = materialize(rows.select(
                F.lit("documents").alias("index_name"), F.col("r.body.objectID").alias("object_id"),
                F.col("r.body.collection").alias("collection"), F.col("r.body.documentID").alias("document_id"), "r.action",
                F.lit(folder.removeprefix("commit=")).alias("commit"),
            ), "sent")
    found = list(read.values())
    return reduce(DataFrame.unionByName, found[1:], found[0])


@query("""SELECT 'before' AS seen, count(*) AS local_count, count(*) FILTER (doc_id % 5 > 0) AS live_count,
  count(*) FILTER (doc_id % 5 = 0) AS missing_count, false AS synced FROM documents WHERE lang = 'en'
UNION ALL SELECT 'after', count(*), count(*), 0, true FROM documents WHERE lang = 'en'""")
def reconcile_one_tree(spark, sf_dir):
    """The live index, folded from the requests sent, lost every fifth document; one tree is set aside and indexed anew."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    documents = document_xml(spark, sf_dir)
    index_documents(job, documents, "c1", 1)

    read: dict[str, DataFrame] = {}

    def live() -> DataFrame:
        rows = sent_requests(job, read)
        kept = rows.where((F.col("commit") != "c1") | (F.substring("object_id", 2, 20).cast("int") % 5 > 0))
        last = S.dedup_last_write(kept, ["index_name", "object_id"], "commit")
        return last.where("action <> 'deleteObject'").drop("action", "commit")

    numbers = ["local_count", "live_count", "missing_count", "synced"]
    report = materialize(report_for(job, "documents", "/db/en", live()), "before")
    before = report.select(F.lit("before").alias("seen"), *numbers)
    after = reconcile(job, "documents", "/db/en", documents, live, "c2", "stamp__db_en", allow=True, report=report)
    return before.unionByName(after.select(F.lit("after").alias("seen"), *numbers))


@query("""SELECT 'before' AS seen, count(*) AS local_count, count(*) FILTER (doc_id % 5 > 0) AS live_count,
  count(*) FILTER (doc_id % 5 = 0) AS missing_count, false AS synced,
  CAST(0 AS BIGINT) AS sent_first, CAST(0 AS BIGINT) AS sent_again FROM documents WHERE lang = 'de'
UNION ALL SELECT 'after', count(*), count(*), 0, true, count(*), count(*) FROM documents WHERE lang = 'de'""")
def reconcile_until_in_step(spark, sf_dir):
    """The live index also loses every seventh document of the first repair, so the tree takes a second round."""
    job = _job(spark, document_config(QUALITY_DOCUMENT))
    documents = document_xml(spark, sf_dir)
    index_documents(job, documents, "c1", 1)
    number = F.substring("object_id", 2, 20).cast("int")
    lost = F.when(F.col("commit") == "c1", number % 5 == 0).otherwise((F.col("commit") == "c2") & (number % 7 == 0))

    read: dict[str, DataFrame] = {}

    def live() -> DataFrame:
        last = S.dedup_last_write(sent_requests(job, read).where(~lost), ["index_name", "object_id"], "commit")
        return last.where("action <> 'deleteObject'").drop("action", "commit")

    numbers = ["local_count", "live_count", "missing_count", "synced"]
    before = materialize(report_for(job, "documents", "/db/de", live()), "before")
    after = reconcile(job, "documents", "/db/de", documents, live, "c2", "stamp__db_de", allow=True, report=before)
    of = lambda commit: F.count_if(F.col("commit") == commit).alias
    counts = sent_requests(job, read).agg(of("c2")("sent_first"), of("c2-2")("sent_again")).first().asDict()

    def row(report: DataFrame, seen: str, of_round: dict) -> DataFrame:
        sizes = [F.lit(of_round.get(n, 0)).cast("long").alias(n) for n in ("sent_first", "sent_again")]
        return report.select(F.lit(seen).alias("seen"), *numbers, *sizes)

    return row(before, "before", {}).unionByName(row(after, "after", counts))


@query("""SELECT 'users' AS index_name, CAST(user_id AS VARCHAR) AS doc_key, CAST(event_id AS BIGINT) AS snapshot_ts,
  event_type AS node_key, 'e' || event_id AS object_id, '/db/' || event_type AS collection
FROM events WHERE event_type IN ('click', 'view')""")
def import_stored_files(spark, sf_dir):
    """Clicks and views are written as a packed tree of snapshot files; other events under names that do not count."""
    events = spread(table(spark, sf_dir, "events"))
    user, stamp = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    kind = F.col("event_type")
    name = (
        F.when(kind.isin("click", "view"), F.concat_ws("/", F.lit("users"), user, stamp, F.concat(kind, F.lit(".json"))))
        .when(F.col("event_id") % 4 == 0, F.concat_ws("/", F.lit("users"), user, stamp, F.concat(F.lit("."), kind, F.lit(".json"))))
        .when(F.col("event_id") % 4 == 1, F.concat_ws("/", F.lit("users"), user, F.concat(F.lit("t"), stamp), F.concat(kind, F.lit(".json"))))
        .when(F.col("event_id") % 4 == 2, F.concat_ws("/", F.lit("users"), F.concat(F.lit("."), user), stamp, F.concat(kind, F.lit(".json"))))
        .otherwise(F.concat_ws("/", F.lit("users"), user, stamp, F.concat(kind, F.lit(".txt"))))
    )
    body = F.concat(F.lit('{"objectID":"e'), stamp, F.lit('","collection":"/db/'), kind, F.lit('"}'))
    path = staging_path(spark, "stored")
    materialize(write_archives(events.select(name.alias("name"), body.alias("content")), path), "written")
    found = import_snapshot_files(spark, path)
    return found.select("index_name", "doc_key", "snapshot_ts", "node_key", "object_id", "collection")


@query("WITH RECURSIVE " + EVENT_WRITES_SQL + """, ops AS (
  SELECT collection, object_id, op, length(CASE op WHEN 'delete' THEN object_id ELSE record_json END) AS n,
         row_number() OVER (PARTITION BY collection ORDER BY list_position(['add', 'update', 'delete'], op),
                            md5(object_id), object_id) AS position
  FROM changes),
walk AS (
  SELECT collection, position, 1 AS chunk, 1 AS held, n AS size FROM ops WHERE position = 1
  UNION ALL
  SELECT o.collection, o.position, CASE WHEN fits THEN w.chunk ELSE w.chunk + 1 END, CASE WHEN fits THEN w.held + 1 ELSE 1 END,
         CASE WHEN fits THEN w.size + o.n ELSE o.n END
  FROM (SELECT *, NULL AS x FROM walk) w JOIN ops o ON o.collection = w.collection AND o.position = w.position + 1,
       LATERAL (SELECT w.held < 7 AND w.size + o.n <= 300 AS fits))
SELECT collection, object_id, CAST(chunk AS BIGINT) AS chunk, CAST(max(chunk) OVER (PARTITION BY collection) AS BIGINT) AS total_chunks
FROM walk JOIN ops USING (collection, position)""")
def plan_sized_batches(spark, sf_dir):
    """Batches of at most 7 operations and 300 bytes, cut as one walk through each collection would."""
    snapshots = event_snapshots(spark, sf_dir)
    latest = S.latest_snapshot(snapshots)
    changes = S.with_record_json(S.diff_snapshots(S.previous_snapshot(snapshots), latest), latest)
    size = F.length(F.when(F.col("op") == "delete", F.col("object_id")).otherwise(F.col("record_json")))
    planned = B.plan_sized_batches(changes, size, 300, 7, ("index_name", "collection"))
    return planned.select("collection", "object_id", "chunk", "total_chunks")


@query("""WITH parts AS (SELECT page_id, list_filter(string_split(url, '/'), lambda p: p <> '') AS own FROM pages),
others AS (SELECT page_id, own, own[1:1] || [left(own[2], length(own[2]) - 1)] AS cut, own || ['more'] AS longer, own[2:] AS inner_part
           FROM parts)
SELECT page_id, own[1:2] = cut AS under_cut_name, false AS under_longer, own[1:len(inner_part)] = inner_part AS under_inner,
       true AS under_itself FROM others""")
def path_prefix_refused(spark, sf_dir):
    """What begins alike is no prefix: a site's name without its last letter, a longer path, an inner part."""
    pages = table(spark, sf_dir, "pages")
    parts = F.filter(F.split("url", "/"), lambda p: p != "")
    site = F.element_at(parts, 2)
    return pages.select(
        "page_id",
        P.path_starts_with("url", F.concat_ws("/", F.element_at(parts, 1), site.substr(F.lit(1), F.length(site) - 1))).alias("under_cut_name"),
        P.path_starts_with("url", F.concat(F.col("url"), F.lit("/more"))).alias("under_longer"),
        P.path_starts_with("url", F.array_join(F.slice(parts, 2, 100), "/")).alias("under_inner"),
        P.path_starts_with("url", F.concat(F.lit("//"), F.col("url"), F.lit("/"))).alias("under_itself"),
    )


@query("""SELECT conv_id || '-' || turn AS document_id, text AS own, role AS first, text AS second FROM conversations""")
def xml_element_over_attribute(spark, sf_dir):
    """A turn's role gives way to the turn's own text, but stays beside the text of another element."""
    root = {"path": "/talk", "fields": [
        {"name": "own", "path": "/turn/@role"}, {"name": "own", "path": "/turn"},
        {"name": "both", "path": "/turn/@role"}, {"name": "both", "path": "/turn/text"}]}
    records = X.extract_records(turn_xml(spark, sf_dir), [turn_config(root)])
    return records.select(
        "document_id", F.get_json_object("record_json", "$.own").alias("own"),
        F.get_json_object("record_json", "$.both[0]").alias("first"), F.get_json_object("record_json", "$.both[1]").alias("second"),
    )


@query("""WITH o AS (SELECT o_custkey % 6 AS g, o_orderkey % 3 AS r FROM orders),
n AS (SELECT g, count(*) AS n, count(*) FILTER (r <> 0) AS without_0, count(*) FILTER (r <> 1) AS without_1 FROM o GROUP BY g),
numbers AS (
  SELECT g, CASE g WHEN 2 THEN 0 WHEN 5 THEN without_1 ELSE n END AS uploads,
         CASE WHEN g IN (4, 5) THEN without_0 ELSE n END AS deletes,
         ['synced', 'stale_status', 'local_store_corruption', 'wrong_path_drift', 'true_live_loss', 'mismatch'][g + 1] AS classification
  FROM n)
SELECT '/db/g' || g AS tree, classification, CASE g WHEN 0 THEN 'none' WHEN 1 THEN 'refresh status'
  ELSE 'inspect, then replay: deletes ' || deletes || ' live object(s), uploads ' || uploads || ' object(s)' END AS action
FROM numbers""")
def classify_every_kind(spark, sf_dir):
    """Six trees of orders, each out of step in its own way."""
    orders = stored_orders(spark, sf_dir).withColumn("g", F.col("doc_key").cast("bigint") % 6).withColumn("r", F.col("o_orderkey") % 3)
    rows = orders.withColumn("collection", F.concat(F.lit("/db/g"), F.col("g").cast("string")))
    local = rows.where("g <> 2 and (g <> 5 or r <> 1)").drop("g", "r")
    live = rows.where("g < 4 or r <> 0").withColumn(
        "collection", F.when(F.col("g") == 3, F.lit("/db/x3")).otherwise(F.col("collection"))
    ).select("index_name", "object_id", "collection", "document_id")
    trees = rows.select("index_name", F.col("collection").alias("tree")).distinct()
    status = T.fold_status(trees.select(
        "index_name", F.col("tree").alias("collection"), F.lit("batch_write").alias("operation"),
        F.when(F.col("tree") == "/db/g1", T.DEGRADED).otherwise(T.CURRENT).alias("state"), F.lit("t").alias("ts"),
        F.lit(1).cast("bigint").alias("seq"), F.lit(1).cast("bigint").alias("object_count"),
        F.lit(None).cast("string").alias("failure_class"), F.lit(None).cast("string").alias("failure_message"),
    ))
    return Y.recommend_action(Y.sync_report(local, live, trees, status)).select("tree", "classification", "action")


@query("WITH " + SYNC_SQL + """SELECT form, object_id, collection, document_id FROM live, (VALUES ('array'), ('object')) forms(form)""")
def live_index_from_one_document(spark, sf_dir):
    """The live orders as one JSON document each way, an array and an object with records, read by many tasks."""
    live = live_orders(spark, sf_dir).select(
        F.to_json(F.struct(F.col("object_id").alias("objectID"), "collection", F.col("document_id").alias("documentID"))).alias("record")
    )
    folder, path = staging_path(spark, "pieces"), staging_path(spark, "dumps")
    live.select(F.concat(F.lit(","), "record")).write.text(folder)
    found = []
    for form, head, tail in (("array", "[", "]"), ("object", '{"hits":[{"objectID":"x"}],"records":[', '],"n":1}')):
        replace_with_pieces(spark, f"{path}/{form}.json", [head, folder, tail], {folder})
        rows = read_live_index(spark, f"{path}/{form}.json", "orders")
        found.append(rows.select(F.lit(form).alias("form"), "object_id", "collection", "document_id"))
    return found[0].unionByName(found[1])

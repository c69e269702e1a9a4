"""Node numbers, JSON text and identifiers of extracted records."""

import json

import re

import pytest
from pyspark.sql import functions as F

from xmlindex.config import load_config
from xmlindex.functions import records as R
from xmlindex.operators.extract import (
    duplicate_object_ids, extract_records, extraction_report, fallback_report, processed_documents,
    resolve_config, skipped_documents, unconfigured_documents,
)
from xmlindex.operators.shred import malformed_documents, shred_documents, shred_xml

DOCUMENTS = "collection string, collection_id int, document_id int, xml string"


def extract(spark, xml, *fields, path="/x", collection_id=31, document_id=7, mode="drop", **index):
    node_id = index.pop("nodeId", None)
    config = load_config({"collection": "/db/harbour", "namespaces": {"t": "urn:t"}, "indexes": [
        {"name": "i", "roots": [{"path": path, "nodeId": node_id, "fields": list(fields)}], **index}]})
    documents = spark.createDataFrame([("/db/harbour", collection_id, document_id, xml)], DOCUMENTS)
    rows = extract_records(documents, [config], mode=mode).orderBy("node_id").collect()
    return [r.record_json for r in rows]


def field(name, path, **more):
    return {"name": name, "path": path, **more}


def test_identifiers(spark):
    def record(object_id, document='7', **more):
        return json.dumps({"objectID": object_id, "collection": "/db/harbour", "documentID": json.loads(document), **more},
                          separators=(",", ":"))

    # A root object below the document element is numbered by its place.
    assert extract(spark, "<fleet><note/><note/><x/></fleet>", path="/fleet/x") == [record("31/7/1.3")]
    # The document itself is node 0, with a path or without.
    for path in ("/", None):
        assert extract(spark, "<x>ferry</x>", path=path) == [record("31/7/0")]
    # Ids from the document replace the numbers.
    assert extract(spark, '<x imo="IMO-9074729"/>', nodeId="@imo") == [record("IMO-9074729")]
    assert extract(spark, '<x log="L3"/>', path="/", documentId="/x/@log") == [record("31/7/0", '"L3"')]
    assert extract(spark, "<x><crew>pilots</crew></x>", path="/", visibleBy="/x/crew") == [
        record("31/7/0", visible_by="pilots")]
    # Another document of another collection.
    assert extract(spark, "<x/>", collection_id=2, document_id=880) == [
        '{"objectID":"2/880/1","collection":"/db/harbour","documentID":880}']


def members(record):
    return record.removeprefix('{"objectID":"31/7/1","collection":"/db/harbour","documentID":7,').removesuffix("}")


@pytest.mark.parametrize("xml, fields, expected", [
    # Predicates: a missing attribute satisfies none of them.
    ('<x><buoy lit="no">B7</buoy><buoy>B8</buoy><buoy lit="yes">B9</buoy></x>',
     [field("lit", "buoy[@lit = 'yes']"), field("dark", "buoy[@lit ne 'yes']"), field("also", "buoy[@lit eq 'no']")],
     '"dark":"B7","also":"B7","lit":"B9"'),
    ('<x><tide d="mon" k="low">0.4</tide><tide d="mon" k="high">3.1</tide></x>',
     [field("t", "tide[@d eq 'mon'][@k eq 'high']")], '"t":"3.1"'),
    # An attribute gives way to its own element; another element's attribute stays.
    ('<x><berth no="8">north</berth><crane no="12"/></x>',
     [field("f", "berth/@no"), field("f", "berth"), field("f", "crane/@no")], '"f":["north","12"]'),
    # Typed text; a value that is not of its type is left out, and a field without values too.
    ('<x depth="12.75"><open>false</open><slots>260</slots><slots>many</slots><fee> 9 </fee></x>',
     [field("depth", "@depth", type="float"), field("open", "open", type="boolean"),
      field("slots", "slots", type="integer"), field("fee", "fee", type="integer")],
     '"depth":12.75,"open":false,"slots":260'),
    ("<x><leg><lat>-33.86</lat></leg><leg><lat>151.2</lat></leg><leg><lat>0.5</lat></leg></x>",
     [field("lat", "/leg/lat", type="float")], '"lat":[-33.86,151.2,0.5]'),
    # The text of an element is that of everything in it.
    ("<x><sign>No <i>mooring</i> past<b> the <i>pier</i></b></sign></x>", [field("s", "sign")], '"s":"No mooring past the pier"'),
    ("<x><a><b><deep>rope</deep></b></a></x>", [field("any", "//deep"), field("no", "*/deep")], '"any":"rope"'),
    ('<x xmlns:h="urn:t"><h:ship>Ada</h:ship><ship>Bea</ship></x>', [field("s", "t:ship")], '"s":"Ada"'),
    ('<x><m>tab\there &amp; "there" \\ ü</m></x>', [field("m", "m")], r'"m":"tab\there & \"there\" \\ ü"'),
    # Fields come in the order of their first match, objects before attributes on one node.
    ("<x><stern>S</stern><bow>B</bow></x>", [field("b", "bow"), field("s", "stern")], '"s":"S","b":"B"'),
    ("<x><bow>B</bow></x>", [field("t", "bow"), field("o", "bow", kind="object")], '"o":{"nodeId":"1.1","#text":"B"},"t":"B"'),
    # Objects: attributes, text and children of an element, repeated children as an array.
    ('<x><ship flag="NZ"/></x>', [field("o", "ship", kind="object")], '"o":{"nodeId":"1.1","flag":"NZ"}'),
    ('<x><ship flag="NZ" hull="steel">Kea</ship></x>', [field("o", "ship", kind="object")],
     '"o":{"nodeId":"1.1","flag":"NZ","hull":"steel","#text":"Kea"}'),
    ("<x><hold/></x>", [field("o", "hold", kind="object")], '"o":{"nodeId":"1.1"}'),
    ("<x><hold><grain/>\n <coal>40</coal></hold></x>", [field("o", "hold", kind="object")],
     '"o":{"nodeId":"1.1","grain":null,"coal":"40"}'),
    ("<x><crew><mate>Ivo</mate><cook>Una</cook><mate>Lin</mate><mate>Raj</mate></crew></x>",
     [field("o", "crew", kind="object")], '"o":{"nodeId":"1.1","mate":["Ivo","Lin","Raj"],"cook":"Una"}'),
    ("<x><port><dock><gate>3</gate><gate>4</gate></dock><mayor>Oz</mayor></port><port><dock><gate>9</gate></dock></port></x>",
     [field("o", "port", kind="object")],
     '"o":[{"nodeId":"1.1","dock":{"gate":["3","4"]},"mayor":"Oz"},{"nodeId":"1.2","dock":{"gate":"9"}}]'),
    # Mixed content keeps the pieces of text beside the children.
    ('<x><log>left <p at="06:10">Bluff</p>, fog<q/></log></x>', [field("o", "log", kind="object")],
     '"o":{"nodeId":"1.1","#text":["left ",", fog"],"p":{"at":"06:10","#text":"Bluff"},"q":null}'),
    ('<x><rope len="5"/><rope len="9"/></x>', [field("o", "rope/@len", kind="object")], '"o":["5","9"]'),
])
def test_members(spark, xml, fields, expected):
    (record,) = extract(spark, xml, *fields)
    assert members(record) == expected
    json.loads(record)


def test_bad_literal_can_fail(spark):
    with pytest.raises(Exception, match="does not have its type"):
        extract(spark, "<x><w>z</w></x>", field("f", "w", type="integer"), mode="fail")


def test_literals(spark):
    cases = [
        ("integer", "+7", "7"), ("integer", "1.5", None), ("integer", "99999999999", None), ("float", "1e3", "1000.0"),
        ("float", "NaN", None), ("float", "x", None), ("boolean", "TRUE", "true"), ("boolean", "1", None),
        ("date", "2016-07-20Z", "1468972800000"), ("date", "2016-07-20+02:00", "1468965600000"),
        ("date", " 2016-07-20 ", "1468972800000"), ("date", "20.7.2016", None),
        ("dateTime", "2016-07-20T10:20:30.5Z", "1469010030500"), ("dateTime", "2016-07-20T10:20:30-01:00", "1469013630000"),
        ("string", 'a"b', '"a\\"b"'),
    ]
    rows = spark.createDataFrame(cases, "t string, v string, e string")
    wrong = rows.where(~R.typed_json(F.col("v"), F.col("t")).eqNullSafe(F.col("e")))
    assert wrong.collect() == []


XML = """<?xml version="1.0"?>
<?one?><?two?>
<!-- a comment counts too -->
<r xmlns="urn:t" a="1">
  <e id="i1"><f>x</f><!-- c --><f>y</f></e>
  <e><f>z</f></e>
</r>"""


def test_node_numbers(spark):
    documents = spark.createDataFrame([("/db", 1, 1, XML)], DOCUMENTS)
    rows = shred_xml(documents, ["/t:r/t:e/t:f", "//@id", "/t:r/@a"], {"t": "urn:t"}).orderBy("order").collect()
    # Two instructions and a comment come first; attributes precede children; white space counts.
    assert [(r.node_id, r.value) for r in rows] == [
        ("4.1", "1"), ("4.3.1", "i1"), ("4.3.2", "x"), ("4.3.4", "y"), ("4.5.1", "z")]


def test_long_text_is_one_node(spark):
    documents = spark.createDataFrame([("/db", 1, 1, "<r>" + "ab\n" * 50_000 + "<e/></r>")], DOCUMENTS)
    (row,) = shred_xml(documents, ["/r/e"]).collect()
    assert row.node_id == "1.2"


def test_reports_and_malformed(spark):
    config = load_config({"collection": "/db/a", "indexes": [{"name": "i", "roots": [{"path": "/r/e", "nodeId": "@id"}]}]})
    documents = spark.createDataFrame([
        ("/db/a", 1, 1, '<r><e id="k"/><e/><e id=""/></r>'), ("/db/a/b", 2, 2, '<r><e id="k"/></r>'),
        ("/db/a", 1, 3, "<r/>"), ("/db/a", 1, 4, "<r>"), ("/db/ab", 3, 5, "<r/>")], DOCUMENTS)
    with pytest.raises(Exception, match="not well-formed"):
        extract_records(documents, [config]).collect()
    shredded = shred_documents(resolve_config(documents, [config]), [config], "skip")
    records = extract_records(documents, [config], on_malformed="skip")
    counts = extraction_report(processed_documents(shredded, [config]), records).collect()
    assert {r.document_id: r.root_objects for r in counts} == {1: 3, 2: 1, 3: 0}
    assert [(r.document_id, r.configured_path, r.affected) for r in fallback_report(records).collect()] == [
        (1, "/r/e/@id", 2)]
    assert [(r.object_id, r.n) for r in duplicate_object_ids(records).collect()] == [("k", 2)]
    assert [r.document_id for r in malformed_documents(documents).collect()] == [4]
    assert [r.document_id for r in unconfigured_documents(documents, [config]).collect()] == [5]


def test_nearest_configuration_with_many(spark):
    """The nearest one is found among few and many, with one plan."""
    configs = [load_config({"collection": f"/db/c{n}", "indexes": []}) for n in range(300)]
    configs += [load_config({"collection": p, "indexes": []}) for p in ("/db", "/db/c7/deep")]
    rows = [("/db/c7/deep/x",), ("/db/c7/other",), ("/db/zzz",), ("/else",)]
    frame = spark.createDataFrame(rows, "collection string")
    found = {r.collection: r.config_no for r in resolve_config(frame, configs).collect()}
    assert found == {"/db/c7/deep/x": 301, "/db/c7/other": 7, "/db/zzz": 300, "/else": None}
    few = configs[7:8] + configs[300:]
    found = {r.collection: r.config_no for r in resolve_config(frame, few).collect()}
    assert found == {"/db/c7/deep/x": 2, "/db/c7/other": 0, "/db/zzz": 1, "/else": None}

    def plan(configs):
        text = resolve_config(frame, configs)._jdf.queryExecution().optimizedPlan().toString()
        return re.sub(r"#\d+|_\d+", "", re.sub(r"ExternalRDD.*|LogicalRDD.*|LocalRelation.*", "", text))

    many = [load_config({"collection": f"/db/m{n}/x", "indexes": []}) for n in range(3000)]
    assert plan(few) == plan(many)
    odd = [load_config({"collection": p, "indexes": []}) for p in ("/", "rel", "rel/x")]
    paths = spark.createDataFrame([("",), ("/",), ("/a",), ("rel/y",), ("rel/x/y",), (None,)], "collection string")
    assert [r.config_no for r in resolve_config(paths, odd).collect()] == [None, 0, None, 1, 2, None]
    with pytest.raises(ValueError, match="two"):
        resolve_config(frame, [few[0], few[0]])
    assert [r.config_no for r in resolve_config(frame, []).collect()] == [None] * 4


def test_documents_without_content_are_reported_in_both_modes(spark):
    config = load_config({"collection": "/db", "indexes": [{"name": "i", "roots": [{"path": "/x"}]}]})
    documents = spark.createDataFrame([("/db", 1, 1, "<x/>"), ("/db", 1, 2, None)], DOCUMENTS)
    for mode in ("fail", "skip"):
        shredded = shred_documents(resolve_config(documents, [config]), [config], mode)
        markers = {r["document_id"]: r["error"] for r in shredded.where("scope is null").collect()}
        assert markers == {1: None, 2: "no content"}
        assert [r["document_id"] for r in skipped_documents(shredded, [config]).collect()] == [2]


def test_literals_are_typed_once_and_only_root_objects_leave_the_tasks(spark):
    config = load_config({"collection": "/db/harbour", "indexes": [{"name": "i", "roots": [
        {"path": "/x/y", "fields": [field("n", "n", type="integer"), field("d", "d", type="date")]}]}]})
    xml = "<x><y><n>4</n><n>four</n><d>1970-01-02</d></y><y><d>soon</d></y></x>"
    documents = spark.createDataFrame([("/db/harbour", 1, 2, xml), ("/db/harbour", 1, 3, "<x/>")], DOCUMENTS)

    shredded = shred_documents(resolve_config(documents, [config]), [config], markers=False)
    assert [r.scope for r in shredded.collect()] == [0, 0]

    records = extract_records(documents, [config]).select("record_json", "bad_literals")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 3  # integer, float and timestamp, for the record and the count together
    assert sorted((json.loads(r.record_json).get("n"), json.loads(r.record_json).get("d"), r.bad_literals)
                  for r in records.collect() if "n" in json.loads(r.record_json)) == [(4, 86400000, 1)]
    assert sorted(r.bad_literals for r in records.collect()) == [1, 1]


def test_batches_of_documents_are_bounded_in_bytes(spark):
    from xmlindex.operators import shred

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for setting, kept in (("64m", str(shred._INPUT_BYTES)), ("1m", "1m")):
            spark.conf.set(key, setting)
            text = F.concat(F.lit("<x>"), F.repeat(F.lit("a"), 20_000), F.lit("</x>"))
            documents = spark.range(0, 1000, 1, 1).select(F.col("id").alias("document_id"), text.alias("xml"))
            assert shred_xml(documents, ["/x"]).agg(F.count("*"), F.min(F.length("value"))).first()[:] == (1000, 20_000)
            assert spark.conf.get(key) == kept
            sizes = documents.mapInArrow(
                lambda batches: (b.select([]).from_pydict({"size": [b.nbytes]}) for b in batches), "size long")
            assert max(r.size for r in sizes.collect()) <= shred._INPUT_BYTES + 100_000
    finally:
        spark.conf.set(key, before)


def test_a_batch_of_many_small_values_is_bounded():
    from xmlindex.operators import shred

    builder = shred._BatchBuilder()
    while not builder.full():
        builder.add(0, [0, None, None, [[1, True, "1.1", 0, "a", None] * 100]], None, None)
    assert len(builder.values) // shred._MEMBERS < 50_000

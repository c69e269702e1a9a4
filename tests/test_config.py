import pytest

from xmlindex.config import XML_NAMESPACE, Predicate, Step, alignments, compile_path, load_config

NAMESPACES = {"t": "urn:t"}


def steps(path):
    return compile_path(path, NAMESPACES)


@pytest.mark.parametrize("path, expected", [
    ("@a", [Step("a", attribute=True)]),
    ("a", [Step("a")]),
    ("/@t:a", [Step("{urn:t}a", attribute=True)]),
    ("/t:a/b", [Step("{urn:t}a"), Step("b")]),
    ("u:a", [Step("a")]),  # a prefix nobody declared stands for no namespace
    ("*", [Step("*")]),
    ("//a", [Step("a", descendant=True)]),
    ("//@a", [Step("a", descendant=True, attribute=True)]),
    ("/a//b/c", [Step("a"), Step("b", descendant=True), Step("c")]),
    ("/a[@x eq '1']/b[@y ne '2'][@t:z = '']/@c", [
        Step("a", predicates=(Predicate("x", "eq", "1"),)),
        Step("b", predicates=(Predicate("y", "ne", "2"), Predicate("{urn:t}z", "=", ""))),
        Step("c", attribute=True),
    ]),
])
def test_paths(path, expected):
    assert steps(path) == tuple(expected)


@pytest.mark.parametrize("path", ["", "/", "a/", "@a[@x eq 'y']", "@a/b", "a[x eq 'y']", "a b", "a[@x gt 'y']"])
def test_rejected_paths(path):
    with pytest.raises(ValueError):
        steps(path)


@pytest.mark.parametrize("path, elements, expected", [
    ("/a/b", "a b", [(0, 1)]),
    ("/a/b", "a b c", []),
    ("//b", "a b", [(1,)]),
    ("//a//a", "a a a", [(0, 2), (1, 2)]),
    ("/*/b", "a b", [(0, 1)]),
    ("/a/@x", "a", [(0,)]),
    ("//@x", "a b", [()]),
    ("/a//@x", "a b", [(0,)]),
])
def test_alignments(path, elements, expected):
    assert alignments(steps(path), tuple(elements.split())) == expected


XCONF = """
<collection xmlns="urn:host"><index><plugin>
  <namespaceMappings><namespaceMapping><prefix>t</prefix><namespace>urn:t</namespace></namespaceMapping>
    <namespaceMapping><prefix>xml</prefix><namespace>http://www.w3.org/XML/1998/namespace</namespace></namespaceMapping>
  </namespaceMappings>
  <index name="i" documentId="/t:a/@xml:id" visibleBy="/t:a/t:v" batchSize="7">
    <rootObject path="/t:a/t:b" nodeId="@xml:id">
      <object name="o" path="t:o"/><attribute name="n" path="/t:n" type="integer"/>
    </rootObject>
    <rootObject/>
  </index></plugin></index></collection>
"""


def test_xml_configuration():
    config = load_config(XCONF, "/db/x")
    index = config.indexes[0]
    assert (config.collection, index.name, index.batch_size) == ("/db/x", "i", 7)
    assert index.document_id == (Step("{urn:t}a"), Step(f"{{{XML_NAMESPACE}}}id", attribute=True))
    root, whole = index.roots
    assert [(f.name, f.kind, f.type) for f in root.fields] == [("o", "object", "string"), ("n", "attribute", "integer")]
    assert root.node_id_path == "@xml:id" and whole.steps == () and whole.path == "/"


def config(*fields, **root):
    return {"collection": "/db", "indexes": [{"name": "i", "roots": [{"path": "/a", "fields": list(fields), **root}]}]}


def test_same_field_twice_is_one_field():
    loaded = load_config(config({"name": "f", "path": "b"}, {"name": "f", "path": "c", "type": "integer"}))
    (field,) = loaded.indexes[0].roots[0].fields
    assert len(field.paths) == 2 and field.type == "string"


@pytest.mark.parametrize("spec", [
    config({"name": "f", "path": "b"}, {"name": "f", "path": "c", "kind": "object"}),
    config({"name": "f", "path": "b", "type": "decimal"}),
    config({"name": "f", "path": "b", "kind": "list"}),
    config(nodeId="b"),
    config(path="/a/@b"),
    {"indexes": []},
])
def test_rejected_configurations(spec):
    with pytest.raises(ValueError):
        load_config(spec)

"""Shred XML documents into the nodes a configuration asks for.

Spark's own XML functions neither keep document order and node numbers nor know namespaces,
so this one operator reads documents in Python: a single expat pass per document inside
`mapInArrow`. It only tokenises - it emits, per root element, the matching nodes with their
numbers, text and the attribute values predicates will ask for. Selecting, typing, ordering
and assembling happens in DataFrame expressions. Nodes leave the task already attached to
their root element, so no shuffle is needed to build a record, and a document or collection
of any size only ever occupies its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from json.encoder import encode_basestring
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from xmlindex.config import (
    CollectionConfig,
    FieldConfig,
    IndexConfig,
    RootConfig,
    alignments,
    compile_path,
    path_predicates,
)
from xmlindex.session import bound_batches

VALUE_TYPE = (
    "struct<ord:bigint,element:boolean,node_id:string,alt:int,content:string,"
    "checks:array<array<string>>>"
)
SHRED_COLUMNS = (
    "scope int, root_node_id string, root_checks array<array<string>>, "
    f"fields array<array<{VALUE_TYPE}>>, doc_values array<string>, error string"
)

# Rows and text held before a batch is handed to the JVM; each value counts for more than its text.
_BATCH_ROWS = 4096
_BATCH_CHARS = 2 << 20
_VALUE_CHARS = 64
# Documents a task gets at once, unless a single one is larger.
_INPUT_BYTES = 4 << 20
# Distinct element paths, and names, remembered per task before old ones are dropped.
_MEMO_LIMIT = 200_000
_NAME_LIMIT = 20_000

_CHECKS = pa.list_(pa.list_(pa.string()))
_VALUE = pa.struct(
    [
        ("ord", pa.int64()),
        ("element", pa.bool_()),
        ("node_id", pa.string()),
        ("alt", pa.int32()),
        ("content", pa.string()),
        ("checks", _CHECKS),
    ]
)
_MEMBERS = _VALUE.num_fields


def scopes_of(configs: list[CollectionConfig]) -> list[tuple[int, int, IndexConfig, RootConfig]]:
    """All root configurations as (config number, index number, index, root); the position is the scope."""
    return [
        (config_no, index_no, index, root)
        for config_no, config in enumerate(configs)
        for index_no, index in enumerate(config.indexes)
        for root in index.roots
    ]


class _PathState:
    """What is wanted at one element path; children are looked up by the name expat gives."""

    __slots__ = (
        "path", "children", "roots", "elements", "attributes", "doc_attributes", "named",
        "doc_elements", "doc_texts", "wants_text", "wants_object", "at_start", "only_text", "at_end",
    )

    def __init__(self, path: tuple[str, ...]):
        self.path = path
        self.children: dict[str, _PathState] = {}
        self.roots = []  # (scope, root key, alignments, predicates)
        self.elements = []  # (root key, field, alternative, is object, alignments, predicates)
        self.attributes = {}  # name -> [(root key, field, alternative, alignments, predicates)]
        self.doc_attributes = {}  # name -> [slot]
        self.named = {}  # expat name -> the two entries above
        self.doc_elements = []  # slots taking the text of the element
        self.doc_texts = []  # slots taking the first text run
        self.wants_text = False
        self.wants_object = False
        self.at_start = False  # anything to do when such an element starts, or ends
        self.only_text = False  # when it starts, its text is all there is to do
        self.at_end = False

    def attribute(self, raw: str) -> tuple:
        """(values, document slots) an attribute is wanted for."""
        wanted = self.named.get(raw)
        if wanted is None:
            name = _split_name(raw)[0]
            wanted = self.named[raw] = (self.attributes.get(name, ()), self.doc_attributes.get(name, ()))
        return wanted


def _root_key(scope: int, depth: int) -> int:
    """Only one element is open at a depth, so scope and depth name an open root."""
    return scope << 20 | depth


class _Matcher:
    """Path states of one collection configuration."""

    def __init__(self, config: CollectionConfig, scopes: list[tuple[int, RootConfig]]):
        self.scopes = scopes
        self.doc_paths = [
            (slot, steps, slot % 2 == 1)
            for slot, steps in enumerate(
                steps for index in config.indexes for steps in (index.document_id, index.visible_by)
            )
            if steps
        ]
        self.slots = 2 * len(config.indexes)
        # Field positions of a root: its fields, then the user-specified node id.
        self.members = {
            scope: [(n, alt, f.kind == "object", steps) for n, f in enumerate(root.fields)
                    for alt, steps in enumerate(f.paths)]
            + ([(len(root.fields), 0, False, root.node_id)] if root.node_id else [])
            for scope, root in scopes
        }
        self.width = {scope: len(root.fields) + 1 for scope, root in scopes}
        self.restart()

    def restart(self) -> None:
        self.known = 0
        self.start = _PathState(())

    def child(self, state: _PathState, raw: str) -> _PathState:
        self.known += 1
        path = (*state.path, _split_name(raw)[0])
        new = state.children[raw] = _PathState(path)
        for scope, root in self.scopes:
            depths = [0] if not root.steps else range(1, len(path) + 1)
            for depth in depths:
                found = alignments(root.steps, path[:depth]) if depth else [()]
                if not found:
                    continue
                key = _root_key(scope, depth)
                if depth == len(path):
                    new.roots.append((scope, key, found, path_predicates(root.steps)))
                for position, alt, is_object, steps in self.members[scope]:
                    below = [tuple(depth + i for i in a) for a in alignments(steps, path[depth:])]
                    if not below:
                        continue
                    wanted = path_predicates(steps)
                    if steps[-1].attribute:
                        new.attributes.setdefault(steps[-1].name, []).append(
                            (key, position, alt, below, wanted)
                        )
                    else:
                        new.elements.append((key, position, alt, is_object, below, wanted))
                        new.wants_object |= is_object
                        new.wants_text |= not is_object
        for slot, steps, is_visible_by in self.doc_paths:
            if not alignments(steps, path):
                continue
            if steps[-1].attribute:
                new.doc_attributes.setdefault(steps[-1].name, []).append(slot)
            elif is_visible_by:
                new.doc_texts.append(slot)
            else:
                new.doc_elements.append(slot)
                new.wants_text = True
        new.at_start = bool(
            new.roots or new.attributes or new.doc_attributes or new.wants_text or new.wants_object
        )
        new.only_text = new.wants_text and not (
            new.roots or new.attributes or new.doc_attributes or new.wants_object
        )
        new.at_end = bool(new.roots or new.elements or new.doc_elements)
        return new


class _ObjectFrame:
    """JSON of one element inside an object field, members in order of first appearance."""

    __slots__ = ("members", "plain", "texts")

    def __init__(self, attributes: list[tuple[str, str]]):
        self.members: dict[str, list[str]] = {}
        for name, value in attributes:
            self.members.setdefault(name, []).append(encode_basestring(value))
        self.plain = not attributes  # neither attributes nor child nodes other than text
        self.texts = True  # only text children

    def text(self, text: str) -> None:
        # White space only matters when it turns out to be all there is (see `body`).
        self.members.setdefault("#text" if text.strip() else "#space", []).append(encode_basestring(text))

    def child(self, name: str, json: str) -> None:
        self.members.setdefault(name, []).append(json)
        self.plain = self.texts = False

    def _pairs(self) -> str:
        return ",".join(
            f"{encode_basestring(name)}:{values[0] if len(values) == 1 else '[' + ','.join(values) + ']'}"
            for name, values in self.members.items()
            if name != "#space"
        )

    def body(self) -> str:
        """Members of the selected element itself, without braces."""
        space = self.members.pop("#space", None)
        if space and self.texts and "#text" not in self.members:
            self.members["#text"] = space
        return self._pairs()

    def json(self) -> str:
        if self.plain:
            texts = self.members.get("#text", [])
            if not texts:
                return "null"
            return texts[0] if len(texts) == 1 else "[" + ",".join(texts) + "]"
        return "{" + self._pairs() + "}"


def _checks(stack: list[tuple], found: list[tuple[int, ...]], predicates: list) -> list:
    """Per way of matching, the values of the attributes the predicates compare."""
    checks = []
    for positions in found:
        values = []
        for step, predicate in predicates:
            flat = stack[positions[step]][3]
            value = None
            for n in range(0, len(flat), 2):
                if _split_name(flat[n])[0] == predicate.attribute:
                    value = flat[n + 1]
            values.append(value)
        checks.append(values)
    return checks


_names: dict[str, tuple[str, str, str]] = {}


def _split_name(raw: str) -> tuple[str, str, str]:
    """expat's `uri local prefix` as Clark name, qualified name, local name."""
    name = _names.get(raw)
    if name is None:
        if len(_names) > _NAME_LIMIT:
            _names.clear()
        parts = raw.split(" ")
        if len(parts) == 1:
            name = raw, raw, raw
        else:
            qualified = f"{parts[2]}:{parts[1]}" if len(parts) > 2 else parts[1]
            name = f"{{{parts[0]}}}{parts[1]}", qualified, parts[1]
        _names[raw] = name
    return name


def _read_document(matcher: _Matcher, xml: str | bytes):
    """(root rows, document values) of one document; raises `expat.ExpatError` if malformed.

    A root row has its values as one flat list per field: a list per value would be a container that
    the garbage collector visits for as long as the batch is held.
    """
    if matcher.known > _MEMO_LIMIT:
        matcher.restart()
    # Of the innermost open node, at first the document: state, number with a final dot, children so far.
    state = matcher.start
    prefix = ""
    count = 0
    # Per open element, these three of its parent and its own flat attribute list.
    stack: list[tuple[_PathState, str, int, list[str]]] = []
    run: list[str] = []  # pieces of the current text run
    texts: list[str] = []  # text below the outermost element whose text is wanted
    marks: list[int] = []
    frames: list[_ObjectFrame] = []
    open_roots: dict[int, list] = {}
    rows: list[list] = []
    doc_values: list[str | None] = [None] * matcher.slots
    width = matcher.width
    order = 0

    def text_run_end() -> None:
        nonlocal count
        text = run[0] if len(run) == 1 else "".join(run)
        run.clear()
        count += 1
        if marks:
            texts.append(text)
        if frames:
            frames[-1].text(text)
        for slot in state.doc_texts:
            if doc_values[slot] is None:
                doc_values[slot] = text

    def other_node(*_ignored) -> None:
        nonlocal count
        if run:
            text_run_end()
        count += 1
        if frames:
            frames[-1].texts = False

    def start(raw: str, flat: list[str]) -> None:
        nonlocal state, prefix, count
        if run:
            text_run_end()
        count += 1
        stack.append((state, prefix, count, flat))
        prefix = f"{prefix}{count}."
        count = len(flat) >> 1
        state = state.children.get(raw) or matcher.child(state, raw)
        if state.only_text and not frames:
            marks.append(len(texts))
        elif state.at_start or frames:
            begin(flat)

    def begin(flat: list[str]) -> None:
        nonlocal order
        if state.wants_object or frames:
            frames.append(_ObjectFrame(
                [(_split_name(flat[n])[1], flat[n + 1]) for n in range(0, len(flat), 2)]
            ))
        for scope, key, found, predicates in state.roots:
            checks = _checks(stack, found, predicates) if predicates else None
            open_roots[key] = [scope, prefix[:-1], checks, [None] * width[scope]]
        if flat and (state.attributes or state.doc_attributes):
            for n in range(0, len(flat), 2):
                wanted, slots = state.attribute(flat[n])
                if wanted:
                    order += 1
                    node_id = f"{prefix}{(n >> 1) + 1}"
                    for key, position, alt, found, predicates in wanted:
                        fields = open_roots[key][3]
                        checks = _checks(stack, found, predicates) if predicates else None
                        value = [order, False, node_id, alt, flat[n + 1], checks]
                        if fields[position] is None:
                            fields[position] = value
                        else:
                            fields[position] += value
                for slot in slots:
                    doc_values[slot] = doc_values[slot] or flat[n + 1] or None
        if state.wants_text:
            marks.append(len(texts))

    def end(raw: str) -> None:
        nonlocal state, prefix, count
        if run:
            text_run_end()
        if state.at_end or frames:
            finish(raw)
        state, prefix, count, _flat = stack.pop()

    def finish(raw: str) -> None:
        nonlocal order
        text = body = None
        if state.wants_text:
            mark = marks.pop()
            text = texts[mark] if len(texts) == mark + 1 else "".join(texts[mark:])
            if not marks:
                texts.clear()
        if frames:
            frame = frames.pop()
            if frames:
                frames[-1].child(_split_name(raw)[2], frame.json())
            if state.wants_object:
                body = frame.body()
        if state.elements:
            order += 1
            node_id = prefix[:-1]
            for key, position, alt, is_object, found, predicates in state.elements:
                fields = open_roots[key][3]
                checks = _checks(stack, found, predicates) if predicates else None
                value = [order, True, node_id, alt, body if is_object else text, checks]
                if fields[position] is None:
                    fields[position] = value
                else:
                    fields[position] += value
        for slot in state.doc_elements:
            doc_values[slot] = doc_values[slot] or text or None
        for _scope, key, _found, _predicates in state.roots:
            rows.append(open_roots.pop(key))

    for scope, root in matcher.scopes:
        if not root.steps:
            open_roots[_root_key(scope, 0)] = [scope, None, None, [None] * width[scope]]
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.namespace_prefixes = True
    parser.ordered_attributes = True
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.EndElementHandler = end
    parser.CharacterDataHandler = run.append
    parser.CommentHandler = other_node
    parser.ProcessingInstructionHandler = other_node
    parser.Parse(xml, True)
    rows.extend(open_roots.values())
    return rows, doc_values


class _BatchBuilder:
    """Output rows as flat lists, so nested Arrow arrays are built from offsets."""

    def __init__(self) -> None:
        self.document: list[int] = []
        self.scopes: list[int | None] = []
        self.node_ids: list[str | None] = []
        self.root_checks: list = []
        self.doc_values: list = []
        self.errors: list[str | None] = []
        self.row_offsets = [0]
        self.field_offsets = [0]
        self.values: list = []  # the members of one value after those of the other
        self.chars = 0

    def add(self, document: int, row: list | None, doc_values: list | None, error: str | None) -> None:
        scope, node_id, checks, fields = row or (None, None, None, ())
        self.document.append(document)
        self.scopes.append(scope)
        self.node_ids.append(node_id)
        self.root_checks.append(checks)
        self.doc_values.append(doc_values)
        self.errors.append(error)
        for values in fields:
            if values:
                self.values += values
                many = len(values) // _MEMBERS
                self.chars += _VALUE_CHARS * many + (len(values[4]) if many == 1 else sum(map(len, values[4::_MEMBERS])))
            self.field_offsets.append(len(self.values) // _MEMBERS)
        self.row_offsets.append(len(self.field_offsets) - 1)

    def full(self) -> bool:
        return len(self.document) >= _BATCH_ROWS or self.chars >= _BATCH_CHARS

    def batch(self, source: pa.RecordBatch) -> pa.RecordBatch:
        struct = pa.StructArray.from_arrays(
            [pa.array(self.values[n::_MEMBERS], f.type) for n, f in enumerate(_VALUE)], fields=list(_VALUE)
        )
        fields = pa.ListArray.from_arrays(pa.array(self.field_offsets, pa.int32()), struct)
        taken = source.take(pa.array(self.document, pa.int32()))
        return pa.RecordBatch.from_arrays(
            [
                *taken.columns,
                pa.array(self.scopes, pa.int32()),
                pa.array(self.node_ids, pa.string()),
                pa.array(self.root_checks, _CHECKS),
                pa.ListArray.from_arrays(pa.array(self.row_offsets, pa.int32()), fields),
                pa.array(self.doc_values, pa.list_(pa.string())),
                pa.array(self.errors, pa.string()),
            ],
            names=[*taken.schema.names, "scope", "root_node_id", "root_checks", "fields",
                   "doc_values", "error"],
        )


def shred_documents(
    documents: DataFrame, configs: list[CollectionConfig], on_malformed: str = "fail", markers: bool = True
) -> DataFrame:
    """One row per root object candidate, plus one marker row (`scope` null) per document.

    `documents` has `xml` (string or binary) and `config_no` (see `resolve_config`); its other
    columns are passed through. The marker row lists the document as processed; with
    `on_malformed="skip"` its `error` says why a document that is not well-formed gave nothing.
    A document whose `xml` is null has nothing to parse and ends no run: in both modes its `error`
    is "no content". Batches of documents are bounded in bytes by a setting of the session, so that
    the memory of a Python worker does not follow the size of its partition. Without `markers` only the root objects leave the tasks.
    """
    if on_malformed not in ("fail", "skip"):
        raise ValueError("on_malformed is 'fail' or 'skip'")
    scopes = scopes_of(configs)
    bound_batches(documents.sparkSession, _INPUT_BYTES)

    def shred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [
            _Matcher(config, [(s, root) for s, (n, _i, _x, root) in enumerate(scopes) if n == number])
            for number, config in enumerate(configs)
        ]
        for batch in batches:
            xmls, numbers = batch.column("xml"), batch.column("config_no")
            source = batch.select([n for n in batch.schema.names if n != "xml"])
            builder = _BatchBuilder()
            for n, (number, xml) in enumerate(zip(numbers.to_pylist(), xmls)):
                if number is None:
                    continue  # no configuration covers it
                xml = xml.as_py()
                if xml is None:
                    if markers:
                        builder.add(n, None, None, "no content")
                    continue
                try:
                    rows, doc_values = _read_document(matchers[number], xml)
                except (expat.ExpatError, ValueError, LookupError) as problem:
                    if on_malformed == "fail":
                        raise ValueError(f"document is not well-formed XML: {problem}") from problem
                    if markers:
                        builder.add(n, None, None, str(problem))
                    continue
                if markers:
                    builder.add(n, None, doc_values, None)
                for row in rows:
                    builder.add(n, row, doc_values, None)
                    if builder.full():
                        yield builder.batch(source)
                        builder = _BatchBuilder()
            if builder.document:
                yield builder.batch(source)

    passed = [f for f in documents.schema.fields if f.name != "xml"]
    added = T._parse_datatype_string(SHRED_COLUMNS).fields
    return documents.select(*[f.name for f in passed], "xml").mapInArrow(
        shred, T.StructType([*passed, *added])
    )


def shred_xml(
    documents: DataFrame,
    paths: list[str],
    namespaces: dict[str, str] | None = None,
    object_paths: list[str] = (),
    on_malformed: str = "fail",
) -> DataFrame:
    """Node table: one row per node at any of `paths` (text) or `object_paths` (JSON body).

    Columns: the document's, `path` (the expression that matched), `node_id`, `kind`, `depth`,
    `order` and `value`. Only nodes at these paths leave the tasks.
    """
    config = CollectionConfig(
        "/",
        (IndexConfig("nodes", (RootConfig((), tuple(
            FieldConfig(f"{kind}{n}", (compile_path(path, namespaces),), kind)
            for kind, many in (("attribute", paths), ("object", object_paths))
            for n, path in enumerate(many)
        )),)),),
    )
    fields = config.indexes[0].roots[0].fields
    predicates = F.array(*[_predicate_literal(f.paths[0]) for f in fields])
    expressions = F.array(*[F.lit(path) for path in (*paths, *object_paths)])
    kept = [c for c in documents.columns if c not in ("xml", "config_no")]
    return (
        shred_documents(documents.withColumn("config_no", F.lit(0)), [config], on_malformed, markers=False)
        .select(*kept, F.posexplode(F.slice("fields", 1, len(fields))).alias("n", "values"))
        .select(*kept, "n", F.explode("values").alias("v"))
        .where(predicates_hold(F.col("v.checks"), predicates[F.col("n")]))
        .select(
            *kept,
            expressions[F.col("n")].alias("path"),
            F.col("v.node_id").alias("node_id"),
            F.when(F.col("v.element"), "element").otherwise("attribute").alias("kind"),
            F.size(F.split("v.node_id", r"\.")).alias("depth"),
            F.col("v.ord").alias("order"),
            F.col("v.content").alias("value"),
        )
    )


def select_nodes(documents: DataFrame, path: str, namespaces: dict[str, str] | None = None) -> DataFrame:
    """Nodes of the documents whose full path, with its predicates, is `path`."""
    return shred_xml(documents, [path], namespaces).drop("path")


def malformed_documents(documents: DataFrame) -> DataFrame:
    """Documents that are not well-formed, with the parser's message."""
    config = CollectionConfig("/", (IndexConfig("none", ()),))
    return (
        shred_documents(documents.withColumn("config_no", F.lit(0)), [config], "skip")
        .where("error is not null")
        .drop("config_no", "scope", "root_node_id", "root_checks", "fields", "doc_values")
    )


def _predicate_literal(steps):
    predicates = [p for _step, p in path_predicates(steps)]
    if not predicates:
        return F.lit(None).cast("array<struct<op:string,value:string>>")
    return F.array(*[
        F.struct(F.lit(p.operator).alias("op"), F.lit(p.value).alias("value")) for p in predicates
    ])


def predicates_hold(checks, predicates):
    """Do all predicates hold for some way of matching? A missing attribute never satisfies one."""
    def holds(actual, predicate):
        return F.coalesce(
            F.when(predicate["op"] == "ne", actual != predicate["value"]).otherwise(
                actual == predicate["value"]
            ),
            F.lit(False),
        )

    return checks.isNull() | F.exists(
        checks, lambda values: F.forall(F.zip_with(values, predicates, holds), lambda ok: ok)
    )

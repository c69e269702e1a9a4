"""Literals, identifiers, checksums and JSON text of records as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_DATE_TIME = r"^\s*-?\d{4,}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?\s*$"
_DATE_ONLY = r"^(-?\d{4,}-\d{2}-\d{2})(Z|[+-]\d{2}:\d{2})?$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once; needed inside lambdas, which share nothing."""
    return F.element_at(F.transform(F.array(value), body), 1)


def json_string(value: Column | str) -> Column:
    """A string as JSON text: escaped, in double quotes; null stays null."""
    value = _column(value)
    return F.when(value.isNotNull(), F.btrim(F.to_json(F.array(value)), F.lit("[]")))


def epoch_millis(value: Column | str) -> Column:
    """XSD date or dateTime text as epoch milliseconds; null if it is neither.

    Without an offset the session time zone applies.
    """
    value = _column(value)
    # A date gets a midnight before its offset; the cast reads the rest.
    text = F.regexp_replace(F.trim(value), _DATE_ONLY, r"$1T00:00:00$2")
    return F.unix_millis(F.when(value.rlike(_DATE_TIME), text).try_cast("timestamp"))


def typed_json(value: Column | str, literal_type: Column | str) -> Column:
    """JSON text of a value of the given literal type; null if the text is not such a literal."""
    value = _column(value)
    literal_type = F.lit(literal_type) if isinstance(literal_type, str) else literal_type
    # A leading plus sign is read but not written; -0 is written as 0.
    integer = F.when(value.rlike(r"^[+-]?\d+$"), value).try_cast("int").cast("string")
    number = let(
        value.try_cast("float"),
        lambda n: F.when(~F.isnan(n) & (F.abs(n) < F.lit(float("inf"))), n.cast("string")),
    )
    # Alternatives are spelled out: inside lambdas, where nothing is compiled, `isin` throws at every match.
    lowered = F.lower(value)
    return (
        F.when(literal_type == "string", json_string(value))
        .when(literal_type == "integer", integer)
        .when(literal_type == "float", number)
        .when(literal_type == "boolean", F.when((lowered == "true") | (lowered == "false"), lowered))
        .when((literal_type == "date") | (literal_type == "dateTime"), epoch_millis(value).cast("string"))
    )


def object_json(node_id: Column, element: Column, content: Column) -> Column:
    """One value of an object field: an element as an object led by its node id, an attribute as text."""
    return F.when(
        element,
        F.concat(
            F.lit('{"nodeId":"'),
            node_id,
            F.when(content == "", F.lit('"}')).otherwise(F.concat(F.lit('",'), content, F.lit("}"))),
        ),
    ).otherwise(json_string(content))


def array_or_scalar(values: Column) -> Column:
    """JSON texts as an array, or alone if there is only one; null if there is none."""
    return let(
        values,
        lambda v: F.when(F.size(v) > 1, F.concat(F.lit("["), F.array_join(v, ","), F.lit("]"))).otherwise(
            F.try_element_at(v, F.lit(1))
        ),
    )


def object_id(user_node_id: Column | str, collection_id: Column | str, document_id: Column | str,
              node_id: Column | str) -> Column:
    """The user's node id, else collection, document and node number (0 for a whole document)."""
    return F.coalesce(
        _column(user_node_id),
        F.concat_ws(
            "/",
            _column(collection_id).cast("string"),
            _column(document_id).cast("string"),
            F.coalesce(_column(node_id), F.lit("0")),
        ),
    )


def document_id_json(user_document_id: Column | str, document_id: Column | str, numeric: bool = True) -> Column:
    """A string if the user specified it, else the number of the document."""
    own = _column(document_id).cast("string")
    return F.coalesce(json_string(user_document_id), own if numeric else json_string(own))


def doc_key(user_document_id: Column | str, document_id: Column | str) -> Column:
    return F.coalesce(_column(user_document_id), _column(document_id).cast("string"))


def node_key(user_node_id: Column | str, node_id: Column | str) -> Column:
    return F.coalesce(_column(user_node_id), _column(node_id), F.lit("0"))


def checksum(value: Column | str, algorithm: str = "MD5") -> Column:
    """Hex digest of a string."""
    value = _column(value)
    if algorithm == "MD5":
        return F.md5(value)
    if algorithm == "SHA-1":
        return F.sha1(value)
    if algorithm in ("SHA-256", "SHA-384", "SHA-512"):
        return F.sha2(value, int(algorithm[4:]))
    raise ValueError(f"unknown checksum algorithm {algorithm!r}")


def record_text(record_json: Column | str, member: str) -> Column:
    """A member of a record if it is a non-empty string; numbers and other values count as absent."""
    value = F.try_variant_get(F.try_parse_json(_column(record_json)), f"$.{member}", "variant")
    text = F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))
    return F.when(text != "", text)


def stored_text(record_json: Column | str, member: str) -> Column:
    """A member of stored JSON as text, whatever its type."""
    return F.get_json_object(_column(record_json), f"$.{member}")


def object_id_of(record_json: Column | str) -> Column:
    return stored_text(record_json, "objectID")


def collection_of(record_json: Column | str) -> Column:
    return stored_text(record_json, "collection")

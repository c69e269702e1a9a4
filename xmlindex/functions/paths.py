"""Collection paths, filter strings and name building as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def in_collection_tree(collection: Column | str, tree: Column | str) -> Column:
    """`collection` is the tree's root or lies below it. A `tree` given as text is a literal path."""
    collection = _column(collection)
    tree = F.lit(tree) if isinstance(tree, str) else tree
    return (collection == tree) | F.startswith(collection, F.concat(tree, F.lit("/")))


def ancestors(collection: Column | str) -> Column:
    """The collection and everything above it, longest first: `/a/b` -> [`/a/b`, `/a`].

    Turns the prefix test of `in_collection_tree` into an equi-join key.
    """
    collection = _column(collection)
    parts = F.split(collection, "/")
    # An absolute path has an empty part in front, which is no collection.
    first = F.when(F.startswith(collection, F.lit("/")), F.lit(2)).otherwise(F.lit(1))
    return F.when(F.size(parts) >= first, F.transform(
        F.sequence(F.size(parts), F.least(first, F.size(parts)), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    ))


def place(collection: Column | str) -> Column:
    """A sort key that puts every collection tree into one range: its root first, then what is below."""
    return F.concat(F.translate(_column(collection), "/", "\x01"), F.lit("\x01"))


def tree_places(tree: Column) -> tuple[Column, Column]:
    """The range of places of a tree: from the first, up to but without the second."""
    first = place(tree)
    return first, F.concat(F.translate(tree, "/", "\x01"), F.lit("\x02"))


def path_starts_with(path: Column | str, other: Column | str) -> Column:
    """Component-wise prefix test of `/`-separated paths; the empty path is a prefix of all."""
    def parts(value: Column) -> Column:
        return F.filter(F.split(value, "/"), lambda part: part != "")

    path, other = parts(_column(path)), parts(_column(other))
    return F.slice(path, F.lit(1), F.size(other)) == other


def slug(collection: Column | str) -> Column:
    """A collection path as a file name."""
    return F.regexp_replace(F.regexp_replace(_column(collection), "^/", ""), "[^A-Za-z0-9._-]", "_")


def quarantine_name(collection: Column | str, timestamp: Column | str) -> Column:
    return F.concat_ws("__", _column(timestamp), slug(collection))


def collection_filter(collection: Column | str) -> Column:
    """Filter text selecting exactly one collection, with `\\` and `"` escaped."""
    escaped = F.replace(F.replace(_column(collection), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('collection:"'), escaped, F.lit('"'))


def collection_facet_filter(collection: Column | str) -> Column:
    return F.concat(F.lit("collection:"), _column(collection))


def document_filter(document_id: Column | str, user_document_id: Column | str | None = None) -> Column:
    """Facet filter on the user's document id if there is one, else a numeric filter."""
    numeric = F.concat(F.lit("documentID = "), _column(document_id).cast("string"))
    if user_document_id is None:
        return numeric
    user = _column(user_document_id)
    return F.when(user.isNotNull(), F.concat(F.lit("documentID:"), user)).otherwise(numeric)


def quoted_index_name(index_name: Column | str) -> Column:
    """Index name as one URL path segment: everything but letters, digits and `-._~` is quoted."""
    quoted = F.url_encode(_column(index_name))
    for plain, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(plain), F.lit(wanted))
    return quoted


def status_key(index_name: Column | str, collection: Column | str) -> Column:
    return F.concat_ws("|", _column(index_name), F.coalesce(_column(collection), F.lit("*")))

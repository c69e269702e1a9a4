"""Connected components by repeated minima, every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from xmlindex.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node of `links` (a, b).

    Each round gives every node the smallest root among its neighbours' and then the root of that
    root, so long chains shorten by powers. Rounds end when no neighbour has a smaller root. Minima are taken
    before rows move, and the joins are plain equi-joins, so a node with very many neighbours is
    split by adaptive execution. An empty table gives an empty table.
    """
    both = materialize(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    roots = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        .select("node", F.least("node", "near").alias("root")),
        "roots",
    )
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        )
        lower = materialize(
            roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")),
            "lower",
        )
        if lower.where(F.col("old") != F.col("root")).isEmpty():
            return roots
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = materialize(
            lower.join(jump, "root", "left").select("node", F.least("root", "further").alias("root")), "roots"
        )

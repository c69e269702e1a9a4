"""License scans by diagonal voting over word k-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from xmlindex.llm.support import whole_text

# Characters that are in no word after A-Z are in lower case.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Passages of public license notices, for labels beyond the base phrases.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "lesser general public license as published by the free software foundation": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met": "bsd",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu "
    "library general public license as published by the free software foundation": "lgpl",
    "this work is licensed under the gnu lesser general public license version 3": "lgpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    **{
        f"this work is licensed under a creative commons {kind}{version} license": label
        for kind, label in (
            ("attribution", "cc-by"), ("attribution sharealike", "cc-by-sa"), ("attribution share alike", "cc-by-sa"),
        )
        for version in (" 4 0 international", " 3 0 unported", " 2 5 generic", " 2 0 generic", " 1 0 generic", "")
    },
    "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# The words by which a license is known. A span of a notice that has some must hold one.
NAMES = {
    "mit": ("mit",),
    "apache": ("apache",),
    "gpl": ("gnu general",),
    "lgpl": ("lesser", "gnu library", "library general"),
    "mpl": ("mozilla",),
    "cc-by-nc": ("nc",),
    "cc-by-sa": ("attribution sharealike", "attribution share"),
}


@dataclass(frozen=True)
class Voting:
    """k words to a gram; neighbouring diagonals differ by at most `slack` words left out or added."""

    k: int = 2
    slack: int = 3
    # Share of a notice's grams that a span must hold.
    min_score: float = 0.6


def words_of(text: Column) -> Column:
    lower = F.translate(text, UPPER, LOWER)
    return F.filter(F.split(lower, WORD_GAP), lambda w: w != "")


def _templates(how: Voting, notices: dict[str, str]) -> list[tuple[int, str, str, bool, int, int]]:
    """template, gram, label, whether a base phrase, place of the gram, grams of the template."""
    rows = []
    known = [(t, label, True) for t, label in PHRASES.items()] + [(t, label, False) for t, label in notices.items()]
    for number, (passage, label, base) in enumerate(known):
        words = passage.split()
        grams = [" ".join(words[at:at + how.k]) for at in range(len(words) - how.k + 1)]
        rows += [(number, gram, label, base, at, len(grams)) for at, gram in enumerate(grams)]
    return rows


def _needed(rows: list[tuple[int, str, str, bool, int, int]], how: Voting) -> list[tuple[int, list[list[int]]]]:
    """template, sets of places: a span of the notice must hold a gram of each set.

    One set are the grams with the license's name. The others are the grams that a notice of
    another license lacks, if that has so many of the rest that it might pass for this one.
    """
    grams: dict[int, list[str]] = {}
    labels = {}
    for number, gram, label, base, _, _ in rows:
        if not base:
            grams.setdefault(number, []).append(gram)
            labels[number] = label
    needed = []
    for number, own in grams.items():
        names = [f" {name} " for name in NAMES.get(labels[number], ())]
        sets = [[at for at, gram in enumerate(own) if any(name in f" {gram} " for name in names)]]
        for other, theirs in grams.items():
            lacks = [at for at, gram in enumerate(own) if gram not in theirs]
            if labels[other] != labels[number] and 1 - len(lacks) / len(own) >= how.min_score:
                sets.append(lacks)
        needed.append((number, [places for places in sets if places]))
    return needed


def scan_licenses(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", how: Voting = Voting(), notices: dict[str, str] | None = None
) -> DataFrame:
    """One row per row of `df`: its id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rolling word k-grams of a document are hashed and joined to their places in the templates;
    equal hashes are checked on the words. Hits of a template vote for the diagonal on which they
    lie (place in the document less place in the template). A base phrase stands where one
    diagonal has the votes of all its grams. For the longer notices, neighbouring diagonals are
    merged, so words left out or added in between do not break a span, and a span is verified: its
    grams must be distinct, enough of the notice's, lie within the notice's length, and have some of
    those that tell the license from others: its name, and what each similar notice lacks. A
    span all whose grams also belong to a span of another license goes if that one has more of
    them or the better score. A license that is not among the notices has no label of its own,
    and one that a notice offers as a second choice, farther on than `slack` words, only by a base phrase.

    n_base: places of base phrases; first_word and last_word: their smallest and largest start,
    null without any; base_labels and labels: distinct, sorted, joined by commas, empty without
    any; labels has the notices' as well; score: the share of grams of the best span, 1 for a
    base phrase, 0 without any.

    Null and empty text: no words. Repeated rows: each is a row of the result. An empty table
    gives an empty table. Other columns are ignored. The templates are a fixed list, so their
    side is small; a document's hits are summed up by document and template, and only hits, not
    texts, are shuffled.
    """
    spark = df.sparkSession
    k = how.k
    rows = _templates(how, {**(NOTICES if notices is None else notices)})
    grams = spark.createDataFrame(rows, "template int, t_gram string, label string, base boolean, t_at int, n_grams int")
    grams = grams.withColumn("t_words", F.split("t_gram", " ")).withColumn(
        "t_hash", F.xxhash64(*(F.get("t_words", F.lit(j)) for j in range(k)))
    ).drop("t_words")
    needed = spark.createDataFrame(_needed(rows, how), "template int, needed array<array<int>>")
    hashes = [r[0] for r in grams.select("t_hash").distinct().collect()]

    def found(words: Column) -> Column:
        """The places whose gram has the hash of a template's, with the hash and the words."""
        here = lambda i: [F.get(words, i + j) for j in range(k)]
        places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(
            F.array().cast("array<int>")
        )
        hits = F.transform(
            F.filter(places, lambda i: F.xxhash64(*here(i)).isin(hashes)),
            lambda i: F.struct(i.alias("at"), F.xxhash64(*here(i)).alias("hash"), F.concat_ws(" ", *here(i)).alias("gram")),
        )
        return F.struct(F.size(words).alias("n_words"), hits.alias("hits"))

    # A row number per document tells repeated rows apart; the first entry carries the document.
    scanned = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("id"),
        F.get(F.transform(F.array(words_of(whole_text(f"`{text}`"))), found), F.lit(0)).alias("found"),
    )
    nothing = {"at": "int", "hash": "long", "gram": "string"}
    head = F.array(F.struct(*(F.lit(None).cast(kind).alias(name) for name, kind in nothing.items())))
    entries = scanned.select(
        "row", "id", F.col("found.n_words").alias("n_words"), F.explode(F.concat(head, "found.hits")).alias("hit")
    ).select("row", "id", "n_words", "hit.at", "hit.hash", "hit.gram")
    votes = (
        entries.join(F.broadcast(grams), (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")), "left")
        .withColumn("diagonal", F.col("at") - F.col("t_at"))
    )
    by_diagonal = votes.groupBy("row", "template", "diagonal").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"),
        F.first("base").alias("base"), F.first("n_grams").alias("n_grams"), F.count("t_at").alias("votes"),
        F.collect_set("t_at").alias("places"), F.collect_set(F.when(~F.col("base"), F.col("at"))).alias("hits"),
        F.min("at").alias("low"), F.max("at").alias("high"),
    )

    # Diagonals of a notice that follow each other closely belong to one span.
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = (
        F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(order) > how.slack)
        | (F.col("low") - F.lag("high").over(order) > F.col("n_grams"))
    )
    spans = (
        by_diagonal.withColumn("span", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(order))
        .groupBy("row", "template", "span")
        .agg(
            F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.first("label").alias("label"),
            F.first("base").alias("base"), F.first("n_grams").alias("n_grams"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("diagonal").alias("start"),
        )
        .withColumn("score", F.size("places") / F.col("n_grams"))
        .withColumn("long", F.col("high") - F.col("low") + 1)
        .join(F.broadcast(needed), "template", "left")
    )
    is_base = F.coalesce(F.col("base"), F.lit(False)) & (F.size("places") == F.col("n_grams"))
    verified = ~F.coalesce(F.col("base"), F.lit(True)) & (F.col("score") >= how.min_score) & (
        F.col("long") <= F.col("n_grams") + how.slack * 3
    ) & F.forall("needed", lambda some: F.arrays_overlap(some, F.col("places")))
    # Only a span that starts at most a notice's length before can hold all grams of another.
    reach = max([n for *_, n in rows], default=0) + how.slack * 3
    before = Window.partitionBy("row").orderBy("low").rangeBetween(-reach, 0)
    judged = (
        spans.select(
            "row", "id", "n_words", "label", "score", "start", is_base.alias("is_base"),
            F.coalesce(verified, F.lit(False)).alias("verified"), "low", F.when(verified, F.col("hits")).alias("hits"),
        )
        .withColumn("near", F.collect_list(F.when(F.col("verified"), F.struct("label", "score", "hits"))).over(before))
    )
    is_base = F.col("is_base")
    is_notice = F.col("verified") & ~F.exists("near", lambda other: (
        (other["label"] != F.col("label")) & (F.size(F.array_except("hits", other["hits"])) == 0)
        & ((F.size(other["hits"]) > F.size("hits")) | (other["score"] > F.col("score")))
    ))
    place = F.when(is_base, F.col("start")).cast("long")
    labels = lambda column: F.array_join(F.array_sort(column), ",")
    return judged.groupBy("row").agg(
        F.first("id").alias(id), F.first("n_words").cast("long").alias("n_words"),
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        labels(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
        labels(F.collect_set(F.when(is_base | is_notice, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(is_base | is_notice, F.col("score"))), F.lit(0.0)).alias("score"),
    ).drop("row")

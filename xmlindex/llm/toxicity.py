"""Toxicity: a classifier whose scores may not hang on which group a text mentions."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from xmlindex.llm.support import held, whole_text
from xmlindex.session import materialize

# Words that name groups of people; a text may mention any of them neutrally.
IDENTITY_TERMS = (
    "men", "women", "black", "white", "asian", "latino", "african", "european", "american", "gay", "lesbian",
    "bisexual", "transgender", "straight", "muslim", "jewish", "christian", "hindu", "buddhist", "atheist",
    "immigrant", "refugee", "disabled", "deaf", "blind", "old", "young",
    "männer", "frauen", "schwarze", "muslime", "juden", "christen", "behinderte",
    "hommes", "femmes", "noirs", "musulmans", "juifs", "chrétiens", "handicapés",
    "hombres", "mujeres", "negros", "musulmanes", "judíos", "cristianos", "discapacitados",
)
_WORD = re.compile(r"[^\W_]+")
_CACHED_WORDS = 100_000


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample and of the fit."""

    # At most so many documents of each label are collected; the rest of the labels only counts
    # for how frequent each label is.
    rows_per_label: int = 2500
    buckets: int = 1 << 20
    # A feature is used if its share differs between the labels by so many standard errors, in
    # at least so many documents.
    min_deviations: float = 3.0
    min_rows: int = 4
    epochs: int = 400
    rate: float = 0.5
    l2: float = 1e-5
    # Weight of squared score differences between counterfactual pairs.
    fairness: float = 1.0
    pairs_per_row: int = 2


@dataclass(frozen=True)
class Model:
    """Logistic regression over presence of hashed features."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float
    buckets: int

    def logit(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.features, found)
        at[at == len(self.features)] = 0
        hit = self.features[at] == found if len(self.features) else np.zeros(len(found), bool)
        return float(self.intercept + self.weights[at[hit]].sum()) if hit.any() else self.intercept


class _Hashed(dict):
    """The features of words seen before."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        names = [word] if len(word) <= 4 or word in IDENTITY_TERMS else [word, "^" + word[:4]]
        value = self[word] = tuple(xxhash.xxh32_intdigest(n.encode()) % self.buckets for n in names)
        return value


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(words: set[str], buckets: int) -> np.ndarray:
    """Hashed features of a set of words, ascending: each word, and its first four letters.

    The prefixes let inflected and compounded forms of a word count that were not in the sample. An
    identity term has none, so that what the penalty takes from it other words keep.
    """
    known = held(("word features", buckets), lambda: _Hashed(buckets))
    return np.array(sorted({f for w in words for f in known[w]}), np.int64)


def counterfactuals(words: set[str], pairs: int, seed: int, terms: tuple[str, ...] = IDENTITY_TERMS) -> list[set[str]]:
    """The word set with its identity terms swapped for others; with one put in if it has none."""
    rng = np.random.default_rng(seed)
    here = sorted(words.intersection(terms))
    if not here:
        return [words | {terms[i]} for i in rng.choice(len(terms), min(pairs, len(terms)), replace=False)]
    others = [t for t in terms if t not in words] or list(terms)
    return [(words - set(here)) | {others[i] for i in rng.integers(0, len(others), len(here))} for _ in range(pairs)]


def _stack(rows: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the used features."""
    owner, at = [np.zeros(0, int)], [np.zeros(0, int)]
    for row, found in enumerate(rows):
        place = np.searchsorted(columns, found)
        place[place == len(columns)] = 0
        hit = place[columns[place] == found]
        owner.append(np.full(len(hit), row))
        at.append(hit)
    return np.concatenate(owner), np.concatenate(at)


def fit(
    rows: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, prior: float, how: Training
) -> Model:
    """Weights that separate the labels and leave swapped texts their score.

    `rows` are the features of labelled texts, `pairs` the features that swapping identity terms
    adds and takes away, `prior` the share of label 1 among all labelled rows, which the sample's
    own shares are weighted back to. Without both labels the score is the prior.
    """
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    rest = float(np.log(max(prior, 1e-3) / max(1 - prior, 1e-3)))
    if not n1 or not n0:
        return Model(np.zeros(0, np.int64), np.zeros(0), rest, how.buckets)
    names, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ones = np.bincount(inverse, weights=labels[owner], minlength=len(names))
    both = np.bincount(inverse, minlength=len(names))
    share, common = ones / n1 - (both - ones) / n0, both / len(rows)
    error = np.sqrt(np.maximum(common * (1 - common), 1e-9) * (1 / n1 + 1 / n0))
    # Identity terms stay in, so that the penalty has hold of them.
    identity = np.isin(names, np.concatenate([features({t}, how.buckets) for t in IDENTITY_TERMS]))
    columns = names[((np.abs(share) >= how.min_deviations * error) & (both >= how.min_rows)) | (identity & (both >= how.min_rows))]
    if not len(columns):
        return Model(np.zeros(0, np.int64), np.zeros(0), rest, how.buckets)

    weight = np.where(labels == 1, prior / n1, (1 - prior) / n0)
    r, c = _stack(rows, columns)
    ar, ac = _stack([added for added, _ in pairs], columns)
    tr, tc = _stack([taken for _, taken in pairs], columns)
    w, b = np.zeros(len(columns)), rest
    seen_w, seen_b = np.full(len(columns), 1e-8), 1e-8
    for _ in range(how.epochs):
        z = b + np.bincount(r, weights=w[c], minlength=len(rows))
        gap = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        g = np.bincount(c, weights=gap[r], minlength=len(columns)) + how.l2 * w
        if pairs:
            # Score differences of the pairs, and their gradient.
            d = np.bincount(ar, weights=w[ac], minlength=len(pairs)) - np.bincount(tr, weights=w[tc], minlength=len(pairs))
            d = d * (2 * how.fairness / len(pairs))
            g += np.bincount(ac, weights=d[ar], minlength=len(columns)) - np.bincount(tc, weights=d[tr], minlength=len(columns))
        gb = gap.sum()
        seen_w += g * g
        seen_b += gb * gb
        w -= how.rate * g / np.sqrt(seen_w)
        b -= how.rate * gb / np.sqrt(seen_b)
    return Model(columns, w, float(b), how.buckets)


def _candidates(described: DataFrame, how: Training) -> np.ndarray:
    """The features that may be used, counted over the whole sample by Spark: at most `how.buckets`.

    A little wider than what `fit` takes, which decides.
    """
    n = {r["label"]: r["n"] for r in described.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    found = described.select("label", F.explode("own").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("ones"), F.count("*").alias("both")
    )
    share = F.col("ones") / n1 - (F.col("both") - F.col("ones")) / n0
    common = F.col("both") / (n0 + n1)
    error = F.sqrt(F.greatest(common * (1 - common), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    identity = np.concatenate([features({t}, how.buckets) for t in IDENTITY_TERMS])
    used = (F.abs(share) >= 0.999 * how.min_deviations * error) | F.col("feature").isin(*identity.tolist())
    names = found.where((F.col("both") >= how.min_rows) & used).select("feature").toArrow()["feature"]
    return np.sort(names.to_numpy().astype(np.int64))


def held_out(id_column: Column) -> Column:
    """Rows that learning never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(
    df: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", how: Training = Training()
) -> Model:
    """A model from the labelled rows of `df` that are not held out.

    The sample is bounded by `how.rows_per_label`: of each label the rows with the smallest hash
    of their id, among the ids that `df` has. All words of these rows teach; their features are
    counted by Spark, and only those that may be used come to the driver. An id is one row: of several, the text with the smallest
    hash teaches. Rows without a label, with another than 0 or 1, or whose id has two different
    labels teach nothing.
    """
    known = (
        labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(F.col("label") == F.col("other")).select("id", "label")
    )
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = df.select(F.col(f"`{id}`").alias("id"), whole_text(f"`{text}`").alias("text"))
    present = materialize(known.join(rows.select("id").distinct(), "id", "left_semi"), "labelled")
    here = {r["label"]: r["n"] for r in present.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # Hashes below a bound leave more rows than are asked for but not many, so that few are ranked.
    hashed = F.shiftrightunsigned(F.xxhash64("id"), 1)
    low = F.lit(False)
    for value, n in here.items():
        share = min(1.0, (2 * how.rows_per_label + 200) / n)
        low = low | ((F.col("label") == value) & (hashed <= int(share * ((1 << 63) - 1024))) if share < 1 else F.col("label") == value)
    order = Window.partitionBy("label").orderBy(hashed, "id")
    picked = (
        present.where(low).withColumn("place", F.row_number().over(order)).where(F.col("place") <= how.rows_per_label)
    )
    sample = (
        rows.join(F.broadcast(picked.select("id", "label")), "id")  # bounded by rows_per_label
        .groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least"))
        .select("id", "label", F.col("least.text").alias("text"))
    )

    schema = "id string, label int, own array<long>, added array<array<long>>, taken array<array<long>>"

    def describe(batches):
        for batch in batches:
            rows = []
            for name, value, content in zip(batch["id"].astype(str), batch["label"], batch["text"]):
                words = words_of(content)
                own = features(words, how.buckets)
                others = [
                    features(w, how.buckets) for w in counterfactuals(words, how.pairs_per_row, zlib.crc32(name.encode()))
                ]
                added = [np.setdiff1d(f, own) for f in others]
                rows.append((name, int(value), own, added, [np.setdiff1d(own, f) for f in others]))
            yield pd.DataFrame(rows, columns=["id", "label", "own", "added", "taken"])

    described = materialize(sample.mapInPandas(describe, schema), "sample")
    columns = _candidates(described, how)

    def narrow(batches):
        for batch in batches:
            keep = lambda found: np.intersect1d(np.array(found, np.int64), columns)
            batch["own"] = [keep(row) for row in batch["own"]]
            for name in ("added", "taken"):
                batch[name] = [[keep(one) for one in row] for row in batch[name]]
            yield batch

    sampled = described.mapInPandas(narrow, schema).toArrow().sort_by("id")
    total = sum(totals.values())
    numbers = lambda row: np.array(row, np.int64)
    pairs = [
        (numbers(a), numbers(t))
        for added, taken in zip(sampled["added"].to_pylist(), sampled["taken"].to_pylist()) for a, t in zip(added, taken)
    ]
    rows = [numbers(row.values.to_numpy(zero_copy_only=False)) for row in sampled["own"]]
    prior = totals.get(1, 0) / total if total else 0.0
    return fit(rows, pairs, sampled["label"].to_numpy().astype(np.int64), prior, how)


def toxicity_score(model: Model, text: str = "text") -> Column:
    """The score of a whole text, 0 to 1, by words alone; null and empty texts score by the intercept.

    The model is as large as its features, which the sample's bounds limit; it travels with the
    tasks. Every row is scored where it is read.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        logits = np.array([model.logit(features(words_of(t), model.buckets)) for t in texts], np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

    return score(whole_text(f"`{text}`"))


def score_toxicity(
    df: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
    output: str = "score", how: Training = Training(),
) -> DataFrame:
    """Add `output` double: how likely a whole text is toxic, learned from the labelled rows of `df`
    that are not held out.

    Null and empty texts: the score of a text without words. Null ids: scored, never learned
    from. Repeated rows stay repeated. An empty table gives an empty table; without labelled rows
    of both labels the score is the same for all. Other columns are kept; one that is called
    `output` is replaced.
    """
    model = train(df, labels, id=id, text=text, label=label, how=how)
    return df.withColumn(output, toxicity_score(model, text))

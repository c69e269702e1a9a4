"""Host-level quality rules: DataFrame expressions only, no Python on the executors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from xmlindex.llm.support import whole_text
from xmlindex.session import materialize

# What separates words, and the characters that count as symbols.
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the rules on a document, and of the verdict on its host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 5
    max_dup_line_percent: int = 40
    # A host is distrusted if the odds that a document of it fails, by its shrunk rate, are above
    # so many times the odds by the prior's mean; the limits of its documents are then divided.
    max_host_odds: float = 2.0
    distrusted_divisor: int = 2


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in a three-word window that the text has twice or more, first occurrences included.

    Windows are compared by a 64-bit hash. Where all differ there are none. Else they are sorted
    with their places: those with an equal neighbour repeat, and in order of place each adds the
    words that the one before does not cover.
    """

    def count(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(sorted_: Column) -> Column:
            def again(x: Column, j: Column) -> Column:
                before, after = F.get(sorted_, j - 1)["h"], F.get(sorted_, j + 1)["h"]
                return F.when(before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"]), x["i"])

            return F.sort_array(F.filter(F.transform(sorted_, again), lambda i: i.isNotNull()))

        def cover(state: Column, i: Column) -> Column:
            fresh = F.least(F.lit(3), i - state["last"])
            return F.struct((state["n"] + fresh).alias("n"), i.alias("last"))

        empty = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        covered = F.aggregate(_let(placed, starts), empty, cover, lambda s: s["n"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= 3, _let(hashes, count)).otherwise(F.lit(0))


def signals(text: Column) -> Column:
    """A struct of counts (long) for one text: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            F.length(F.array_join(words, "")).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        )

    def counts(whole: Column) -> Column:
        words = F.filter(F.split(whole, WORD_GAP), lambda w: w != "")
        lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return _let(
            F.struct(
                _let(words, of_words).alias("w"),
                _let(lines, of_lines).alias("l"),
                F.regexp_count(whole, F.lit(SYMBOLS)).alias("n_symbols"),
            ),
            lambda s: F.struct(*(
                c.cast("long").alias(name)
                for name, c in [
                    ("n_words", s["w"]["n_words"]), ("word_chars", s["w"]["word_chars"]),
                    ("n_symbols", s["n_symbols"]), ("n_lines", s["l"]["n_lines"]),
                    ("n_dup_lines", s["l"]["n_dup_lines"]), ("n_repeat_words", s["w"]["n_repeat_words"]),
                ]
            )),
        )

    return _let(text, counts)


def _base(s: Column, rules: Rules) -> Column:
    return (s["n_words"] < rules.min_words) | (
        100 * s["n_repeat_words"] > rules.max_repeat_percent * s["n_words"]
    )


def _failures(s: Column, rules: Rules, divisor: Column | int = 1) -> Column:
    """How many rules a document fails, with the limits divided by `divisor`."""
    failures = [
        s["n_words"] < rules.min_words,
        100 * s["n_repeat_words"] * divisor > rules.max_repeat_percent * s["n_words"],
        100 * s["n_symbols"] * divisor > rules.max_symbol_percent * s["word_chars"],
        # One repeated line may be a heading that a footer repeats.
        (s["n_dup_lines"] >= 2) & (100 * s["n_dup_lines"] * divisor > rules.max_dup_line_percent * s["n_lines"]),
    ]
    return sum((f.cast("int") for f in failures), F.lit(0))


def host_verdicts(judged: DataFrame, rules: Rules) -> DataFrame:
    """One row per host: n_documents, n_failed, rate shrunk by an empirical beta prior, distrusted.

    The prior's mean and variance are those of the hosts' own rates, less what chance alone
    gives hosts of their size (method of moments). If hosts differ by no more than chance, every
    host is shrunk all the way to the common rate.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n_documents"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    n, rate = F.col("n_documents"), F.col("n_failed") / F.col("n_documents")
    moments = hosts.agg(
        F.count("*").alias("h"), F.sum(n).alias("n"), F.sum("n_failed").alias("x"),
        F.sum(n * n).alias("nn"), F.sum(n * rate * rate).alias("nrr"),
    )
    # Sums over hosts weighted by documents; between-host variance after the binomial part.
    mean = F.col("x") / F.col("n")
    within = mean * (1 - mean)
    spread = F.col("nrr") / F.col("n") - mean * mean
    share = F.col("nn") / (F.col("n") * F.col("n"))
    between = (spread - within * (F.col("h") - 1) / F.col("n")) / F.greatest(1 - share, F.lit(1e-9))
    prior = moments.select(
        mean.alias("mean"),
        # Weight of the prior in documents; without between-host variance it outweighs every host.
        F.when(between > 1e-9, F.greatest(within / between - 1, F.lit(1.0))).otherwise(F.lit(1e12)).alias("weight"),
    )
    shrunk = (F.col("n_failed") + F.col("weight") * F.col("mean")) / (n + F.col("weight"))
    return (
        hosts.join(F.broadcast(prior))  # one row
        .select("host", "n_documents", "n_failed", shrunk.alias("rate"), "mean")
        .withColumn("distrusted", F.col("rate") * (1 - F.col("mean")) > rules.max_host_odds * F.col("mean") * (1 - F.col("rate")))
        .drop("mean")
    )


def _counted(df: DataFrame, names: list[str], text: str, host: str) -> DataFrame:
    """A written table of the columns `names` (as `carried`), the host and the signals of each row."""
    return materialize(
        df.select(
            F.struct(*(F.col(f"`{c}`") for c in names)).alias("carried"),
            F.col(f"`{host}`").cast("string").alias("host"),
            signals(whole_text(f"`{text}`")).alias("signals"),
        ),
        "signals",
    )


def keep_documents(df: DataFrame, *, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of `df` that `judge_quality` keeps, as they are.

    Most rows are decided by their own counts: they fail a rule, or stay below the limits of
    distrusted hosts too. Only the others are held against their host, so no text moves but theirs.
    Nulls, repeated rows and empty tables: as with `judge_quality`.
    """
    counted = _counted(df, df.columns, text, host)
    s = F.col("signals")
    plain, strict = _failures(s, rules) > 0, _failures(s, rules, rules.distrusted_divisor) > 0
    verdicts = host_verdicts(counted.select("host", plain.alias("failed")), rules)
    distrusted = verdicts.where("distrusted").select(F.col("host").alias("host_"))
    decided = counted.where(~plain & ~strict).select("carried")
    doubtful = counted.where(~plain & strict).join(distrusted, F.col("host").eqNullSafe(F.col("host_")), "left_anti")
    kept = decided.unionAll(doubtful.select("carried"))
    return kept.select(*(F.col("carried").getField(c).alias(c) for c in df.columns))


def judge_quality(
    df: DataFrame,
    *,
    text: str = "text",
    host: str = "source",
    output: str = "quality",
    rules: Rules = Rules(),
    carry: list[str] | None = None,
) -> DataFrame:
    """The columns `carry` (default: all) and the struct `output`: the counts, base_failed,
    n_failures, host_rate, distrusted, kept.

    Each document is held against the rules; failures are counted per host, host rates shrunk by
    an empirical beta prior, and the verdicts joined back. A document goes if it fails a rule;
    on a distrusted host the limits of the percentages are halved. A document that stays below
    half of every limit and has words enough is kept, whatever its host.

    The counts are written to the shared folder once, as the hosts' rates and the verdicts both
    need them. Null text: empty, which is too short. Null host: a host of its own. Repeated rows
    each count and stay repeated. An empty table gives an empty table. A column that is called
    `output` is replaced. A host that holds a third of all rows is summed up where its rows are
    read; the join back is a plain equi-join, which adaptive execution splits.
    """
    names = [c for c in (df.columns if carry is None else carry) if c.lower() != output.lower()]
    counted = _counted(df, names, text, host)
    s = F.col("signals")
    verdicts = host_verdicts(counted.select("host", (_failures(s, rules) > 0).alias("failed")), rules)
    side = verdicts.select(F.col("host").alias("host_"), "rate", "distrusted")
    divisor = F.when(F.col("distrusted"), F.lit(rules.distrusted_divisor)).otherwise(F.lit(1))
    base, n_failures = _base(s, rules), _failures(s, rules, divisor)
    return counted.join(side, F.col("host").eqNullSafe(F.col("host_")), "left").select(
        *(F.col("carried").getField(c).alias(c) for c in names),
        F.struct(
            "signals.*",
            base.alias("base_failed"),
            n_failures.alias("n_failures"),
            F.col("rate").alias("host_rate"),
            "distrusted",
            (~base & (n_failures == 0)).alias("kept"),
        ).alias(output),
    )

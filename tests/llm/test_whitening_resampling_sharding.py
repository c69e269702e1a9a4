"""Whitening, resampling and sharding on small tables against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from xmlindex.llm import resampling, sharding, whitening
from xmlindex.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped():
    ship_package()


# --- Whitening --------------------------------------------------------------------------------

def covariance(rows):
    n, sums = len(rows), [sum(column) for column in zip(*rows)]
    centred = np.array([[(n * x - s) / n for x, s in zip(row, sums)] for row in rows])
    return centred, centred.T @ centred / n


def vectors_of(rng, n, spectrum):
    turn = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    return (100_000 + 1000 * rng.standard_normal((n, len(spectrum))) * np.sqrt(spectrum) @ turn).astype(int).tolist()


@pytest.mark.parametrize("spectrum", [[9, 5, 3, 1, .5, .2], [50, 1.2, 1.1, 1, .95, .9, .85, .8, .75, .7, .65, .6]])
def test_components_whiten(spark, spectrum):
    rows = vectors_of(np.random.default_rng(1), 150, spectrum)
    frame = spark.createDataFrame([(i, row, "clash") for i, row in enumerate(rows)], "vec_id int, vector array<bigint>, whitening string")
    how = whitening.Fitting(components=3, guard=2)
    model = whitening.fit_whitening(frame, how=how)
    centred, v = covariance(rows)
    values, found = np.linalg.eigh(v)
    assert np.allclose(model.eigenvalues, values[::-1][:3], rtol=1e-11)
    assert np.allclose(np.abs(model.components @ found[:, ::-1][:, :3]), np.eye(3), atol=1e-9)
    assert math.isclose(model.trace, np.trace(v), rel_tol=1e-12) and model.identity_error < 1e-9
    assert model.passes > 1 and (model.residuals <= how.tolerance * model.eigenvalues[0]).all()
    got = {r["vec_id"]: r["whitening"] for r in whitening.whiten(frame, model).collect()}
    expected = centred @ model.components.T / np.sqrt(model.eigenvalues)
    sums = [sum(column) for column in zip(*rows)]
    for i, row in enumerate(rows):
        assert np.allclose(got[i]["whitened"], expected[i], atol=1e-9)
        assert int(got[i]["deviation"]) == sum((len(rows) * x - s) ** 2 for x, s in zip(row, sums))


def test_what_takes_no_part_in_whitening(spark):
    nan, inf, huge = float("nan"), float("inf"), 1e300
    rows = [[1.0, 2.0], [2.5, -1.0], [0.25, 0.5], [0.25, 0.5], None, [1.0, None], [nan, 1.0], [1.0, -inf], [huge, 1.0], [], [1.0, 2.0, 3.0]]
    frame = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "vec_id int, embedding array<double>")
    vectors = frame.select("vec_id", whitening.quantise_shifted(F.col("embedding")).alias("vector"))
    assert {r["vec_id"] for r in vectors.where("vector is null").collect()} == {4, 5, 6, 7, 8, 9}
    model = whitening.fit_whitening(vectors)
    assert model.n == 4 and len(model.eigenvalues) == 2
    assert {r["vec_id"] for r in whitening.whiten(vectors, model).collect()} == {0, 1, 2, 3}


def test_vectors_without_variance_have_no_components(spark):
    same = spark.createDataFrame([([5, 6, 7],)] * 9, "vector array<bigint>")
    model = whitening.fit_whitening(same)
    assert model.n == 9 and len(model.eigenvalues) == 0 and model.trace == 0
    assert [r["whitening"]["whitened"] for r in whitening.whiten(same, model).collect()] == [[]] * 9
    for empty in (same.limit(0), spark.createDataFrame([(None,)], "vector array<bigint>")):
        model = whitening.fit_whitening(empty)
        assert model.n == 0 and whitening.whiten(empty, model).count() == 0
    line = spark.createDataFrame([([n, 2 * n, 3 * n, 7],) for n in range(20)], "vector array<bigint>")
    model = whitening.fit_whitening(line, how=whitening.Fitting(components=3, guard=0))
    assert len(model.eigenvalues) == 1 and model.identity_error < 1e-12


def test_large_means_and_deviations_stay_exact(spark):
    top = (1 << 52) - 1
    rows = [[top, 3], [top - 1, 4], [top - 5, 9], [-top, 1]]
    frame = spark.createDataFrame([(r,) for r in rows], "vector array<bigint>")
    model = whitening.fit_whitening(frame)
    assert model.sums == (sum(r[0] for r in rows), 17)
    got = sorted(int(r["whitening"]["deviation"]) for r in whitening.whiten(frame, model).collect())
    assert got == sorted(sum((4 * x - s) ** 2 for x, s in zip(r, model.sums)) for r in rows)


# --- Resampling -------------------------------------------------------------------------------

def words_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def features_of(text, longest, buckets):
    words = words_of(text)
    grams = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in grams]


def resampled(documents, target, how):
    """(id, n_features, weight, score, rank) of every document, by definition."""
    source = Counter(b for _, t in documents for b in features_of(t, how.longest, how.buckets))
    wanted = Counter(b for t in target for b in features_of(t, how.longest, how.buckets))
    all_s, all_t = sum(source.values()) + how.buckets, sum(wanted.values()) + how.buckets
    rows = []
    for name, text in documents:
        found = features_of(text, how.longest, how.buckets)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * all_s / ((source[b] + 1) * all_t))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if name is None else name}".encode()).hexdigest()[:8], 16)
        rows.append((name, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))), len(words_of(text))))
    able = sorted((r for r in rows if r[4] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    drawn = {}
    for rank, row in enumerate(able[:how.percent * len(able) // 100], 1):
        drawn.setdefault(row, []).append(rank)
    result = []
    for row in rows:
        at = ranks[row]
        ranks[row] += 1
        result.append((*row[:4], drawn.get(row, [])[at] if at < len(drawn.get(row, [])) else None))
    return Counter(result)


VOCABULARY = "the Cat sat on 12 mats käse 中文 x1 over-under don't far away from home".split()


def texts(n, seed=3):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(VOCABULARY, rng.integers(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("longest", [1, 3])
def test_draw_equals_its_definition(spark, longest):
    how = resampling.Resampling(longest=longest, buckets=97, percent=30, least_words=5)
    documents = [*enumerate(texts(120)), (500, None), (501, ""), (502, "\x00 ,;"), (None, "a b c d e f"), (None, "g h i j k l")]
    documents += [(900, "the same cat " * 5)] * 70  # a third of the rows are one
    target = ["the cat sat", None, "home 中文"]
    frame = spark.createDataFrame([(i, t, "clash", 7) for i, t in documents], "doc_id long, text string, resampling string, rank int")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    drawn = resampling.resample(frame.repartition(5), goal, how)
    assert drawn.columns == ["doc_id", "rank", "resampling"]
    got = Counter((r["doc_id"], *(r["resampling"][c] for c in ("n_features", "weight", "score", "rank"))) for r in drawn.collect())
    assert got == resampled(documents, target, how)


def test_empty_tables_give_empty_draws(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    full = spark.createDataFrame([*enumerate(texts(40))], "doc_id long, text string")
    assert resampling.resample(frame, full).count() == 0
    how = resampling.Resampling()
    got = {r["doc_id"]: r["resampling"]["rank"] for r in resampling.resample(full, frame).collect()}
    want = {name: rank for (name, _, _, _, rank), _ in resampled([*enumerate(texts(40))], [], how).items()}
    assert got == want


def test_long_texts_are_split_between_words():
    text = ("ab CD-ef " * 5000 + "z" * 700 + " ¿é 9").encode()
    for size in (1, 7, 64, 1 << 20):
        assert [w.decode() for block in resampling.word_blocks(text, size) for w in block] == words_of(text.decode())


def test_cutoff_is_exact_for_ties_and_any_count(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(-3, 3)), int(rng.integers(0, 2)), int(rng.integers(0, 4)), i) for i in range(200)]
    keys = spark.createDataFrame(rows, "falling long, nameless long, named long, row long").repartition(7).cache()
    for wanted in (1, 2, 57, 100, 199, 200):
        assert resampling.cutoff_key(keys, wanted) == sorted(rows)[wanted - 1]
    assert resampling.cutoff_key(keys, 0) is None


# --- Sharding ---------------------------------------------------------------------------------

@pytest.mark.parametrize("width, bits", [(1, 4), (2, 4), (3, 3), (4, 2), (5, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(spark, width, bits):
    side = 1 << bits
    axes = [F.shiftright("id", n * bits).bitwiseAND(side - 1).cast("int") for n in range(width)]
    cells = spark.range(side**width).select(sharding.hilbert_index(axes, bits).alias("h"), F.array(*axes).alias("cell"))
    rows = sorted(cells.collect())
    assert [r["h"] for r in rows] == list(range(side**width))
    assert all(sum(abs(x - y) for x, y in zip(a["cell"], b["cell"])) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_follow_the_curve(spark):
    rng = np.random.default_rng(9)
    rows = [(i, str(rng.choice(["de", "en", None])), f"http://host{rng.integers(30)}", int(rng.integers(1000)), "clash") for i in range(300)]
    rows += [(7, "en", "http://host3", 50, "clash")] * 150 + [(None, None, None, None, None)] * 3
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long, sharding string").repartition(4)
    for shards in (1, 8, 1000):
        got = sharding.shard_rows(frame, shards, ties=["doc_id"]).collect()
        assert Counter(r[:4] for r in got) == Counter(r[:4] for r in rows)
        by_shard = Counter(r["sharding"]["shard"] for r in got)
        sizes = [by_shard[s] for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        slots = sorted((r["sharding"]["shard"], r["sharding"]["slot"]) for r in got)
        assert slots == [(s, n) for s in range(shards) for n in range(sizes[s])]
        order = sorted(got, key=lambda r: (r["sharding"]["shard"], r["sharding"]["slot"]))
        keys = [(r["sharding"]["curve"], r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
        assert keys == sorted(keys)
    assert sharding.shard_rows(frame.limit(0), 8).count() == 0


def test_steps_are_equally_filled_and_keep_the_order(spark):
    values = [f"common/{i:05d}" for i in range(640)]
    frame = spark.createDataFrame([(v, i * i, None) for i, v in enumerate(values)], "a string, b long, c string")
    steps = sharding.quantised(frame, ["a", "b", "c"], bits=4)
    rows = frame.select("a", *[s.alias(f"s{n}") for n, s in enumerate(steps)]).orderBy("a").collect()
    for column in ("s0", "s1"):
        assert [r[column] for r in rows] == sorted(r[column] for r in rows)
        assert set(Counter(r[column] for r in rows).values()) == {40}
    assert {r["s2"] for r in rows} == {0}


def test_files_can_be_left_unread(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, f"l{rng.integers(16):02d}", f"s{rng.integers(64):02d}", int(rng.integers(10_000))) for i in range(4096)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long")
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_rows(frame, 64), path)
    written = spark.read.parquet(path)
    assert written.count() == 4096 and written.select("shard").distinct().count() == 64
    boxes = written.groupBy("shard").agg(*[f(c).alias(f"{n}_{c}") for c in ("lang", "source", "n_chars") for n, f in (("lo", F.min), ("hi", F.max))])
    read = {c: boxes.where((F.col(f"lo_{c}") <= v) & (F.col(f"hi_{c}") >= v)).count() for c, v in (("lang", "l05"), ("source", "s40"), ("n_chars", 1234))}
    assert all(n <= 24 for n in read.values()), read

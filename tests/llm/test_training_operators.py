"""The training-data operators on small tables with nulls, empty and long texts, ties and repeats."""

import pathlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from xmlindex.llm import bpe, chat, licenses, near_dedup, packing, quality, support, token_counts, token_files, topk, toxicity
from xmlindex.llm.tokenizer import encoder
from xmlindex.session import ship_package, staging_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, lang string, source string, ids string"
ODD = ["", None, " ", "a" * 900, " " * 300 + "x", "one two<|endoftext|> three\n\n", "käse 中文 😀!" * 40, "ab 12's " * 60]


@pytest.fixture(scope="module", autouse=True)
def shipped():
    ship_package()


def documents(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, "clash") for i, t in enumerate(texts)], SCHEMA)


def reference(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_leaves_join_to_the_library_ids():
    rng = random.Random(5)
    parts = ["a", "the", " ", "\n", "é", "'s", "!", "<|endoftext|>", "12", "\x85", "中文", "<|", "hh"]
    cutter = encoder(PATH)
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 90)))
        for leaf in (5, 17):
            assert cutter.encode(text, leaf).tolist() == reference(text)


def test_halves_of_unbroken_texts_are_joined_by_windows(monkeypatch):
    cutter = encoder(PATH)
    joins = Counter()
    join, window = cutter.join, cutter._window
    monkeypatch.setattr(cutter, "join", lambda *x: joins.update(joins=1) or join(*x))
    monkeypatch.setattr(cutter, "_window", lambda *x: joins.update(windows=1, ids=len(x[0][-x[2]:]) + len(x[1][:x[2]])) or window(*x))
    rng = random.Random(12)
    texts = ["ab" * 3000, " " * 5000 + "x", "x" + "\n" * 4000, "!?" * 3000, "9" * 4001, "中文字" * 900, "it's we're 'tis " * 300,
             "".join(rng.choice("abcde") for _ in range(9000)), " ".join(rng.choice(["wörd", "It's", "12", "...", "x"]) for _ in range(4000))]
    for text in texts:
        assert cutter.encode(text, 500).tolist() == reference(text)
    assert joins["joins"] > 100 and joins["windows"] >= joins["joins"]
    # Windows stay around the joins where words end.
    joins.clear()
    cutter.encode(texts[-1], 500)
    assert joins["ids"] < 40 * joins["joins"]
    for size in (1, 2, 4):
        monkeypatch.setattr(cutter, "join", lambda a, b: join(a, b, size))  # noqa: B023
        for text in texts[5:]:
            assert cutter.encode(text, 37).tolist() == reference(text)


def test_long_texts_of_the_table_pass_through_joins(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 16384").collect()
    cutter = encoder(PATH)
    assert rows
    for row in rows:
        kinds = Counter(kind for kind, _ in cutter.leaves(row["text"]))
        assert kinds["open"] == 1 and kinds["part"] >= 1
        assert cutter.encode(row["text"]).tolist() == reference(row["text"])


def test_encode_and_decode_whole_texts(spark):
    df = documents(spark, ODD + ODD[3:5])
    encoded = bpe.encode_texts(df, PATH, leaf_chars=64)
    rows = bpe.decode_ids(encoded, PATH).collect()
    assert len(rows) == len(ODD) + 2 and set(rows[0].asDict()) == {"doc_id", "text", "lang", "source", "ids", "decoded"}
    for row in rows:
        assert row["ids"] == reference(row["text"]) and row["decoded"] == (row["text"] or "")
    assert bpe.encode_texts(df.limit(0), PATH).count() == 0


def test_counts_come_from_the_cache(spark):
    df = documents(spark, ODD + ODD)
    cache = token_counts.CountCache(spark, staging_path(spark, "cache"))
    for _ in range(2):
        got = token_counts.count_tokens(df, PATH, cache).collect()
        assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter(
            (i, len(reference(t))) for i, t in enumerate(ODD + ODD)
        )
    version = token_counts.file_version(PATH)
    assert cache.counts(version).count() == len({t or "" for t in ODD})
    assert cache.counts("another").count() == 0
    assert token_counts.count_tokens(df.limit(0), PATH, cache).count() == 0


def test_stored_counts_are_found_and_only_misses_encoded(spark):
    long = "many words " * 5000
    texts = ["one text", "another", None, long] + ["everywhere"] * 40
    df = documents(spark, texts).withColumn("N_tokens", F.lit("clash"))
    cache = token_counts.CountCache(spark, staging_path(spark, "cache"))
    token_counts.count_tokens(df.where("doc_id < 2"), PATH, cache)
    # A wrong stored count shows that it is taken and not counted again.
    version = token_counts.file_version(PATH)
    cache.append(spark.createDataFrame([("another", 77)], "text string, n_tokens long").select(F.unhex(F.sha2("text", 256)).alias("digest"), "n_tokens"), version)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, PATH, cache, carry=["doc_id"]).collect()}
    expected = {i: len(reference(t)) for i, t in enumerate(texts)}
    assert got == {**expected, 1: 77}
    runs = spark.read.parquet(f"{cache.path}/run=*").groupBy(F.input_file_name()).count()
    assert runs.agg(F.sum("count")).first()[0] == 2 + 1 + 3


def test_other_tokenizer_files(spark):
    model = public_tokenizers.path("piece_bpe_32k.model")
    cache = token_counts.CountCache(spark, staging_path(spark, "cache"))
    got = token_counts.count_tokens(documents(spark, ["Some words here.", None]), model, cache).collect()
    import sentencepiece

    expected = len(sentencepiece.SentencePieceProcessor(model_file=model).encode("Some words here."))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {0: expected, 1: 0}


def test_packing_places_every_piece(spark):
    texts = ["word " * n for n in (1, 1, 3, 9, 40, 41, 200, 7)] + [None, ""]
    how = packing.Evolution(islands=2, stall=2, generations=2, population=3)
    rows = packing.pack_texts(documents(spark, texts).drop("ids"), PATH, capacity=32, with_ids=True, how=how).collect()
    sequences = {}
    for i, text in enumerate(texts):
        ids = reference(text) + [2]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == ids
        assert all(r["length"] == 32 for r in own[1:]) and [r["start"] for r in own][0] == 0
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 32
    assert len(sequences) <= -(-sum(r["length"] for r in rows) // 32) + 1
    assert packing.pack_texts(documents(spark, []).drop("ids"), PATH, capacity=32).count() == 0


def test_crossover_keeps_every_piece():
    rng = random.Random(3)
    counts = dict(Counter(rng.randint(1, 60) for _ in range(500)))
    parents = [packing.best_fit(counts, 64, rng=rng, slip=s) for s in (0.0, 0.3)]
    child = packing.mutate(packing.crossover(*parents, counts, 64, rng), 64, rng)
    for found in (*parents, child):
        held = Counter()
        for pattern, times in found.items():
            assert packing.used(pattern) <= 64
            for length, n in pattern:
                held[length] += n * times
        assert held == counts


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-40, 40, (150, 16))
    vectors[30:60] = vectors[30]
    rows = [(int(i), [int(x) for x in v], "extra") for i, v in enumerate(vectors)] + [(900, None, ""), (None, [1] * 16, "")]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>, score string")
    got = topk.top_k(df, df.where("vec_id % 10 = 0"), k=5, shard_rows=40, block_rows=8).collect()
    for q in range(0, 150, 10):
        scores = vectors @ vectors[q]
        best = sorted((int(-scores[c]), c) for c in range(150) if c != q)[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [
            (c, -s) for s, c in best
        ]
    assert topk.top_k(df.limit(0), df, k=5).count() == 0
    odd = spark.createDataFrame([([1.0, None],), ([float("nan")],), ([-0.5, 0.25],), (None,)], "v array<double>")
    assert [r[0] for r in odd.select(topk.quantise(F.col("v"))).collect()] == [None, None, [-512, 256], None]


def test_toxicity_learns_words_and_not_groups(spark):
    rng = random.Random(1)
    plain = [f"w{i}" for i in range(60)]
    texts, labels = [], []
    for i in range(400):
        words, toxic = rng.sample(plain, 12), i % 3 == 0
        # Toxic sentences mention one group far more often than others do.
        words += ["vile"] * toxic + ["muslim"] * (rng.random() < (0.6 if toxic else 0.1))
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    df = documents(spark, texts + ["", None])
    known = spark.createDataFrame([*labels, (None, 0, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    gap = {}
    for fairness in (0.0, 200.0):
        model = toxicity.train(df, known, how=toxicity.Training(fairness=fairness, min_deviations=2.0))
        score = lambda text: model.logit(toxicity.features(toxicity.words_of(text), model.buckets))  # noqa: B023,E731
        gap[fairness] = score("w1 w2 w3 muslim") - score("w1 w2 w3")
    assert gap[200.0] < 0.5 * gap[0.0]
    rows = df.select("doc_id", toxicity.toxicity_score(model).alias("p"), toxicity.held_out(F.col("doc_id")).alias("out")).collect()
    assert len(rows) == 402 and all(0 <= r["p"] <= 1 for r in rows)
    held = [r for r in rows if r["out"] and r["doc_id"] < 400]
    assert len(held) > 50 and sum((r["p"] >= 0.3) == (r["doc_id"] % 3 == 0) for r in held) / len(held) > 0.97
    nothing = toxicity.score_toxicity(df, known.limit(0))
    assert nothing.select("score").distinct().count() == 1


def brute_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
        len({i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}),
    )


def test_fewer_neutral_mentions_are_taken_for_toxic(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(900):
        words, toxic = rng.sample(plain, 15), i % 3 == 0
        # Most toxic sentences have a vile word; most name a group, which others seldom do.
        words += ["vile"] * (toxic and rng.random() < 0.8) + ["muslim"] * (rng.random() < (0.7 if toxic else 0.05))
        texts.append(" ".join(words))
        labels.append((i, int(toxic)))
    df = documents(spark, texts)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [" ".join(rng.sample(plain, 15)) + " muslim" for _ in range(200)]
    false, caught = {}, {}
    for fairness in (0.0, toxicity.Training().fairness):
        model = toxicity.train(df, known, how=toxicity.Training(fairness=fairness))
        score = lambda text: 1 / (1 + np.exp(-model.logit(toxicity.features(toxicity.words_of(text), model.buckets))))  # noqa: B023,E731
        false[fairness] = sum(score(t) >= 0.3 for t in neutral)
        caught[fairness] = sum(score(t) >= 0.3 for t in texts if "vile" in t)
    assert false[0.0] > 100 and false[toxicity.Training().fairness] < 10
    assert caught[toxicity.Training().fairness] >= 0.95 * sum("vile" in t for t in texts)
    assert toxicity.score_toxicity(df.limit(0).withColumn("Score", F.lit(1)), known).count() == 0


def test_quality_query_with_hosts_that_differ_equals_its_sql(spark, tmp_path):
    import duckdb

    from xmlindex.llm import queries

    good = " ".join(f"word{i}" for i in range(80))
    slight = good + " " + "# " * 13
    rows = [(i, "too short" if i % 5 == 0 else slight if i % 7 == 0 else good, "en", f"host{i % 6}", "") for i in range(600)]
    rows += [(1000 + i, "too short" if i % 4 else slight if i % 8 else good, "en", "bad", "") for i in range(200)]
    rows += [(2000, slight + " x" * 9000, "en", None, ""), (2001, good, "en", "bad", ""), (2002, good, "en", "bad", "")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in queries.QUERIES["op6_quality_rules"](spark, str(tmp_path)).collect())
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == Counter(base.execute(queries.SQL["op6_quality_rules"]).fetchall())
    kept = {r[0]: r[-1] for r in got}
    documents_ = spark.read.parquet(f"{tmp_path}/documents.parquet")
    again = documents_.union(documents_)
    left = quality.keep_documents(again)
    assert left.columns == again.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter({i: 2 for i in kept if kept[i]})
    assert quality.keep_documents(again.limit(0)).count() == 0
    assert not kept[1004] and kept[1000] and kept[7]


def test_quality_counts_and_host_verdicts(spark):
    rng = random.Random(4)
    texts = ODD + ["a b a b a b\nx\nx", " ".join(rng.choice("abcd") for _ in range(300))]
    good = " ".join(f"word{i}" for i in range(80))
    slight = good + " " + "# " * 13  # below the limit of symbols, above half of it
    rows = [(i, t, "en", None, "") for i, t in enumerate(texts)]
    rows += [(100 + i, "short", "en", "bad", "") for i in range(60)] + [(200, good, "en", "bad", ""), (201, slight, "en", "bad", "")]
    rows += [(300 + i, good, "en", "fine", "") for i in range(60)] + [(400, slight, "en", "fine", "")]
    got = {r["doc_id"]: r["ids"] for r in quality.judge_quality(spark.createDataFrame(rows, SCHEMA), output="ids").collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(texts):
        q = got[i]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == brute_signals(text)
    assert got[201]["distrusted"] and not got[400]["distrusted"]
    assert (got[200]["kept"], got[201]["kept"], got[400]["kept"]) == (True, False, True)
    assert quality.judge_quality(spark.createDataFrame([], SCHEMA)).count() == 0


def test_toxicity_learns_from_one_row_of_each_labelled_id_of_the_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, pairs, labels, *more: seen.append(sorted(labels.tolist())))
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    free = [r[0] for r in labels.where(~toxicity.held_out(F.col("doc_id"))).select("doc_id").orderBy("doc_id").collect()]
    here = [i for i in free if i >= 380]
    repeats = [(here[0], f"text {n}", "en", "s", "x") for n in range(9)]
    df = spark.createDataFrame([(i, "some words", "en", "s", "x") for i in here] + repeats, SCHEMA)
    for most in (3, 100):
        toxicity.train(df, labels, how=toxicity.Training(rows_per_label=most))
    counts = [sum(i % 2 == value for i in here) for value in (0, 1)]
    assert min(counts) > 3 and seen == [[0] * 3 + [1] * 3, [0] * counts[0] + [1] * counts[1]]


def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [(len(s), r) for s, r in zip(sets, root)]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = ["", None, " \n", "one", "One", "two words", "Two  words"]
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts += [" ".join(passage + [rng.choice(vocabulary) for _ in range(30)]) for _ in range(25)]
    for words, percent in ((3, 85), (5, 80)):
        how = near_dedup.Sketching(words=words, percent=percent, few=4)
        got = near_dedup.near_duplicates(documents(spark, texts), how=how).collect()
        expected = brute_components(texts, words, percent)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == dict(enumerate(expected))
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (7, text), (None, text), (8, text + " end"), (9, None), (9, None), (10, "else")]
    df = spark.createDataFrame([(i, t, "en", "s", "x") for i, t in rows], SCHEMA)
    left = near_dedup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter({(5, text): 1, (9, None): 2, (10, "else"): 1})
    assert near_dedup.drop_near_duplicates(df.limit(0)).count() == 0


def test_groups_without_an_id_or_with_one_id_keep_a_row_each(spark):
    texts = [" ".join(f"{name}{i}" for i in range(50)) for name in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " end"), (5, texts[2]), (5, texts[3]), (5, texts[3]),
            (7, texts[3] + " end"), (3, texts[4]), (None, texts[4]), (None, texts[5]), (None, texts[5])]
    df = spark.createDataFrame([(i, t, "en", "s", "x") for i, t in rows], SCHEMA)
    left = Counter((r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(df).collect())
    either = [key for key in left if key in ((None, texts[1]), (None, texts[1] + " end"))]
    assert len(either) == 1
    assert left == Counter([(None, texts[0]), *either, (5, texts[2]), (5, texts[3]), (3, texts[4]), (None, texts[5])])


def test_lists_find_contained_pairs_at_the_limit():
    rng = np.random.default_rng(4)
    for words, percent in ((3, 85), (5, 80)):
        how = near_dedup.Sketching(words=words, percent=percent)
        assert how.loss(how.lists) <= how.missed < how.loss(how.lists - 1)
        # Against drawn sets: the smaller one is `percent` of the larger.
        lost, few = 0, 5
        for _ in range(1000):
            whole = rng.integers(0, 1 << 63, 1000, np.uint64)
            sketches = [np.sort(s)[: how.retained] for s in (whole, whole[: 10 * percent])]
            a, b = near_dedup.list_keys(sketches, few, how.per_key)
            lost += not (a == b).any()
        assert abs(lost / 1000 - how.loss(few)) < 0.03


def test_chat_round_trip(spark):
    trap = "a &lt;| <|im_end|>\n<|im_start|>assistant <|im_sep|> & <"
    rows = [
        (1, 0, "user", trap), (1, 1, "assistant", "x"), (1, 2, "assistant", trap), (1, 3, None, None),
        (2, None, "odd\nrole", ""), (2, 1, "assistant", ""), (2, 1, "assistant", "tie"), (None, 0, "user", "|>"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(df)
    read = formatted.select(
        "conv_id", chat.parse_formatted(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted",
    ).collect()
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss"]) for r in read}
    assert got == {
        1: ([("user", trap), ("assistant", "x"), ("assistant", trap), ("", "")], "x" + trap),
        2: ([("odd\nrole", ""), ("assistant", ""), ("assistant", "tie")], "tie"),
        None: ([("user", "|>")], ""),
    }
    assert next(r["formatted"] for r in read if r["conv_id"] == 1).count("<|im_start|>") == 3
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_token_files_round_trip(spark):
    texts = ODD + ["some text"] * 3
    rows = [(i % 9 if i else None, t, "en", "s", "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = staging_path(spark, "files")
    token_files.write_texts(df, path, PATH, 2)
    got = token_files.read_tokens(spark, path).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, (*reference(t), 2)) for i, t, *_ in rows)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += len(r["ids"])
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert sorted(token_files.read_document(spark, path, 4)) == sorted([*reference(t), 2] for i, t, *_ in rows if i == 4)
    empty = staging_path(spark, "files")
    token_files.write_texts(df.limit(0), empty, PATH, 2)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_dictionary_sample_takes_distinct_texts_and_any_part(spark):
    texts = [" ".join(f"{name}{i}" for i in range(200)) for name in "abcdefghijklmnopqrst"]
    df = documents(spark, texts + ["copy"] * 1500 + [None, ""])
    sample = [r["text"] for r in token_files.sample_texts(df, text="text", rows=1000, chars=100).collect()]
    assert len(sample) == len(texts) + 2 and {"copy", ""} < set(sample)
    windows = {next(t for t in texts if w in t): w for w in sample if w not in ("copy", "")}
    assert set(windows) == set(texts) and all(len(w) == 100 for w in windows.values())
    assert any(not t.startswith(w) for t, w in windows.items())


def test_license_scan(spark):
    texts = [
        "Released under the MIT License. Also the mit-license!", None, "", "cc", "CC BY-NC 4.0 and GNU General Public License",
        "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and the "
        "associated documentation files (the Software), to deal in the Software without restriction",
        "of the of the of the", "ſmit license",
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, texts + texts[:1])).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        places = [
            (at, label) for phrase, label in licenses.PHRASES.items() for at in range(len(words))
            if words[at:at + len(phrase.split())] == phrase.split()
        ]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert got[5]["labels"] == "mit" and got[5]["base_labels"] == "" and 0 < got[5]["score"] < 1
    assert got[6]["labels"] == "" and got[6]["score"] == 0 and got[0]["score"] == 1
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_similar_licenses_are_told_apart(spark):
    free = "This {} is free software; you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation"
    work = "This work is licensed under a Creative Commons {} License"
    cases = [
        ("Licensed under CC BY 4.0", "cc-by"), ("Licensed under CC BY-SA 4.0", "cc-by"),
        ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"), ("licensed under CC BY-NC 3.0", "cc-by,cc-by-nc"),
        (free.format("program", "GNU General Public License"), "gpl"),
        (free.format("library", "GNU General Public License"), "gpl"),
        (free.format("library", "GNU Lesser General Public License"), "lgpl"),
        (free.format("program", "GNU Lesser General Public License"), "lgpl"),
        (free.format("library", "GNU Library General Public License"), "lgpl"),
        (free.format("program", "GNU Affero General Public License"), ""),
        (free.format("program", "GNU General Public Licence").replace("you can ", "you may "), "gpl"),
        (free.format("program", "GNU General Public License") + ". " + free.format("library", "GNU Lesser General Public License"), "gpl,lgpl"),
        ("This work is licensed under the GNU Lesser General Public License version 3", "lgpl"),
        (work.format("Attribution 4.0 International"), "cc-by"), (work.format("Attribution-ShareAlike 4.0 International"), "cc-by-sa"),
        (work.format("Attribution 3.0 Unported"), "cc-by"), (work.format("Attribution-Share Alike 3.0 Unported"), "cc-by-sa"),
        (work.format("Attribution"), "cc-by"), (work.format("Attribution-NonCommercial 4.0 International"), ""),
        (work.format("Attribution-NonCommercial-ShareAlike 3.0 Unported"), ""),
        ("Licensed under the Apache Licence, Version 2.0", "apache"), ("Licensed under the Mozilla Public License, Version 2.0", ""),
    ]
    # Each notice against all others; a base phrase within it gives its label as well.
    cases += [
        (notice, ",".join(sorted({label, *(known for phrase, known in licenses.PHRASES.items() if phrase in notice)})))
        for notice, label in licenses.NOTICES.items()
    ]
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(documents(spark, [text for text, _ in cases])).collect()}
    assert [(text, got[i]) for i, (text, _) in enumerate(cases)] == cases
    notices = {"you may use red things under this": "a", "you may use red things under this and those": "b"}
    rows = licenses.scan_licenses(documents(spark, list(notices)), notices=notices).collect()
    assert {r["doc_id"]: r["labels"] for r in rows} == {0: "a", 1: "b"}


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{i}" for i in range(300)]
    rng = random.Random(6)
    clean = [" ".join(rng.sample(words, 90)) for _ in range(40)]
    toxic = [t + " vile" for t in (" ".join(rng.sample(words, 90)) for _ in range(40))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate([*clean, *toxic, clean[0], clean[1] + " more", "short", None])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(40 <= i < 80)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in docs.collect()} == set(range(40))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(range(40))




def test_parities_never_exceed_the_difference_of_sets():
    rng = np.random.default_rng(5)
    for size in (0, 1, 40, 900, 20_000):
        for changed in (0, 1, 7, 300):
            one = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
            other = np.unique(np.concatenate([one[min(changed, len(one)):], rng.integers(0, 1 << 63, changed, np.uint64)]))
            bits = near_dedup.parities(one) ^ near_dedup.parities(other)
            counted = sum(int(w).bit_count() for w in bits.view(np.uint64))
            assert counted <= len(np.setxor1d(one, other))
            if changed == 1 and size > 1:
                assert counted in (0, 2)


def test_a_worker_holds_what_its_step_asks_for():
    made = []
    for key in ("a", "a", "b", "a"):
        support.held((key,), lambda: made.append(key) or key)
    assert made == ["a", "b", "a"]


def test_token_files_leave_no_staged_frames(spark, tmp_path):
    from xmlindex.llm import token_files
    from xmlindex.llm.queries import END_ID, TOKENIZER
    from xmlindex.session import staging_root

    folder = pathlib.Path(staging_root(spark).removeprefix("file:")) / "xmlindex"
    before = set(folder.glob("frames-*"))
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, text string")
    token_files.write_texts(df, str(tmp_path / "t"), TOKENIZER, END_ID)
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 3
    assert set(folder.glob("frames-*")) == before


def test_token_files_go_from_encoder_to_shard_without_a_copy_or_the_texts(spark, tmp_path, monkeypatch):
    from xmlindex import session

    def no_copy(*_):
        raise AssertionError("something is staged")

    carried = []

    def encode(df, *args, **named):
        carried.append(set(named.get("carry") or df.columns))
        return bpe.encode_texts(df, *args, **named)

    monkeypatch.setattr(session, "staging_path", no_copy)
    monkeypatch.setattr(token_files, "encode_texts", encode)
    rng = random.Random(3)
    long = " ".join(rng.choice("abcdefgh") * 3 for _ in range(9000))  # more than a leaf
    texts = [long, None, *("x" * rng.randint(0, 9) for _ in range(500))]
    rows = [(rng.choice([None, -3, 7, *range(60)]), t, "en", "s", "x") for t in texts]
    path = str(tmp_path / "t")
    token_files.write_texts(spark.createDataFrame(rows, SCHEMA).repartition(3), path, PATH, 2)
    assert {"doc_id", "tie"} in carried and not any({"doc_id", "text"} <= c for c in carried)

    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, (*reference(t), 2)) for i, t, *_ in rows)
    assert [r["start"] for r in got] == [sum(len(r["ids"]) for r in got[:n]) for n in range(len(got))]
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("shard", "block").collect()
    assert {b["shard"] for b in blocks} == {0, 1}
    assert min(Counter(b["shard"] for b in blocks for _ in b["doc_ids"]).values()) > 100


def test_token_files_cut_one_id_by_its_texts(spark, tmp_path):
    rows = [(5, f"text {i}", "en", "s", "x") for i in range(400)]
    token_files.write_texts(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), PATH, 2)
    got = token_files.read_tokens(spark, str(tmp_path / "t")).collect()
    assert Counter(tuple(r["ids"]) for r in got) == Counter((*reference(t), 2) for _, t, *_ in rows)
    assert {b["shard"] for b in spark.read.parquet(f"{tmp_path}/t/blocks").collect()} == {0, 1}
    assert len(token_files.read_document(spark, str(tmp_path / "t"), 5)) == 400

    # Ids without a tie of their own are ordered by a hash of them.
    ids = spark.createDataFrame([(i % 3 or None, [i, i + 1] if i % 7 else None) for i in range(300)], "doc_id long, ids array<int>")
    token_files.write_tokens(ids, str(tmp_path / "u"), 1 << 17, b"")
    got = sorted(token_files.read_tokens(spark, str(tmp_path / "u")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 100 + [1] * 100 + [2] * 100
    assert Counter(tuple(r["ids"]) for r in got) == Counter(tuple(r["ids"] or ()) for r in ids.collect())


def test_encoder_carries_what_it_is_asked_to(spark):
    df = documents(spark, ["one two", None, "x" * 200])
    encoded = bpe.encode_texts(df, PATH, carry=["doc_id", "ids"], leaf_chars=64)
    assert encoded.columns == ["doc_id", "ids"]
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {0: reference("one two"), 1: [], 2: reference("x" * 200)}
    assert "text" in bpe.encode_texts(df, PATH).columns

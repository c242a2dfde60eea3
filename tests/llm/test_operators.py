"""Operators of the training-data subpackage against brute force, on small hand-made tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from wattspan.llm import registry
from wattspan.llm.common import shingle_hashes, words_of
from wattspan.llm.decontamination import hit_words, scan
from wattspan.llm.jaccard_join import jaccard_join, needed_matches
from wattspan.llm.packing import pack, sequences, shortest_pack_first, token_pieces
from wattspan.llm.substring_dedup import remove_repeats, repeated_passages
from wattspan.llm.token_counts import UnigramCounter, token_counts, vocabulary
from wattspan.llm.token_files import read_token_files, write_token_files
from wattspan.llm.url_filter import judge_urls
from wattspan.llm.vector_search import search, valid_vectors

LONG = " ".join(f"word{k}" for k in range(3000))
TEXTS = [
    (1, "Hello, World! It's  a test.\nNew line.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, LONG, "de"),
    (4, LONG, "de"),
    (None, "no id here", "fr"),
    (6, "<|endoftext|> odd\x1cspace\u3000and é́ Σας", "x"),
]
SCHEMA = "doc_id long, text string, lang string, ids string, row int, start string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, "clash", 7, "s") for t in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def token_ids(file, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(file)).encode(text or "", add_special_tokens=False).ids


def test_packing_is_a_gapless_partition_of_all_ids(spark, docs, empty):
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=64)
    packed = pack(pieces, 64)
    got = packed.toPandas()
    for key, text, _ in TEXTS:
        expected = np.array([*token_ids("byte_bpe_50k.json", text), 0], "<u4").tobytes()
        own = got[got.doc_id.isna() if key is None else got.doc_id == key].drop_duplicates("start")
        assert b"".join(map(bytes, own.sort_values("start").ids)) == expected
    for _, group in got.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group.offset.values == np.concatenate([[0], group.length.cumsum()[:-1]])).all()
        assert group.length.sum() <= 64
    assert sequences(packed).agg(F.sum("length")).first()[0] == got.length.sum()
    assert pack(token_pieces(empty, public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_patterns_use_every_piece_once():
    histogram = {k: (k * 37) % 11 + 1 for k in range(1, 101)}
    patterns = shortest_pack_first(histogram, 100)
    used = dict.fromkeys(histogram, 0)
    for n, pattern in patterns:
        assert sum(length * copies for length, copies in pattern) <= 100
        for length, copies in pattern:
            used[length] += n * copies
    assert used == histogram and len(patterns) <= 300


def test_url_rules(spark):
    urls = ["https://A.Example.NET/en/x?q", "http://net", "http://net/", "x", None, "http://e.org/fr/#a",
            "http://ads.example.com/a", "http://www.example.com/de/1", "http://notnet/"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages).collect()}
    assert got == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        1: ("net", "", None, "allow"), 2: ("net", "/", "net/", "block"),
        3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("e.org", "/fr/", "org/fr/", "allow"), 6: ("ads.example.com", "/a", None, "block"),
        7: ("www.example.com", "/de/1", "example.com/de/", "block"), 8: ("notnet", "/", None, "allow"),
    }
    assert judge_urls(pages.limit(0)).count() == 0


def test_decontamination(spark, docs, empty, monkeypatch):
    items = spark.createDataFrame(
        [(1, " ".join(f"WORD{k}" for k in range(20, 31))), (2, "hello world"), (3, None), (4, "a b")],
        "item_id long, text string",
    )
    from wattspan.llm import decontamination

    for limit in (200_000, 0):
        monkeypatch.setattr(decontamination, "SET_LIMIT", limit)
        found = scan(docs, items).select("doc_id", "n_words", hit_words(F.col("spans")).alias("n"), "items")
        got = {r.doc_id: (r.n_words, r.n, r["items"]) for r in found.collect()}
        assert got[4] == (3000, 11, ["1"]) and got[1] == (8, 2, ["2"]) and got[2] == (0, 0, [])
    assert scan(empty, items).count() == 0


def test_jaccard_join_with_odd_rows(spark, docs, empty):
    words = LONG.split()[:200]
    near = " ".join([*words[:100], "other", *words[101:]])
    more = spark.createDataFrame([(10, " ".join(words)), (9, near), (11, " ".join(words).upper())], "doc_id long, text string")
    rows = jaccard_join(docs.select("doc_id", "text").unionByName(more)).collect()
    got = {r.doc_id: (r.class_id, r.n_links) for r in rows}
    assert got == {1: (1, 0), 2: (2, 0), 3: (3, 0), 4: (4, 1), None: (None, 0), 6: (6, 0),
                   9: (9, 2), 10: (9, 2), 11: (9, 2)}
    assert sum(r.is_first for r in rows if r.doc_id == 4) == 1
    assert jaccard_join(empty).count() == 0
    assert all(m <= 0.8 * n for n, m in needed_matches(0.8, 1e-6, 240, 24))


def test_passages_are_found_and_cut(spark, docs, empty):
    passage = " ".join(f"p{k}" for k in range(60))
    one, two = (f"{' '.join(f'{c}{k}' for k in range(80))}. {passage}. {c} end" for c in "ab")
    table = docs.select("doc_id", "text").where("doc_id <> 4").unionByName(
        spark.createDataFrame([(20, one), (21, two)], "doc_id long, text string")
    ).coalesce(1)
    found = repeated_passages(table)
    spans = {r.doc_id: [tuple(s) for s in r.repeats] for r in found.collect()}
    assert spans[21] == [(80, 140)] and spans[20] == []
    left = {r.doc_id: r.text for r in remove_repeats(table, found).collect()}
    assert words_of(left[21]) == [f"b{k}" for k in range(80)] + ["b", "end"] and left[20] == one
    assert repeated_passages(empty).count() == 0


def test_token_counts_follow_the_tokenizer(spark, docs, empty):
    from tokenizers import Tokenizer, models

    pieces = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    count, exact = UnigramCounter(pieces), Tokenizer(models.Unigram(pieces, 0, True))
    for _, text, _ in TEXTS:
        marked = "\u2581" + text.replace(" ", "\u2581") if text else ""
        assert count(text) == len(exact.encode(marked).ids)
    ties = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("abc", -3.0), ("bc", -2.0), ("c", -1.0)]
    plain = Tokenizer(models.Unigram(ties, 0))
    for text in ("abc", "abcab", "zab", "zzabzc"):
        assert UnigramCounter(ties)._count(text) == len(plain.encode(text).ids)
    assert token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).count() == len(TEXTS)
    assert token_counts(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    for name, table, size in (("a", docs, len(TEXTS)), ("b", empty, 0)):
        folder = str(tmp_path / name)
        got = read_token_files(write_token_files(table, folder, file), folder).orderBy("start").collect()
        assert len(got) == size
        at = 0
        for r, (key, text, _) in zip(got, sorted(TEXTS, key=lambda t: (t[0] is not None, t[0]))):
            expected = np.array([*token_ids("word_bpe_49k.json", text), 1], "<u4").tobytes()
            assert (r.doc_id, r.start, r.n_tokens) == (key, at, len(expected) // 4)
            assert zlib.crc32(r.ids) == zlib.crc32(expected)
            at += r.n_tokens


def test_vector_search_with_odd_rows(spark):
    random = np.random.default_rng(1).normal(size=(60, 8)).round(1).tolist()
    rows = [(k, v) for k, v in enumerate(random)] + [(100, random[0]), (101, None), (102, [0.0] * 8),
            (103, [float("nan")] * 8), (104, [1.0]), (105, random[0])]
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = search(vectors, vectors.where("vec_id % 20 == 0"), k=5, probes=1.0).toPandas()
    kept = {k: np.float32(v).astype(float) for k, v in rows if k not in (101, 102, 103, 104)}
    for query in (0, 20, 40, 100):
        best = sorted((-float(kept[query] @ v), k) for k, v in kept.items() if k != query)[:5]
        own = got[got.query_id == query].sort_values("rank")
        assert own.vec_id.tolist() == [k for _, k in best]
    assert search(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(name, spark, sf_dir, duck):
    result = driver.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    expected = duck.execute(registry.ORACLES[name]).df()[columns].astype(object)
    actual = result.toPandas()[columns].astype(object)
    clean = lambda df: sorted(map(repr, df.where(df.notna(), None).values.tolist()))
    assert clean(actual) == clean(expected)


def test_classifiers_learn_and_score_odd_texts(spark, empty):
    from wattspan.llm import quality, toxicity

    random = np.random.default_rng(2)
    rows, marks = [], []
    for k in range(400):
        words = [f"w{x}" for x in random.integers(0, 500, 40)]
        toxic, good = k % 4 == 0, k % 5 != 0
        if toxic:
            words[7] = "nasty" + words[7]
        text = " ".join(words) if good else " | ".join(words)
        rows.append((k, text, "en"))
        marks.append((k, int(good), int(toxic)))
    table = spark.createDataFrame([*rows, (None, None, None), (9999, "", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks[:300], "doc_id long, quality int, toxic int")
    scored = toxicity.score(table, toxicity.fit(table, labels)).where("doc_id >= 300 AND doc_id < 400").toPandas()
    assert ((scored.toxicity >= 0.5) == (scored.doc_id % 4 == 0)).mean() > 0.9
    graded = table.withColumn("q", quality.quality(F.col("text"), quality.fit(table, labels)))
    own = graded.where("doc_id >= 300 AND doc_id < 400").toPandas()
    good = own.doc_id % 5 != 0
    assert own.q[good].mean() > own.q[~good].mean() + 0.2
    assert toxicity.score(empty.select("doc_id", "text", "lang"), toxicity.fit(table, labels)).count() == 0


def test_the_pipeline_keeps_its_contract(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.select("doc_id").distinct().join(docs, "doc_id", "left_anti").count() == 0
    for name, step in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[3:4]:
        assert step(spark, docs, sf_dir).columns == docs.columns, name


def test_hashed_words_are_those_of_the_words():
    from wattspan.llm import common

    long_word, rest = "x" * 70_000, " ".join(f"Wörd{k} {k}" for k in range(20_000))
    for text in [t for _, t, _ in TEXTS] + [f"{rest} {long_word} {long_word}y {rest}", "a", " a ", "ÀÉ a-B_c"]:
        words, hashes = words_of(text), common.hashed_words(text)
        assert len(words) == len(hashes)
        assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist())))


def test_spans_of_repetitive_texts_equal_all_shifts():
    from wattspan.llm.substring_dedup import matching_spans

    random = np.random.default_rng(3)
    for _ in range(30):
        line = random.integers(0, 40, 15)
        own, other = (np.concatenate([np.tile(line, random.integers(1, 9)), random.integers(0, 40, 90)]) for _ in "ab")
        places, width, needed = np.arange(0, len(own), 7), 20, 18
        mine, theirs = np.zeros(len(own), bool), np.zeros(len(other), bool)
        shifts = {int(q - p) for p in places for q in np.flatnonzero(other == own[p])}
        for shift in shifts:
            same = [k for k in range(len(own)) if 0 <= k + shift < len(other) and own[k] == other[k + shift]]
            for low in range(max(0, -shift), min(len(own), len(other) - shift) - width + 1):
                held = [k for k in same if low <= k < low + width]
                if len(held) >= needed:
                    mine[held[0] : held[-1] + 1] = True
                    theirs[held[0] + shift : held[-1] + 1 + shift] = True
        got = matching_spans(own, other, places, width, 0.8)
        assert (got[0][mine]).all() and (got[1][theirs]).all()


def test_copies_are_whole_repeats(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    other = f"{passage} and then some more"
    table = spark.createDataFrame(
        [(1, passage), (2, passage), (3, other), (4, other), (5, passage), (5, passage), (6, "short"), (7, "short")],
        "doc_id long, text string",
    ).coalesce(1)
    found = repeated_passages(table)
    got = sorted((r.doc_id, [tuple(s) for s in r.repeats], len(r.originals) > 0) for r in found.collect())
    assert got == [(1, [], True), (2, [(0, 60)], False), (3, [(0, 60)], True), (4, [(0, 64)], False),
                   (5, [(0, 60)], False), (5, [(0, 60)], False), (6, [], False), (7, [], False)]
    assert sorted(r.doc_id for r in remove_repeats(table, found).collect()) == [1, 3, 6, 7]
    twice = spark.createDataFrame([(1, passage), (1, passage)], "doc_id long, text string").coalesce(1)
    assert remove_repeats(twice, repeated_passages(twice)).count() == 1


def test_edited_passages_become_candidates():
    from wattspan.llm.substring_dedup import LENGTH, SHINGLE, passage_keys

    random, width, runs = np.random.default_rng(5), LENGTH - SHINGLE + 1, 300
    # Words of a passage and words replaced in it: its windows have a similarity of 0.8 or more.
    for size, edits, least in ((51, 1, 0.9), (60, 1, 0.95), (80, 2, 0.97), (100, 3, 0.98)):
        found = 0
        for _ in range(runs):
            one, two = (random.integers(0, 2**63, 300) for _ in "ab")
            two[120 : 120 + size] = one[100 : 100 + size]
            two[120 + (np.arange(1, edits + 1) * size) // (edits + 1)] = random.integers(0, 2**63, edits)
            keys = [passage_keys(shingle_hashes(x.astype(np.uint64), SHINGLE), width)[0] for x in (one, two)]
            found += len(np.intersect1d(*keys)) > 0
        assert found >= least * runs, (size, found / runs)


def test_spans_are_those_of_all_windows_with_similar_sets():
    from wattspan.llm.substring_dedup import matching_spans

    random = np.random.default_rng(0)

    def edited(base):
        words = base.tolist()
        for _ in range(random.integers(0, 4)):
            at, kind = random.integers(0, len(words)), random.integers(0, 4)
            if kind == 0:
                words.insert(at, int(random.integers(0, 10**9)))
            elif kind == 1:
                del words[at]
            elif kind == 2:
                words[at] = int(random.integers(0, 10**9))
            else:
                words = words[at:] + words[:at]
        return np.concatenate([random.integers(0, 10**9, random.integers(0, 40)), words, random.integers(0, 10**9, 9)]).astype(int)

    pairs = []
    for _ in range(60):
        base = random.integers(0, 10**9, random.integers(20, 60))
        pairs += [(edited(base), edited(base)), tuple(random.integers(0, random.integers(2, 25), 60) for _ in "ab")]
    for own, other in pairs:
        mine, theirs, width = np.zeros(len(own), bool), np.zeros(len(other), bool), 20
        sets = [[set(x[k : k + width].tolist()) for k in range(len(x) - width + 1)] for x in (own, other)]
        for i, one in enumerate(sets[0]):
            for j, two in enumerate(sets[1]):
                if 10 * len(one & two) >= 8 * len(one | two):
                    for marks, x, at, held in ((mine, own, i, two), (theirs, other, j, one)):
                        inside = [k for k in range(at, at + width) if x[k] in held]
                        marks[inside[0] : inside[-1] + 1] = True
        got = matching_spans(own, other, np.arange(0, len(own), 7), width, 0.8)
        assert np.array_equal(got[0], mine) and np.array_equal(got[1], theirs)
    # A passage with one word inserted in its middle, in 5-grams.
    for size in (60, 80, 88):
        words = random.integers(0, 2**63, size).astype(np.uint64)
        longer = np.insert(words, size // 2, np.uint64(1))
        x, y = (shingle_hashes(w, 5) for w in (words, longer))
        assert all(m.any() for m in matching_spans(x, y, np.arange(len(x)), 46, 0.8)), size


def test_rows_between_unlike_ends_of_a_key_are_compared(spark, monkeypatch):
    from wattspan.llm import substring_dedup

    # A line of 20 words that all texts quote, in passages of which only some are alike.
    line = [f"q{k}" for k in range(20)]

    def text(k, near):
        own = [f"{near}x{i}" for i in range(40)]
        return " ".join([*(f"a{k}w{i}" for i in range(60)), *own[:20], *line, *own[20:], *(f"z{k}w{i}" for i in range(60))])

    kinds = ["first", "b", "c", "d", "e", "b", "c", "d", "e", "last"]
    table = spark.createDataFrame([(k, text(k, x)) for k, x in enumerate(kinds)], "doc_id long, text string").coalesce(1)
    # One key that all have, so that nothing but it brings rows together.
    one_key = {"keys": F.array(F.lit(1).cast("long")), "places": F.array(F.lit(85))}
    real = substring_dedup._passages
    monkeypatch.setattr(substring_dedup, "_passages", lambda *x: real(*x).withColumns(one_key))
    got = {r.doc_id: (len(r.repeats), len(r.originals)) for r in repeated_passages(table).collect()}
    assert got == {k: (int(5 <= k <= 8), int(1 <= k <= 4)) for k in range(10)}


def test_thresholds_follow_all_labelled_documents(spark, monkeypatch):
    from wattspan.llm import toxicity

    random = np.random.default_rng(4)
    rows, marks = [], []
    for k in range(900):
        words = [f"w{x}" for x in random.integers(0, 200, 20)]
        if k % 4 == 0:
            words[3] = "nasty" + words[3]
        rows.append((k, " ".join(words), "en" if k % 10 else "xx"))
        marks.append((k, int(k % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    seen, histogram = [], toxicity.histogram
    monkeypatch.setattr(toxicity, "histogram", lambda *x: seen.append((histogram(*x), x[2])) or seen[0][0])
    fitted = toxicity.fit(table, labels, sample=200)
    folds = toxicity.training_labels(labels, "toxic").count()
    # A rare language has its own, and all examples that were not trained on take part.
    assert set(fitted.thresholds) == {"en", "xx"}
    assert len(seen[0][1]) == 160 and seen[0][0].n.sum() == folds - 160

"""Spelling variants and phrases against brute force."""

import gc
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from wattspan.llm import phrases
from wattspan.llm.common import let_go
from wattspan.llm.phrases import collocations, frequent_phrases, op12_phrases
from wattspan.llm.spelling import op11_spelling, spelling_variants

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id LONG, text STRING, lang STRING, word STRING, n INT, h INT, id STRING, phrase STRING, size INT"


def frame(spark, docs):
    rows = [(*d, "x", 1, 2, "y", "z", 3) for d in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# --- spelling ---------------------------------------------------------------


def variants(word, letters):
    cuts = range(len(word) + 1)
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}
    out |= {word[:k] + c + word[k:] for k in cuts for c in letters}
    return out - {word}


def brute_spelling(docs):
    counts = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    letters = set("".join(words))
    out, form_of = [], {}
    near_of = {w: [v for v in variants(w, letters) if v in words] for w in words}
    for word, near in near_of.items():
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form_of[word] = best if best and words[best] >= 2 * words[word] else None
    for word, n in words.items():
        root = word
        while form_of[root]:
            root = form_of[root]
        form = form_of[word]
        out.append((word, form, root, n, len(near_of[word]), words[form] if form else None))
    return sorted(out, key=repr)


def spelled(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def word_docs(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    words = [*base, "aaaaa", "aaaaaa", "aaaaaaa", "x" * 3000, "x" * 3001]
    for _ in range(200):
        word = list(rng.choice(words[:40]))
        for _ in range(rng.randint(1, 2)):
            k = rng.randrange(len(word))
            word[k : k + rng.randint(0, 1)] = rng.choice(["", rng.choice("abcdéf")])
        words.append("".join(word) or "a")
    weights = [rng.choice([1, 1, 3, 20]) for _ in words]
    docs = [
        (rng.choice([k, None]), " ".join(rng.choices(words, weights, k=200)).upper(), "en") for k in range(40)
    ]
    return docs + docs[:2] + [(1, None, None), (2, "", "en"), (3, "... 12 ###", "de")]


@pytest.mark.parametrize("options", [{}, {"symbols": 1, "split_from": 2}, {"symbols": 8}])
def test_spelling_equals_brute_force(spark, options):
    docs = word_docs(5)
    expected = brute_spelling(docs)
    assert spelled(spelling_variants(frame(spark, docs), **options)) == expected
    assert sum(row[1] is not None for row in expected) > 20
    assert any(row[1] and row[2] != row[1] for row in expected)  # a chain of forms


def test_spelling_of_no_rows(spark):
    assert spelled(spelling_variants(frame(spark, []))) == []


def test_spelling_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = op11_spelling(spark, sf_dir)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelled(result) == brute_spelling(docs)


# --- phrases ----------------------------------------------------------------


def brute_phrases(docs, least, top):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    longest[p[k : k + size]] = max(longest[p[k : k + size]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * longest[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def ranked(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def phrase_docs(seed):
    rng = random.Random(seed)
    words = ["a", "b", "É", "dd", "x|y", "w" * 70_000]
    gaps = [" ", " ", " ", "\t", "  ", ". ", "\n", ",", " "]
    weights = [9, 7, 5, 3, 2, 0.02]
    docs = []
    for k in range(60):
        some = rng.choices(words, weights, k=rng.randint(1, 60))
        docs.append((k, "".join(w + rng.choice(gaps) for w in some), rng.choice(["en", "fr", None])))
    return docs + docs[:3] + [(1, None, "en"), (2, "", None), (3, " \t..", "de")]


@pytest.mark.parametrize("one_in", [1, 3, 1_000_000_007])
@pytest.mark.parametrize("top", [7, 5000])
def test_phrases_equal_brute_force_whatever_the_sample(spark, one_in, top):
    docs = phrase_docs(2)
    expected = brute_phrases(docs, 5, top)
    assert ranked(collocations(frame(spark, docs), 5, top, one_in)) == expected
    assert top == 7 or len({row[2].count(" ") for row in expected}) > 1


def test_scores_past_64_bits_are_exact(spark):
    found = spark.range(1).selectExpr(
        "(cast(9000000000000000000 AS decimal(30,0)) * 2000000BD) div (cast(9000000000000000000 AS decimal(30,0)) + 9) AS s"
    )
    assert found.first()[0] == 2_000_000 * 9 * 10**18 // (9 * 10**18 + 9)


def test_phrases_of_no_rows(spark):
    assert ranked(collocations(frame(spark, []))) == []
    assert frequent_phrases(frame(spark, [(1, None, None)])).count() == 0


def test_phrase_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert ranked(op12_phrases(spark, sf_dir)) == brute_phrases(docs, 30, 2000)


def test_ranks_across_tasks_equal_a_sort(spark):
    from wattspan.llm import phrases

    rows = [("en" if k % 9 else "fr", f"p{k:03}", k % 7, k % 5) for k in range(400)]
    table = spark.createDataFrame(rows, "lang string, phrase string, score long, a long").repartition(5)
    got = {(r["lang"], r["rank"]): r["phrase"] for r in phrases.ranked(table, 120).collect()}
    expected = {}
    for lang in ("en", "fr"):
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], -r[3], r[1]))
        expected.update({(lang, n + 1): r[1] for n, r in enumerate(own[:120])})
    assert got == expected


def test_phrases_of_a_task_are_counted_in_one_row_for_each_part(spark):
    texts = [(k, "a b c d e f g h " * 20, "en") for k in range(60)]
    units = frame(spark, texts).selectExpr("lang", "cast(text AS binary) AS raw")
    every = phrases.PhraseMap(spark, np.full(1 << (phrases.MAP_BITS - 3), 255, np.uint8))
    packed = phrases.border_counts(units, every, every).collect()
    assert len(packed) == 3 * len({r["part"] for r in packed})
    assert sum(sum(r["n"]) for r in packed) == 60 * (160 + 159 + 158 + 157)


def test_shuffles_of_collected_frames_are_let_go(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = blocks.getAllFiles().mkString("\n").split("\n")
        return {name for name in names if "shuffle_" in name and name.endswith(".data")}

    gc.disable()
    try:
        before = files()
        assert spark.range(100).repartition(3).groupBy("id").count().collect()
        assert files() - before
        for _ in range(20):
            let_go(spark)
        assert not files() - before
    finally:
        gc.enable()

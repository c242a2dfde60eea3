"""What keeps the memory, disk and time of the text operators within bounds."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wattspan.llm import common, phrases, substring_dedup
from wattspan.llm.common import hashed_texts, hashed_words, shingle_hashes


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    rows = [(k, f"w{k} " * 60) for k in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sizes, real = [], substring_dedup.stage

    def stage(df, label):
        if label == "passage-keys":
            counted = docs.mapInArrow(lambda batches: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
            sizes.extend(r["n"] for r in counted.collect())
        return real(df, label)

    monkeypatch.setattr(substring_dedup, "stage", stage)
    assert substring_dedup.repeated_passages(docs).count() == 2500
    assert sum(sizes) == 2500 and max(sizes) <= 1000
    assert all(spark.conf.get(k) != v for k, v in common.SMALL_BATCHES.items())


def test_parts_of_a_language_span_batches(monkeypatch):
    monkeypatch.setattr(phrases, "TAKEN_BYTES", 100)
    rows = [(("en", "fr", "xx")[k % 3], b"x" * 20) for k in range(99)]
    batches = [
        pa.record_batch([pa.array([r[0] for r in rows[k : k + 2]]), pa.array([r[1] for r in rows[k : k + 2]])], ["lang", "raw"])
        for k in range(0, 99, 2)
    ]
    parts = [(lang, len(b"".join(texts))) for lang, texts in phrases._taken(iter(batches))]
    assert all(sum(n for lang, n in parts if lang == own) == 33 * 20 for own in ("en", "fr", "xx"))
    assert len(parts) <= 30 and max(n for _, n in parts) <= 100


def test_texts_that_are_not_asked_for_are_left_out(spark):
    df = spark.range(2000).select("id", F.md5(F.col("id").cast("string").cast("binary")).alias("digest"))
    asked = df.where("id % 10 = 0").union(df.where("id = 10"))
    found = substring_dedup.may_be_in(df, asked, "digest")
    assert asked.join(found, "digest", "left_anti").count() == 0
    assert found.count() == found.distinct().count() <= 210
    assert substring_dedup.may_be_in(df, df.limit(0), "digest").count() == 0


def test_keys_of_texts_are_those_of_each_text():
    random = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in random.integers(0, 9, n)) for n in (0, 49, 50, 51, 400, 3, 120)]
    texts = [None, *texts, "Ünï " * 70, "x" * 70_000 + " y" * 60]
    words, counts = hashed_texts(texts)
    assert np.array_equal(words, np.concatenate([hashed_words(t) for t in texts]))
    counts, grams, sizes, keys, heads, places = substring_dedup.keys_of_texts(texts, 5, 50)
    ends, lists = np.cumsum(sizes), np.split(places, heads[1:])
    for k, text in enumerate(texts):
        own = hashed_words(text)
        assert counts[k] == len(own)
        if len(own) < 50:
            assert sizes[k] == 0 and grams[k] == b""
            continue
        shingles = shingle_hashes(own, 5)
        key, head, place = substring_dedup.places_by_key(*substring_dedup.passage_keys(shingles, 46))
        some = slice(ends[k] - sizes[k], ends[k])
        assert np.array_equal(keys[some], key)
        assert [x.tolist() for x in lists[some]] == [x.tolist() for x in np.split(place, head[1:])]
        assert np.array_equal(np.frombuffer(grams[k], np.uint16), shingles % np.uint64(substring_dedup.SKETCH_BITS))


def test_repeated_lines_are_marked_in_few_shifts(monkeypatch):
    # A line that both texts repeat, with some words replaced, has very many shifts at which windows are similar.
    def text(lines, seed):
        random = np.random.default_rng(seed)
        found = np.tile(np.arange(1, 51, dtype=np.uint64), lines)
        random.integers(0, 1, lines)
        other = random.random(len(found)) < 0.07
        found[other] = random.integers(10**6, 10**9, other.sum()).astype(np.uint64)
        return found

    calls, real = [], np.bincount
    monkeypatch.setattr(substring_dedup.np, "bincount", lambda *x, **y: calls.append(1) or real(*x, **y))
    mine, theirs = substring_dedup.matching_spans(text(12, 1), text(150, 2), None, 46, 0.8)
    assert (mine.sum(), theirs.sum()) == (594, 7480)
    assert len(calls) < 3000

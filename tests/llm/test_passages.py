"""Repeated passages end to end: a hot passage, edits, copies, odd tables and names."""

import numpy as np
from pyspark.sql import functions as F

from wattspan.llm import substring_dedup
from wattspan.llm.common import hashed_words, shingle_hashes
from wattspan.llm.substring_dedup import LENGTH, SHINGLE, remove_repeats, repeated_passages

SCHEMA = "doc_id long, text string"


def similar_windows(one: str, two: str) -> tuple[set[int], set[int]]:
    """Shingles in windows of similarity 0.8 or more, by all pairs of windows."""
    width, marks = LENGTH - SHINGLE + 1, (set(), set())
    a, b = (shingle_hashes(hashed_words(t), SHINGLE).tolist() for t in (one, two))
    for i in range(len(a) - width + 1):
        x = set(a[i : i + width])
        for j in range(len(b) - width + 1):
            y = set(b[j : j + width])
            if len(x & y) >= 0.8 * len(x | y) - 1e-9:
                marks[0].update(k for k in range(i, i + width) if a[k] in y)
                marks[1].update(k for k in range(j, j + width) if b[k] in x)
    return marks


def test_a_passage_that_all_rows_quote_equals_all_pairs_of_windows(spark):
    random = np.random.default_rng(8)
    hot = [f"h{k}" for k in range(70)]
    texts = []
    for n in range(24):
        quoted = list(hot)
        if n % 3 == 1:
            quoted[35] = f"changed{n}"
        if n % 3 == 2:
            quoted = hot[:10] + hot[n % 5 + 8 :]
        head, tail = ([f"d{n}x{k}" for k in range(random.integers(3, 25))] for _ in "ab")
        texts.append(" ".join(head + quoted + tail))
    texts += [" ".join(f"lone{n}x{k}" for k in range(90)) for n in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartitionByRange(6, "doc_id").sortWithinPartitions("doc_id")
    found = {r["doc_id"]: r for r in repeated_passages(docs).collect()}
    covered = hit = 0
    for n, text in enumerate(texts):
        expected = set()
        for earlier in range(n):
            expected |= similar_windows(texts[earlier], text)[1]
        got = {k for s in found[n]["repeats"] for k in range(s["start"], s["end"] - SHINGLE + 1)}
        # Runs between shared shingles are marked too, so what is marked may be more, within the run.
        if expected:
            assert got and min(got) >= min(expected) and max(got) <= max(expected), n
        else:
            assert not got, n
        covered += len(expected)
        hit += len(expected & got)
    assert hit >= 0.95 * covered > 0
    left = {r["doc_id"]: r["text"] for r in remove_repeats(docs, repeated_passages(docs)).collect()}
    assert left[0] == texts[0] and all(left[n] == texts[n] for n in range(24, 28))
    assert all("h50" not in left[n].split() for n in range(1, 24))


def test_rows_of_a_key_are_numbered_across_partitions(spark):
    random = np.random.default_rng(2)
    rows = [(int(k), int((p << 33) + i), [i]) for p in range(5) for i in range(40) for k in np.unique(random.integers(0, 6, 3))]
    rows += [(99, 7, [1])]
    got = substring_dedup.numbered(spark.createDataFrame(rows, "key long, row long, places array<int>")).collect()
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted(r[1] for r in rows if r[0] == key)
        assert {(r["row"], r["nth"], r["n"]) for r in got if r["key"] == key} == {(row, k + 1, len(own)) for k, row in enumerate(own)}


def test_places_by_key_are_distinct():
    keys, heads, places = substring_dedup.places_by_key(np.array([5, -3, 5, 5, -3]), np.array([2, 0, 2, 1, 9]))
    assert keys.tolist() == [-3, 5]
    assert [p.tolist() for p in np.split(places, heads[1:])] == [[0, 9], [1, 2]]


def test_clashing_names_copies_and_odd_rows(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, passage, 1), (1, passage, 2), (None, passage, 3), (None, passage, 4), (2, f"own words {passage} at the end", 5)]
    rows += [(None, None, 6), (None, None, 7), (3, "", 8), (3, "", 9), (4, "short", 10), (4, "short", 11), (5, "...", 12)]
    docs = spark.createDataFrame(rows, f"{SCHEMA}, n int").coalesce(1)
    odd = ["repeats", "originals", "digest", "row", "key", "span_id", "span_none", "span_digest", "copies", "cut_text", "n_words", "grams"]
    docs = docs.select("*", *[F.col("n").alias(name) for name in odd])
    passages = repeated_passages(docs)
    assert passages.count() == 12
    kept = remove_repeats(docs, passages)
    assert kept.columns == docs.columns
    left = {r["n"]: r for r in kept.collect()}
    assert sorted(n for n in left if n > 4) == list(range(5, 13))
    assert len([n for n in left if n <= 2]) == 1 and not [n for n in left if n in (3, 4)]
    assert left[5]["text"] == "own words at the end"
    assert all(r[name] == n for n, r in left.items() for name in odd)
    empty = docs.where("false")
    assert remove_repeats(empty, repeated_passages(empty)).count() == 0

"""Run-length index and removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from wattspan.llm.run_length_index import RunLengthIndex
from wattspan.llm.suffix_dedup import op13_suffix_dedup, repeated_strings

SCHEMA = "doc_id LONG, text STRING, raw STRING, spans STRING, doc STRING, found INT"


def joined(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return raw, np.array([len(t) for t in texts])


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_every_match_and_its_first_owner(seed):
    rng = random.Random(seed)
    length, letters = rng.choice([8, 10, 50]), rng.choice(["ab", "abc", "abcdefghij"])
    sizes = [rng.randint(length, 2 * length - length // 2) for _ in range(5)]
    base = ["".join(rng.choice(letters) for _ in range(n)) for n in sizes]

    def edited():
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(letters + "z")
        return "".join(text)

    known, patterns = [edited() for _ in range(rng.randint(1, 30))], [edited() for _ in range(20)]
    owners = np.array([rng.randint(0, 9) for _ in known])
    index = RunLengthIndex(*joined(known), owners, length)
    pattern, place, at = index.matches(*joined(patterns))
    found = dict(zip(zip(pattern.tolist(), place.tolist()), index.first_owner(at).tolist()))
    expected = {}
    for i, text in enumerate(patterns):
        for k in range(len(text) - length + 1):
            having = [owners[j] for j, t in enumerate(known) if text[k : k + length] in t]
            if having:
                expected[i, k] = int(min(having))
    assert found == expected
    assert index.runs <= len(index.order)


def brute(docs, length):
    """Spans by the first document of every string of ``length`` bytes."""
    top = float("inf")
    raws = [(top if d is None else d, (t or "").encode()) for d, t in docs]
    first = {}
    for doc, raw in raws:
        for k in range(len(raw) - length + 1):
            string = raw[k : k + length]
            first[string] = min(first.get(string, top), doc)
    out = []
    for (doc_id, _), (doc, raw) in zip(docs, raws):
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < doc:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), spans, kept))
    return sorted(out, key=repr)


def found_rows(spark, docs, length, **options):
    rows = [(d, t, "x", "y", "z", 1) for d, t in docs]
    result = repeated_strings(spark.createDataFrame(rows, SCHEMA).repartition(3), length, **options)
    return sorted(((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in result.collect()), key=repr)


def corpus(seed, count=60):
    rng = random.Random(seed)
    letters = "abé"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 60))) for _ in range(8)]
    docs = []
    for k in range(count):
        parts = [rng.choice(passages) if rng.random() < 0.5 else str(rng.random()) for _ in range(6)]
        docs.append((rng.choice([k, k, k % 7, None]), "".join(parts)))
    return docs + docs[:5] + [(900, None), (901, ""), (902, "short"), (903, "a" * 500), (904, "a" * 300)]


@pytest.mark.parametrize("options", [{}, {"split_from": 2}, {"chunk": 400}])
@pytest.mark.parametrize("length", [12, 50])
def test_equal_to_brute_force(spark, length, options):
    docs = corpus(length)
    assert found_rows(spark, docs, length, **options) == brute(docs, length)


def test_text_longer_than_a_block(spark, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(600_000))
    docs = [(1, long[299_000:301_000]), (2, long), (3, "x" + long[260_000:520_000])]
    assert found_rows(spark, docs, 50) == brute(docs, 50)


def test_no_rows(spark):
    assert found_rows(spark, [], 50) == []
    assert found_rows(spark, [(None, None), (None, None)], 50) == [(None, 0, 0, b"")] * 2


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = [
        (d, n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())
        for d, n, spans, kept in brute(docs, 50)
    ]
    result = op13_suffix_dedup(spark, sf_dir)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result.columns == names
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(row[2] for row in expected) > 0

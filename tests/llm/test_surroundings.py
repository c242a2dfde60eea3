"""Shingles around the places of a key turn away no similar windows, and most others."""

import numpy as np
import pytest

from wattspan.llm import substring_dedup
from wattspan.llm.substring_dedup import FOLDED_BITS, SKETCH_BITS, around, may_hold, most_lost, repeated_passages, sketch


def near(grams, place, width):
    ends = np.array([0, len(grams)])
    found = around(grams, np.array([place]), ends[:1], ends[1:], width)
    return found, most_lost(grams, ends, width)[[place]]


@pytest.mark.parametrize("seed", range(40))
def test_no_similar_windows_around_places_are_turned_away(seed):
    random = np.random.default_rng(seed)
    width, threshold = int(random.choice([6, 20, 46])), 0.8
    kinds, needed, tried = int(random.choice([15, 200, 10**9])), 2 * width * 0.8 / 1.8 - 1e-6, 0
    for _ in range(40):
        sizes = random.integers(width, 4 * width, 2)
        own, other = (random.integers(0, kinds, n).astype(np.uint64) for n in sizes)
        start, there = (random.integers(0, n - width + 1) for n in sizes)
        piece = own[start : start + width].copy()
        for _ in range(random.integers(0, width // 5 + 1)):
            piece[random.integers(0, width)] = random.integers(0, kinds)
        other[there : there + width] = piece
        a, b = set(own[start : start + width].tolist()), set(piece.tolist())
        if len(a & b) < threshold * len(a | b):
            continue
        p, q = start + random.integers(0, width), there + random.integers(0, width)
        (x, x_lost), (y, y_lost) = (near((g % SKETCH_BITS).astype(np.uint16), k, width) for g, k in ((own, p), (other, q)))
        assert may_hold(x, y, width, needed, x_lost, y_lost)[0]
        tried += 1
    assert tried


def test_windows_that_differ_are_turned_away():
    random, width = np.random.default_rng(1), 46
    needed = 2 * width * 0.8 / 1.8 - 1e-6

    def judged(own, other):
        (x, x_lost), (y, y_lost) = (near(g.astype(np.uint16), 100, width) for g in (own, other))
        return may_hold(x, y, width, needed, x_lost, y_lost)[0]

    own = random.integers(0, SKETCH_BITS, 200)
    other = own.copy()
    other[::4] = random.integers(0, SKETCH_BITS, 50)
    assert judged(own, own) and not judged(own, other)
    # Lines that both texts repeat but do not share.
    line, another = (np.tile(random.choice(SKETCH_BITS, 10, replace=False), 20) for _ in "ab")
    assert judged(line, line) and not judged(line, another)
    # A sketch of a line that is repeated promises no more than a window of it lacks.
    bits, lost = sketch((line % FOLDED_BITS).astype(np.uint16), [100], width)
    assert lost == width - sum(bin(int(v)).count("1") for v in bits.view(np.uint64))


def test_most_lost_is_that_of_all_windows_of_a_place():
    random, sizes = np.random.default_rng(2), [0, 8, 30, 3, 50]
    ends = np.cumsum([0, *sizes])
    for kinds in (4, 60):
        grams = random.integers(0, kinds, ends[-1]).astype(np.uint16)
        got = most_lost(grams, ends, 8)
        for low, high in zip(ends, ends[1:]):
            for place in range(low, high):
                found = [8 - len(set(grams[s : s + 8])) for s in range(max(low, place - 7), min(place, high - 8) + 1)]
                assert not found or got[place] == max(found)


def test_texts_of_rows_that_share_less_than_a_passage_are_not_compared(spark, monkeypatch):
    # A line that all quote in text of their own is no passage: not all rows are compared with all.
    line = " ".join(f"q{k}" for k in range(40))
    rows = [(n, " ".join([f"a{n}x{k}" for k in range(60)] + [line] + [f"z{n}x{k}" for k in range(60)])) for n in range(12)]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(n, f"own{n} words {passage} at the end of {n}") for n in (12, 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    asked, real = [], substring_dedup._verify
    monkeypatch.setattr(substring_dedup, "_verify", lambda pairs, *x: asked.append(pairs.count()) or real(pairs, *x))
    got = {r.doc_id: (len(r.repeats), len(r.originals)) for r in repeated_passages(docs).collect()}
    assert got == {n: (int(n == 13), int(n == 12)) for n in range(14)}
    assert sum(asked) < 12 * 11 // 4

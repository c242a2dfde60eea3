"""Sketches turn away no pair of windows that is similar enough."""

import numpy as np
import pytest

from wattspan.llm.substring_dedup import SKETCH_BITS, sketch


@pytest.mark.parametrize("seed", range(60))
def test_no_similar_pair_is_turned_away(seed):
    random = np.random.default_rng(seed)
    width, threshold = int(random.choice([6, 20, 46])), 0.8
    kinds = int(random.choice([15, 200, 10**9]))
    for _ in range(40):
        own, other = (random.integers(0, kinds, 4 * width).astype(np.uint64) for _ in "ab")
        start, there = random.integers(0, 3 * width, 2)
        piece = own[start : start + width].copy()
        for _ in range(random.integers(0, width // 5 + 1)):
            piece[random.integers(0, width)] = random.integers(0, kinds)
        other[there : there + width] = piece
        a, b = set(own[start : start + width].tolist()), set(other[there : there + width].tolist())
        if len(a & b) < threshold * len(a | b):
            continue
        places = start + random.integers(0, width, random.integers(1, 3)), there + random.integers(0, width, 1)
        (x, x_lost), (y, y_lost) = (
            sketch((g % SKETCH_BITS).astype(np.uint16), list(p), width) for g, p in zip((own, other), places)
        )
        common = sum(bin(int(v)).count("1") for v in (x & y).view(np.uint64))
        assert common >= 2 * width * threshold / (1 + threshold) - 0.5 * (x_lost + y_lost) - 1e-6

"""Near-duplicate passages across documents by compact windows.

Over a text's word n-grams, a Cartesian tree of a hash function's values splits all
subsequences into groups with the same least value: the node at ``c`` of the range
``[l, r)`` holds those within the range that contain ``c``. Intersecting the intervals of
two trees gives the passages of the least length that share two min-hashes, and these pairs
of values are joined across documents. Candidates are verified on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wattspan.llm.common import (
    ASCII_LOWER,
    BYTES_AT_ONCE,
    SMALL_BATCHES,
    WORDS,
    digest,
    free_name,
    hashed_texts,
    hashed_words,
    mix64,
    shingle_hashes,
    stage,
    table,
)
from wattspan.session import session_conf

SHINGLE = 5
LENGTH = 50
THRESHOLD = 0.8
# Hash functions are used in pairs; one pair that agrees on a window makes a candidate. Equal
# windows always do, windows of similarity s with a chance of 1 - (1 - s^2)^PAIRS (0.95 at
# 0.8), each time one slides on.
PAIRS = 3
# Shingles around a key are known by so many bits. A sketch of the key's surroundings folds
# them into fewer, kept in numbers of 64.
SKETCH_BITS, FOLDED_BITS = 4096, 512
SKETCH = [f"s{k}" for k in range(FOLDED_BITS // 64)]
AROUND = ["lost", "around", "few_lost"]
# The verification looks for dense places in a pair of texts by at most so many cells.
CELLS_AT_ONCE = 4_000_000
# A task of the verification keeps the n-grams of the texts met most recently, up to so many.
RECENT_SHINGLES = 2_000_000
# Sketches are made of so many places at once.
HITS_AT_ONCE = 4_000
# A block of the verification has about this many pairs, whose texts have about so many words.
PAIRS_AT_ONCE, WORDS_AT_ONCE = 2_000, 8_000_000
# Rows are numbered by partition of the input; so many bits are the number within it.
ROW_BITS = 33
# Few bytes of texts take long to compare, so tasks are not merged by their bytes there.
ALL_TASKS = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
# The shingles around a key's places are kept where these are so many at most.
PLACES = 8
# From so many rows of a key on, the rows that one is compared with grow faster in number.
FEW = 43
# Bits of the map of the texts that are asked for.
MAP_BITS = 25


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first least value of every window of ``width`` values."""
    least, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        later = least[step:] < least[:-step]
        at = np.where(later, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    return at


def window_keys(
    shingles: np.ndarray, width: int, starts: np.ndarray, texts: np.ndarray, pairs: int = PAIRS
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each pair of hashes: keys of the windows at ``starts``, a place in each, and their ``texts``.

    Of windows in a row that share both least values, the first stands for all.
    """
    for pair in range(pairs):
        a, b = (
            window_minima(mix64(shingles ^ np.uint64(0x9E3779B97F4A7C15 * (2 * pair + half + 1) % 2**64)), width)[starts]
            for half in range(2)
        )
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[fresh], b[fresh]
        key = mix64(shingles[a] * np.uint64(0xC2B2AE3D27D4EB4F) + shingles[b] + np.uint64(pair))
        yield key.astype(np.int64), a, texts[fresh]


def passage_keys(shingles: np.ndarray, width: int, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the groups of ``width`` shingles and the place of a shingle in each."""
    starts = np.arange(len(shingles) - width + 1)
    found = list(window_keys(shingles, width, starts, np.zeros(len(starts), int), pairs))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def places_by_key(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, where the places of each start, and its distinct places."""
    return places_of_texts(keys, places, np.zeros(len(keys), int))[:3]


def places_of_texts(
    keys: np.ndarray, places: np.ndarray, texts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`places_by_key` of each text in turn, with the number of each key's text."""
    order = np.lexsort((places, keys, texts))
    keys, places, texts = keys[order], places[order], texts[order]
    new_key = np.ones(len(keys), bool)
    new_key[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
    kept = new_key | (np.diff(places, prepend=-1) != 0)
    keys, places, texts = keys[kept], places[kept], texts[kept]
    heads = np.flatnonzero(new_key[kept])
    return keys[heads], heads, places, texts[heads]


def keys_of_texts(texts: list[str | None], shingle: int, length: int) -> tuple:
    """What :func:`_passages` lists of some texts, all at once.

    These are the numbers of words, the shingles modulo the bits of a sketch, the number of
    keys of each text, and the lists of :func:`places_by_key`.
    """
    words, counts = hashed_texts(texts)
    begins, windows = np.cumsum(counts) - counts, np.maximum(counts - length + 1, 0)
    # Windows that reach over the end of a text are passed over.
    shingles, of = shingle_hashes(words, shingle), np.repeat(np.arange(len(texts)), windows)
    bits = (shingles % np.uint64(SKETCH_BITS)).astype(np.uint16)
    grams = [
        bits[b : b + n - shingle + 1].tobytes() if n >= length else b"" for b, n in zip(begins.tolist(), counts.tolist())
    ]
    if not len(of):
        return counts, grams, np.zeros(len(texts), int), *places_by_key(np.zeros(0, np.int64), np.zeros(0, np.int32))
    starts = np.arange(len(of)) + np.repeat(begins - np.cumsum(windows) + windows, windows)
    found = list(window_keys(shingles, length - shingle + 1, starts, of))
    key, at, text = (np.concatenate([f[k] for f in found]) for k in range(3))
    key, head, place, text = places_of_texts(key, (at - begins[text]).astype(np.int32), text)
    return counts, grams, np.bincount(text, minlength=len(texts)), key, head, place


def _passages(docs: DataFrame, shingle: int, length: int) -> DataFrame:
    listed, lists = pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32()))

    def find(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            # Columns of blocks of texts, which are bounded so that their numbers stay in the CPU's cache.
            size = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            load = np.cumsum(size) // BYTES_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(load)) + 1).tolist(), batch.num_rows]
            parts = [keys_of_texts(batch.column(2)[a:b].to_pylist(), shingle, length) for a, b in zip(cuts, cuts[1:])]
            counts, grams, sizes, key, head, place = zip(*parts) if parts else [[]] * 6
            base = np.cumsum([0, *map(len, place)])
            head = [h + b for h, b in zip(head, base)] + [base[-1:]]
            ends = np.cumsum(np.concatenate([[0], *sizes]))
            inner = pa.ListArray.from_arrays(
                pa.array(np.concatenate(head).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *place]))
            )
            key = pa.array(np.concatenate([np.zeros(0, np.int64), *key]))
            ends = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, int), *counts])),
                 pa.ListArray.from_arrays(ends, key).cast(listed), pa.ListArray.from_arrays(ends, inner).cast(lists),
                 pa.array([g for part in grams for g in part], pa.binary())],
                names=["doc_id", "digest", "n_words", "keys", "places", "grams"],
            )

    schema = "doc_id long, digest string, n_words long, keys array<long>, places array<array<int>>, grams binary"
    return docs.mapInArrow(find, schema)


def sketch(grams: np.ndarray, places: list[int], width: int) -> tuple[np.ndarray, int]:
    """Bits of the shingles around ``places``, and how many of a window may set none of their own.

    All windows of ``width`` shingles that hold one of the places lie in the surroundings.
    """
    places, zeros = np.sort(places), np.zeros(len(places), int)
    most = most_lost(grams % FOLDED_BITS, np.array([0, len(grams)]), width)
    bits, lost = sketches(grams, most, places, zeros, zeros, zeros + len(grams), 1, width)
    return bits[0], int(lost[0])


def most_lost(grams: np.ndarray, begins: np.ndarray, width: int) -> np.ndarray:
    """For each place, the most shingles that set no bit of their own in a window of ``width`` around it.

    ``grams`` are those of several texts, whose first places and end are ``begins``.
    """
    sizes = np.diff(begins)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(grams))
    # By text, then by bit, then by place.
    ranked = np.sort((text * SKETCH_BITS + grams << 32) + place)
    order, ranked = ranked & 0xFFFFFFFF, ranked >> 32
    before = np.full(len(grams), -1)
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    before[order[same + 1]] = order[same]
    # A window counts the first place of a bit in it.
    first = np.maximum(place - width, before) + 1
    steps = np.bincount(first, minlength=len(grams) + 1)
    steps[1:] -= 1
    lost = width - np.cumsum(steps)[: len(grams)]
    # Windows that reach over the end of a text are passed over.
    lost[place + width > begins[1:][text]] = 0
    most = np.concatenate([np.zeros(width - 1, lost.dtype), lost])
    size = 1
    while size < width:
        step = min(size, width - size)
        most = np.maximum(most[step:], most[:-step])
        size += step
    return most


def sketches(
    grams: np.ndarray,
    most: np.ndarray,
    places: np.ndarray,
    of: np.ndarray,
    begin: np.ndarray,
    end: np.ndarray,
    count: int,
    width: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The :func:`sketch` of each of ``count`` lists of places; ``of`` numbers the list of a place, in order.

    ``grams`` are those of several texts, with their :func:`most_lost`; those of a place's text
    are from ``begin`` to ``end``.
    """
    lost = np.zeros(count, np.int32)
    np.maximum.at(lost, of, most[places])
    low, high = np.maximum(begin, places - width + 1), np.minimum(end, places + width)
    # What lies around two places of a list counts once.
    same = of[1:] == of[:-1]
    low[1:][same] = np.maximum(low[1:], high[:-1])[same]
    sizes = np.maximum(high - low, 0)
    around = np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)
    bits = np.zeros((count, FOLDED_BITS), bool)
    bits[np.repeat(of, sizes), grams[around] % FOLDED_BITS] = True
    return np.packbits(bits, axis=1).view(np.int64), lost


def around(grams: np.ndarray, places: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """The shingles around each of ``places`` in a row of its own, ``SKETCH_BITS`` beyond its text.

    ``grams`` are those of several texts; those of a place's text are from ``begin`` to ``end``.
    """
    at = places[:, None] + np.arange(1 - width, width)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    return np.where(inside, grams[np.where(inside, at, 0)], np.uint16(SKETCH_BITS))


def may_hold(own: np.ndarray, other: np.ndarray, width: int, needed: float, own_lost: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """In which rows :func:`around` two places windows of both may be similar, by the shingles that the other has there.

    Similar windows have, by :func:`may_match`, ``needed`` in common but for half of what sets no
    bit of its own in them; in the other's that is ``lost`` at most. What they share lies around the places.
    """
    count, size = own.shape
    rows, fits = np.arange(count)[:, None], np.ones(count, bool)
    for these, those, most in ((own, other, lost), (other, own, own_lost)):
        known = np.zeros((count, SKETCH_BITS + 1), bool)
        known[rows, those] = True
        inside = these != SKETCH_BITS
        # By bit, then by place.
        ranked = np.sort(these.astype(np.int32) * size + np.arange(size, dtype=np.int32), axis=1)
        place, value = ranked % size, ranked // size
        before = np.full((count, size), -1)
        same = value[:, 1:] == value[:, :-1]
        before[:, 1:][same] = place[:, :-1][same]
        # A window counts the first place of a bit in it.
        first = np.maximum(np.maximum(place - width, before) + 1, 0)
        last = np.minimum(place, size - width) + 1

        def distinct(chosen: np.ndarray) -> np.ndarray:
            row, at = np.nonzero(chosen & (first < last))
            base, cells = row * (size - width + 2), count * (size - width + 2)
            steps = np.bincount(base + first[row, at], minlength=cells) - np.bincount(base + last[row, at], minlength=cells)
            return np.cumsum(steps.reshape(count, -1), axis=1)[:, :-1]

        within = np.concatenate([np.zeros((count, 1), int), np.cumsum(inside, axis=1)], axis=1)
        whole = within[:, width:] - within[:, :-width] == width
        real = value != SKETCH_BITS
        least = needed - 0.5 * (width - distinct(real) + most[:, None])
        fits &= (whole & (distinct(real & known[rows, value]) >= least)).any(axis=1)
    return fits


def numbered(hits: DataFrame) -> DataFrame:
    """``hits`` with ``nth``, the number of its row under its key, and ``n``, all rows of the key.

    Rows are numbered within their partition of the input, and the partitions' counts are
    summed, so that no task holds all rows of a hot key.
    """
    hits = hits.withColumn("part", F.shiftrightunsigned("row", ROW_BITS))
    counts = hits.groupBy("key", "part").agg(F.count("*").alias("here"))
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "key", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"), F.sum("here").over(of_key).alias("n")
    )
    within = Window.partitionBy("key", "part").orderBy("row")
    ranked = hits.withColumn("at", F.row_number().over(within))
    return ranked.join(counts, ["key", "part"]).select("key", "row", "places", (F.col("base") + F.col("at")).alias("nth"), "n")


def _with_sketch(hits: DataFrame, passages: DataFrame, width: int) -> DataFrame:
    """``hits`` with the sketch of their places and the number of words of their text.

    Those of a key that more than two have come with the shingles ``around`` their places,
    unless these are more than ``PLACES``, but for the key's first row; of a window's shingles there
    ``few_lost`` at most set no bit of their own.
    """
    own = hits.groupBy("row").agg(F.collect_list(F.struct("key", "places", "nth", "n")).alias("own"))
    joined = own.join(passages.select("row", "grams", "n_words"), "row")

    def add(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            own = batch.column("own")
            row, hits = pc.list_parent_indices(own), own.flatten()
            lists = hits.field("places")
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            places, of = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
            # Bytes of the texts' shingles, two for each.
            raws = batch.column("grams")
            grams = np.frombuffer(b"".join(raws.to_pylist()), np.uint16)
            begins = np.concatenate([[0], np.cumsum(pc.binary_length(raws).to_numpy() // 2)])
            most, text = most_lost(grams % FOLDED_BITS, begins, width), row.to_numpy()[of]
            found = []
            for low in range(0, len(hits), HITS_AT_ONCE):
                high = min(low + HITS_AT_ONCE, len(hits))
                some = slice(ends[low - 1] if low else 0, ends[high - 1])
                begin, end = begins[text[some]], begins[text[some] + 1]
                found.append(sketches(grams, most, places[some] + begin, of[some] - low, begin, end, high - low, width))
            sizes = pc.list_value_length(lists).to_numpy()
            wanted = (sizes <= PLACES) & (hits.field("n").to_numpy() > 2) & (hits.field("nth").to_numpy() > 1)
            near, few_lost = np.full(len(hits), None, object), np.zeros(len(hits), np.int32)
            if wanted.any():
                np.maximum.at(few_lost, of, most_lost(grams, begins, width)[places + begins[text]])
            wanted = np.flatnonzero(wanted)
            for low in range(0, len(wanted), HITS_AT_ONCE // PLACES):
                some = wanted[low : low + HITS_AT_ONCE // PLACES]
                at = np.arange(sizes[some].sum()) + np.repeat(ends[some] - np.cumsum(sizes[some]), sizes[some])
                begin, end = begins[text[at]], begins[text[at] + 1]
                close = around(grams, places[at] + begin, begin, end, width)
                near[some] = [c.tobytes() for c in np.split(close, np.cumsum(sizes[some])[:-1])]
            numbers = np.concatenate([np.zeros((0, len(SKETCH)), np.int64), *(f[0] for f in found)])
            lost = np.concatenate([np.zeros(0, np.int32), *(f[1] for f in found)]).astype(np.int32)
            columns = [hits.field("key"), batch.column("row").take(row), lists, hits.field("nth"), hits.field("n")]
            columns += [batch.column("n_words").take(row), *(pa.array(numbers[:, k]) for k in range(len(SKETCH)))]
            columns += [pa.array(lost), pa.array(near, pa.binary()), pa.array(few_lost)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "row", "places", "nth", "n", "n_words", *SKETCH, *AROUND])

    numbers = ", ".join(f"{name} long" for name in SKETCH)
    return joined.mapInArrow(add, f"key long, row long, places array<int>, nth long, n long, n_words long, {numbers}, lost int, around binary, few_lost int")


def may_match(width: int, threshold: float) -> Column:
    """Whether windows around two rows' places of a key can be similar, by the sketches alone.

    Two sets of at least ``threshold`` have ``threshold / (1 + threshold)`` of their sizes in
    common. A shingle of a window that repeats, or shares a bit, lowers a size or the common bits
    by one, and of those that both have it lowers both sides: no similar pair is turned away.
    """
    common = sum((F.bit_count(F.col(name).bitwiseAND(F.col(f"other_{name}"))) for name in SKETCH), F.lit(0))
    needed = 2 * width * threshold / (1 + threshold) - 1e-6
    return common >= F.lit(needed) - 0.5 * (F.col("lost") + F.col("other_lost"))


def _may_meet(met: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs of ``met`` but those that :func:`may_hold` rules out, where neither has very many places."""
    size, needed = 2 * width - 1, 2 * width * threshold / (1 + threshold) - 1e-6

    def judge(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            raws = batch.column("around"), batch.column("other_around")
            few = pc.and_(*(pc.is_valid(r) for r in raws)).to_numpy(zero_copy_only=False)
            kept, few = ~few, np.flatnonzero(few)
            lost = [batch.column(c).to_numpy() for c in ("few_lost", "other_few_lost")]
            grams, places = [], []
            for raw in raws:
                found = raw.take(pa.array(few)).to_pylist()
                grams.append(np.frombuffer(b"".join(found), np.uint16).reshape(-1, size))
                places.append(np.array([len(f) // 2 // size for f in found], int))
            # All places of the one with all of the other.
            each = places[0] * places[1]
            of = np.repeat(np.arange(len(few)), each)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
            at = (np.cumsum(places[0]) - places[0])[of] + nth // places[1][of], (np.cumsum(places[1]) - places[1])[of] + nth % places[1][of]
            for low in range(0, len(of), HITS_AT_ONCE // 4):
                some = slice(low, low + HITS_AT_ONCE // 4)
                met = few[of[some]]
                fits = may_hold(grams[0][at[0][some]], grams[1][at[1][some]], width, needed, lost[0][met], lost[1][met])
                kept[met[fits]] = True
            yield batch.select(["row", "other", "words"]).filter(pa.array(kept))

    return met.mapInArrow(judge, "row long, other long, words long")


def runs_of(covered: np.ndarray) -> Iterator[tuple[int, int]]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist())


def in_order(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the shingles by value, and the values."""
    order = np.argsort(shingles, kind="stable")
    return order, shingles[order]


def found_in(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which of ``values`` are among ``ranked``, which is sorted."""
    at = np.searchsorted(ranked, values)
    at[at == len(ranked)] = 0
    return ranked[at] == values if len(ranked) else np.zeros(len(values), bool)


def distinct_counts(order: np.ndarray, ranked: np.ndarray, width: int, chosen: np.ndarray | None = None) -> np.ndarray:
    """How many distinct values each window of ``width`` holds, of the ``chosen`` places alone."""
    count = len(order) - width + 1
    if chosen is not None:
        order, ranked = order[chosen[order]], ranked[chosen[order]]
    before = np.full(len(order), -1)
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    before[same + 1] = order[same]
    # A window counts the first place of a value in it.
    low, high = np.maximum(order - width, before) + 1, np.minimum(order, count - 1) + 1
    some = low < high
    steps = np.bincount(low[some], minlength=count + 1) - np.bincount(high[some], minlength=count + 1)
    return np.cumsum(steps)[:count]


def in_windows(good: np.ndarray, width: int) -> np.ndarray:
    """Which places lie in a window that is ``good``."""
    sums = np.concatenate([np.zeros(width, int), np.cumsum(good), np.full(width - 1, good.sum())])
    return sums[width:] > sums[:-width]


class Stretches:
    """For each value at the chosen places, the stretches of windows that hold it.

    Places of a value that are less than ``width`` apart make one stretch, so that the
    stretches of a value are disjoint and a line that is repeated has few.
    """

    def __init__(self, order: np.ndarray, ranked: np.ndarray, chosen: np.ndarray, width: int, count: int) -> None:
        self.places, self.values = order[chosen[order]], ranked[chosen[order]]
        fresh = np.ones(len(self.places), bool)
        fresh[1:] = (self.values[1:] != self.values[:-1]) | (np.diff(self.places) > width)
        self.firsts = np.flatnonzero(fresh)
        lasts = np.append(self.firsts[1:], len(self.places)) - 1
        self.value = self.values[self.firsts]
        self.low = np.maximum(self.places[self.firsts] - width + 1, 0)
        self.high = np.minimum(self.places[lasts], count - 1)
        self.of = np.cumsum(fresh) - 1

    def touched(self, marks: np.ndarray) -> np.ndarray:
        """Which stretches have a place that is not in ``marks``."""
        return np.maximum.reduceat(~marks[self.places], self.firsts)


def dense_pairs(
    x: Stretches, y: Stretches, a: np.ndarray, b: np.ndarray, side: int, least_x: np.ndarray, least_y: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pairs of stretches meet where enough do, and ranges of shifts there.

    Pairs of windows fall into square cells by where they start; ``least_x`` and ``least_y``
    add up to what a cell needs. All cells count when a text is so repetitive that its
    stretches have very many.
    """
    wide, high = x.high[a] // side - x.low[a] // side + 1, y.high[b] // side - y.low[b] // side + 1
    each = wide * high
    if each.sum() > CELLS_AT_ONCE:
        far = np.iinfo(np.int32).max
        return np.arange(len(a)), np.array([-far]), np.array([far])
    pair = np.repeat(np.arange(len(a)), each)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
    row, column = (x.low[a] // side)[pair] + nth // high[pair], (y.low[b] // side)[pair] + nth % high[pair]
    columns = int(y.high.max()) // side + 1
    cells, place, counts = np.unique(row * columns + column, return_inverse=True, return_counts=True)
    dense = counts >= least_x[cells // columns] + least_y[cells % columns] - 1e-9
    shift = (cells[dense] % columns - cells[dense] // columns) * side
    return np.unique(pair[dense[place]]), shift - side + 1, shift + side


def matching_spans(
    own: np.ndarray,
    other: np.ndarray,
    places: np.ndarray | None,
    width: int,
    threshold: float,
    index: tuple[np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Which shingles of ``own`` and ``other`` lie in windows that are near-duplicates.

    Those are any two windows of ``width`` shingles whose sets have a Jaccard similarity of
    at least ``threshold``, in whatever order. Runs end with shingles that both windows
    have. Shifts of the shingles at ``places`` are tried first, which affects speed only.
    ``index`` is ``in_order(other)`` where that is known already.
    """
    mine, theirs = np.zeros(len(own), bool), np.zeros(len(other), bool)
    n, m = len(own) - width + 1, len(other) - width + 1
    if n < 1 or m < 1:
        return mine, theirs
    order, ranked = index or in_order(other)
    chosen = found_in(own, ranked)
    # Only windows most of whose values the other text has can have a partner.
    if np.count_nonzero(chosen) == 0:
        return mine, theirs
    own_order, own_ranked = in_order(own)
    sizes, other_sizes = distinct_counts(own_order, own_ranked, width), distinct_counts(order, ranked, width)
    able = distinct_counts(own_order, own_ranked, width, chosen) >= threshold * sizes - 1e-9
    chosen &= in_windows(able, width)
    if not chosen.any():
        return mine, theirs
    wanted = found_in(other, own_ranked[chosen[own_order]])
    other_able = distinct_counts(order, ranked, width, wanted) >= threshold * other_sizes - 1e-9
    wanted &= in_windows(other_able, width)
    if not wanted.any():
        return mine, theirs
    chosen &= found_in(own, ranked[wanted[order]])
    x, y = Stretches(own_order, own_ranked, chosen, width, n), Stretches(order, ranked, wanted, width, m)
    if not len(x.value):
        return mine, theirs
    share = threshold / (1 + threshold)
    needed = share * (sizes[able].min() + other_sizes[other_able].min()) - 1e-9

    # Pairs of stretches of a value, and the shifts at which they meet.
    low = np.searchsorted(y.value, x.value, "left")
    repeats = np.searchsorted(y.value, x.value, "right") - low
    a = np.repeat(np.arange(len(low)), repeats)
    b = np.arange(len(a)) + np.repeat(low - np.cumsum(repeats) + repeats, repeats)
    side = max(1, width // 2)
    floors = (
        np.minimum.reduceat(np.where(fit, share * size, np.inf), np.arange(0, len(size), side))
        for fit, size in ((able, sizes), (other_able, other_sizes))
    )
    kept, fit_low, fit_high = dense_pairs(x, y, a, b, side, *floors)
    a, b = a[kept], b[kept]
    if not len(a):
        return mine, theirs
    least, most = y.low[b] - x.high[a], y.high[b] - x.low[a]
    base, span = int(least.min()), int(most.max() - least.min()) + 2
    fit_low, fit_high = (np.clip(f - base, 0, span) for f in (fit_low, fit_high))
    fits = np.cumsum(np.bincount(fit_low, minlength=span + 1) - np.bincount(fit_high, minlength=span + 1))[:span] > 0

    def meeting(pairs: np.ndarray) -> np.ndarray:
        """How many of the pairs meet at each shift from ``base``."""
        steps = np.bincount(least[pairs] - base, minlength=span)
        return np.cumsum(steps - np.bincount(most[pairs] + 1 - base, minlength=span))

    def mark(shift: int, pairs: np.ndarray) -> None:
        pairs = pairs[(least[pairs] <= shift) & (shift <= most[pairs])]
        if len(pairs) < needed:
            return
        begin, end = max(0, -shift), min(n, m - shift)
        if begin >= end:
            return
        p, q = a[pairs], b[pairs]
        first = np.clip(np.maximum(x.low[p], y.low[q] - shift), begin, end)
        last = np.clip(np.minimum(x.high[p], y.high[q] - shift) + 1, begin, end)
        some = first < last
        start = begin
        steps = np.bincount(first[some] - start, minlength=end - start + 1)
        common = np.cumsum(steps - np.bincount(last[some] - start, minlength=end - start + 1))[:-1]
        both = sizes[begin:end] + other_sizes[begin + shift : end + shift]
        good = common * (1 + threshold) >= threshold * both - 1e-9
        if not good.any():
            return
        held = (np.zeros(len(own), bool), np.zeros(len(other), bool))
        sums = np.concatenate([[0], np.cumsum(good)])
        used = sums[last - start] > sums[first - start]
        for one, rows, marks, back in ((x, p[used], held[0], 0), (y, q[used], held[1], shift)):
            # The places of each stretch that lie in a good window with a value that both have.
            sizes_of = np.append(one.firsts[1:], len(one.places))[rows] - one.firsts[rows]
            of = np.repeat(np.flatnonzero(used), sizes_of)
            at = one.places[np.arange(len(of)) + np.repeat(one.firsts[rows] - np.cumsum(sizes_of) + sizes_of, sizes_of)]
            left = np.maximum(first[of], at - back - width + 1)
            right = np.minimum(last[of], at - back + 1)
            real = left < right
            left, right, at = left[real], right[real], at[real]
            marks[at[sums[right - start] > sums[left - start]]] = True
        found = np.flatnonzero(good) + begin
        cuts = np.flatnonzero(np.diff(found) > width)
        for f, g in zip(found[[0, *(cuts + 1)]], found[[*cuts, -1]]):
            for marks, covered, back in ((held[0], mine, 0), (held[1], theirs, shift)):
                inside = np.flatnonzero(marks[f + back : g + back + width])
                covered[f + back + inside[0] : f + back + inside[-1] + 1] = True

    def good_windows(shifts: np.ndarray, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The shifts at which windows are similar by the pairs, and where these start; many at once."""
        p, q, near, far = a[pairs], b[pairs], least[pairs], most[pairs]
        x_low, x_high, y_low, y_high = x.low[p], x.high[p] + 1, y.low[q], y.high[q] + 1
        step, part = 1, 0
        while part < len(shifts) and rest.any():
            some = shifts[part : part + step]
            part, step = part + step, min(4 * step, max(1, CELLS_AT_ONCE // 16 // max(n + 1, len(pairs))))
            # What was marked meanwhile may leave nothing for a shift to add.
            some = some[meeting(np.flatnonzero(rest))[some - base] > 0]
            if not len(some):
                continue
            row, of = np.nonzero((near <= some[:, None]) & (far >= some[:, None]))
            begin, end = np.maximum(0, -some), np.minimum(n, m - some)
            first = np.maximum(np.maximum(x_low[of], y_low[of] - some[row]), begin[row])
            last = np.minimum(np.minimum(x_high[of], y_high[of] - some[row]), end[row])
            kept = first < last
            row, first, last = row[kept] * (n + 1), first[kept], last[kept]
            cells = len(some) * (n + 1)
            steps = np.bincount(row + first, minlength=cells) - np.bincount(row + last, minlength=cells)
            common = np.cumsum(steps.reshape(-1, n + 1), axis=1)[:, :n]
            at, start = np.nonzero(common * (1 + threshold) >= threshold * (sizes.min() + other_sizes.min()) - 1e-9)
            fine = (start >= begin[at]) & (start < end[at])
            at, start = at[fine], start[fine]
            both = sizes[start] + other_sizes[start + some[at]]
            good = common[at, start] * (1 + threshold) >= threshold * both - 1e-9
            at, start = at[good], start[good]
            heads = np.searchsorted(at, np.arange(len(some) + 1))
            for k in np.flatnonzero(np.diff(heads)).tolist():
                yield int(some[k]), start[heads[k] : heads[k + 1]]

    def adds(shift: int, found: np.ndarray, pairs: np.ndarray) -> bool:
        """Whether marking the similar windows at ``found`` can cover anything new.

        It does where a pair with a place that is not covered lies in them; ``pairs`` are those
        that meet at the shift. Else it can only close a gap between places that are covered.
        """
        p, q = a[pairs], b[pairs]
        first = np.maximum(x.low[p], y.low[q] - shift)
        last = np.minimum(x.high[p], y.high[q] - shift) + 1
        if np.any(found.searchsorted(first) < found.searchsorted(last)):
            return True
        cuts = np.flatnonzero(found[1:] - found[:-1] > width)
        runs = zip(found[[0, *(cuts + 1)]].tolist(), found[[*cuts, -1]].tolist())
        for f, g in runs:
            for covered, back in ((mine, 0), (theirs, shift)):
                inside = covered[f + back : g + back + width]
                edges = np.count_nonzero(inside[1:] != inside[:-1])
                if edges > 2 or edges == 2 and inside[0]:
                    return True
        return False

    everything = np.arange(len(a))
    enough = fits & (meeting(everything) >= needed)
    exact, counts = np.unique(y.places[y.firsts[b]] - x.places[x.firsts[a]], return_counts=True)
    ahead = exact[np.argsort(-counts, kind="stable")]
    if places is not None:
        fixed = np.isin(x.places[x.firsts[a]], places)
        seeds = np.unique((y.places[y.firsts[b]] - x.places[x.firsts[a]])[fixed])
        ahead = np.concatenate([seeds, ahead[~np.isin(ahead, seeds)]])
    tried = np.zeros(span, bool)

    def undone() -> np.ndarray:
        return x.touched(mine)[a] | y.touched(theirs)[b]

    rest = undone()
    ahead = ahead[(ahead >= base) & (ahead < base + span)]
    for shift in ahead[enough[ahead - base]].tolist():
        tried[shift - base] = True
        if np.any(rest & (least <= shift) & (shift <= most)):
            mark(shift, everything)
            rest = undone()
    # Other shifts matter where windows hold what is not marked yet: passages that moved.
    if rest.any():
        left_x, left_y = (np.concatenate([[0], np.cumsum(w)]) for w in (chosen & ~mine, wanted & ~theirs))
        sums_x, sums_y = (np.concatenate([[0], np.cumsum(w[width:] > w[:-width])]) for w in (left_x, left_y))
        close = (sums_x[x.high[a] + 1] > sums_x[x.low[a]]) | (sums_y[y.high[b] + 1] > sums_y[y.low[b]])
        close = np.flatnonzero(close)
        able_at = fits & (meeting(close) >= needed) & (meeting(np.flatnonzero(rest)) > 0) & ~tried
        # Far apart first: in a text of repeated lines a few shifts cover what all others do.
        shifts = np.flatnonzero(able_at) + base
        nth = np.arange(1, len(shifts) + 1)
        for shift, good in good_windows(shifts[np.argsort(-(nth & -nth), kind="stable")], close):
            left = np.flatnonzero(rest & (least <= shift) & (shift <= most))
            if len(left) and adds(shift, good, left):
                before = np.count_nonzero(mine) + np.count_nonzero(theirs)
                mark(shift, close)
                if np.count_nonzero(mine) + np.count_nonzero(theirs) > before:
                    rest = undone()
    return mine, theirs


def _verify(pairs: DataFrame, with_text, shingle: int, length: int, threshold: float) -> DataFrame:
    """Spans of words of both documents of each pair; ``kept`` in the earlier one.

    Pairs meet in blocks of rows and of others, so that a text travels once for each block
    and not for each pair. Blocks are so many that one has a bounded number of pairs, and of
    ``words`` in them, in the mean. ``with_text`` adds the text of a ``row``.
    """
    width = length - shingle + 1
    asked = pairs.agg(F.count("*"), F.coalesce(F.sum("words"), F.lit(0))).first()
    side = F.lit(max(1, math.ceil(math.sqrt(max(asked[0] / PAIRS_AT_ONCE, asked[1] / WORDS_AT_ONCE)))))
    block = [F.pmod(F.xxhash64(c), side).alias(f"{c}_block") for c in ("row", "other")]
    cells = ["row_block", "other_block"]
    pairs = pairs.select("row", "other", *block)
    ends = pairs.select("row", *cells).unionByName(pairs.select(F.col("other").alias("row"), *cells)).distinct()
    texts = with_text(ends).dropDuplicates([*cells, "row"])
    texts = texts.select(F.col("row").alias("name"), "text", *[F.col(c).alias(f"of_{c}") for c in cells])

    def verify(asked: pa.Table, texts: pa.Table) -> pa.Table:
        at = {row: k for k, row in enumerate(texts.column("name").to_pylist())}
        column, recent, held, last, found = texts.column("text"), {}, 0, None, []
        for row, other in zip(*(asked.sort_by([("other", "ascending"), ("row", "ascending")]).column(c).to_pylist() for c in ("row", "other"))):
            for name in (other, row):
                if name not in recent:
                    if held > RECENT_SHINGLES:
                        recent, held = {}, 0
                    recent[name] = shingle_hashes(hashed_words(column[at[name]].as_py()), shingle)
                    held += len(recent[name])
                if name == other and (last is None or last[0] != other):
                    last = (other, recent[other], in_order(recent[other]))
            mine, theirs = matching_spans(recent[row], last[1], None, width, threshold, last[2])
            for name, covered, kept in ((row, mine, row < other), (other, theirs, other < row)):
                found += [(name, a, b + shingle - 1, kept) for a, b in runs_of(covered)]
        columns = list(zip(*found)) or [[]] * 4
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["row", "start", "end", "kept"])

    return pairs.groupBy(*cells).cogroup(texts.groupBy(*[f"of_{c}" for c in cells])).applyInArrow(
        verify, "row long, start int, end int, kept boolean"
    )


def may_be_in(df: DataFrame, asked: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in ``asked``, and few others, without a shuffle of ``df``.

    A bit map of the values' hashes, of 4 MB at most, is sent to all tasks.
    """
    def hashed(rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(rows[column]), F.lit(1 << MAP_BITS))

    number = hashed(asked)
    bits = asked.groupBy(F.bitmap_bucket_number(number).alias("map_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("map_bits")
    )
    number = hashed(df)
    place = F.bitmap_bit_position(number).cast("int")
    byte = F.conv(F.hex(F.substring("map_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = df.join(F.broadcast(bits), F.bitmap_bucket_number(number) == F.col("map_part"))
    return found.where(F.getbit(byte, place % 8) == 1).drop("map_part", "map_bits")


def repeated_passages(
    docs: DataFrame, length: int = LENGTH, threshold: float = THRESHOLD, shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id``, ``digest``, ``n_words``, ``repeats`` and ``originals`` for each row of ``docs``.

    ``repeats`` are the spans of words (start, end) that near-duplicate a passage of
    ``length`` or more words of an earlier row, ``originals`` those that later rows
    repeat. Passages are compared by windows of ``length`` words whose word
    ``shingle``-grams have a Jaccard similarity of at least ``threshold``. Of the rows that
    share a key, all are compared with the first; those in which the key's place is no repeat
    by then are compared with the next few, and so on until all are through, so a hot
    passage takes linear work where its rows repeat the first ones. Rows that share a key but
    no passage are all compared, by sketches of the key's surroundings first: texts are
    fetched only where windows around the key can be similar. The order of rows is that of the input's partitions. An
    exact copy of an earlier text is one repeat as a whole, and no original. Texts with fewer
    words, empty or null, have no passages. ``docs`` needs ``doc_id`` and ``text``; other
    columns are ignored.
    """
    chosen = docs.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), "text")
    passages = _passages(chosen, shingle, length).withColumn("row", F.monotonically_increasing_id())
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        passages = stage(passages, "passage-keys")
    # Copies of a text have its keys: the first of them stands for all.
    long = passages.where(F.col("n_words") >= length).select("row", "digest", "n_words")
    firsts = long.groupBy("digest").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    firsts = stage(firsts.where("n > 1").drop("n"), "passage-copies")
    copies = stage(long.join(firsts, "digest").where("row <> first").drop("digest"), "passage-copies")

    distinct = passages.select("row", "keys", "places").join(copies.select("row"), "row", "left_anti")
    # A row has a key once.
    keyed = distinct.select("row", F.inline(F.arrays_zip("keys", "places"))).toDF("row", "key", "places")
    if not isinstance(keyed.schema["places"].dataType, ArrayType):
        keyed = keyed.withColumn("places", F.array("places"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    hits = keyed.join(shared, "key").select("key", "row", "places")
    width = length - shingle + 1
    hits = numbered(stage(hits, "passage-hits"))
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        members = stage(_with_sketch(hits, passages, width), "passage-members")

    names = passages.select("row", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "digest")
    texts = chosen.select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "digest", "text"
    )

    def with_text(df: DataFrame) -> DataFrame:
        """``df`` with the text of the document in ``row``; repeated rows multiply.

        The rows asked for are stored, so that Spark knows how many they are; texts of most
        other rows are left out before they are shuffled.
        """
        asked = stage(df.join(names, "row"), "passage-asked")
        return asked.join(may_be_in(texts, asked, "digest"), ["id", "none", "digest"]).drop("id", "none", "digest")

    def not_covered(rows: DataFrame, spans: DataFrame, low: int) -> DataFrame:
        """Those of ``rows`` whose place is no repeat by ``spans``, and whether it is ``shared``.

        Rows that have met all others of their key by now are left out, too.
        """
        known = spans.groupBy("row").agg(F.collect_list(F.struct("start", "end", "kept")).alias("known"))
        state = rows.where(F.col("n") > low).join(known, "row", "left")
        inside = f"forall(places, p -> exists(known, s -> s.start <= p AND p <= s.end - {shingle}%s))"
        state = state.where(f"NOT coalesce({inside % ' AND NOT s.kept'}, false)")
        state = state.withColumn("shared", F.expr(f"coalesce({inside % ''}, false)")).drop("known")
        return state.where(f"NOT shared OR nth > {low + 1}")

    spans, done, low, high, rows = None, None, 0, 1, members
    # The first row of a key meets all others in the first round.
    waiting = members.where("nth > 1").withColumn("shared", F.lit(False))
    while True:
        # Rows whose passage later rows repeat need earlier ones only.
        others = rows.where((F.col("nth") > low) & (F.col("nth") <= high)).select(
            "key", F.col("row").alias("other"), *(F.col(c).alias(f"other_{c}") for c in (*SKETCH, *AROUND, "n_words"))
        )
        met = waiting.join(others, "key").where("row <> other AND (other < row OR NOT shared)")
        met = met.where(may_match(width, threshold)).select(
            F.greatest("row", "other").alias("row"), F.least("row", "other").alias("other"),
            (F.col("n_words") + F.col("other_n_words")).alias("words"), *(f"{side}{c}" for side in ("", "other_") for c in AROUND[1:]),
        )
        if low:
            with session_conf(docs.sparkSession, SMALL_BATCHES):
                met = stage(_may_meet(met, width, threshold), "passage-met")
        pairs = met.select("row", "other", "words").distinct()
        if done is not None:
            pairs = pairs.join(done, ["row", "other"], "left_anti")
        pairs = stage(pairs, "passage-pairs")
        if spans is None or not pairs.isEmpty():
            found = _verify(pairs, with_text, shingle, length, threshold)
            with session_conf(docs.sparkSession, ALL_TASKS):
                found = stage(found.dropDuplicates(["row", "start", "end", "kept"]), "passage-spans")
            done = pairs if done is None else done.unionByName(pairs)
            spans = found if spans is None else spans.unionByName(found)
        first, low, high = low == 0, high, (16 if high >= FEW else 4) * high - 1 if high > 1 else 3
        if first:
            left = members.where("n > 2 AND nth > 1").select("key", "row", "places", "nth", "n")
            left = stage(not_covered(left, spans, low).select("key", "row", "shared"), "passage-left")
            rows = stage(may_be_in(members.where("n > 2 AND nth > 1"), left, "key"), "passage-members")
            waiting = stage(rows.join(left, ["key", "row"]), "passage-waiting")
        else:
            waiting = stage(not_covered(waiting.drop("shared"), spans, low), "passage-waiting")
        if waiting.isEmpty():
            break

    whole = F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")
    spans = spans.unionByName(copies.select("row", *whole, F.lit(False).alias("kept")))
    spans = spans.unionByName(copies.select(F.col("first").alias("row"), *whole, F.lit(True).alias("kept")))
    spans = spans.dropDuplicates(["row", "start", "end", "kept"])
    span = F.struct("start", "end")
    spans = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(~F.col("kept"), span))).alias("repeats"),
        F.sort_array(F.collect_list(F.when(F.col("kept"), span))).alias("originals"),
    )
    none = F.expr("CAST(array() AS array<struct<start:int,end:int>>)")
    return passages.drop("keys", "places", "grams").join(spans, "row", "left").select(
        "doc_id", "digest", "n_words",
        F.coalesce("repeats", none).alias("repeats"), F.coalesce("originals", none).alias("originals"),
    )


def words_in(spans: Column) -> Column:
    """The number of words in the union of spans."""
    each = F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1))
    return F.size(F.array_distinct(F.flatten(each))).cast("long")


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between and after them."""
    starts = [m.start() for m in WORDS.finditer(text.translate(ASCII_LOWER))] + [len(text)]
    result, at = [], 0
    for low, high in sorted(spans):
        if starts[high] > at:
            result.append(text[at : max(at, starts[low])])
            at = starts[high]
    return "".join([*result, text[at:]])


def remove_repeats(docs: DataFrame, passages: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated passages cut from their ``text``; all columns stay.

    ``passages`` comes from :func:`repeated_passages` on the same table, with the same
    ``length``. A document of which nothing but repeats was left is dropped; null and empty
    texts stay. Of rows with the same id and a same text that is long enough to have passages
    one stays, as the one of them with the fewest repeated words, whatever the other columns
    hold; shorter ones all stay.
    """
    def free(name: str) -> str:
        return free_name(docs.columns, name)

    own_id, none, key, repeats, copies, cut_text = map(free, ("span_id", "span_none", "span_digest", "repeats", "copies", "cut_text"))
    names = [own_id, none, key]
    keyed = passages.withColumns({
        own_id: F.coalesce("doc_id", F.lit(0)), none: F.col("doc_id").isNull(), key: F.col("digest"),
    })
    spans = keyed.groupBy(*names).agg(
        F.min_by("repeats", words_in(F.col("repeats"))).alias(repeats),
        F.count(F.when(F.col("n_words") >= length, 1)).alias(copies),
    )
    spans = spans.where((F.size(repeats) > 0) | (F.col(copies) > 1))

    @F.pandas_udf("string")
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([
            without_words(t, [(s["start"], s["end"]) for s in own]) for t, own in zip(texts, spans)
        ])

    named = docs.withColumns({
        own_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), none: F.col("doc_id").isNull(),
        key: digest(F.col("text")),
    })
    joined = named.join(spans, names, "left")
    clean = joined.where(F.col(repeats).isNull()).select(docs.columns)
    once = joined.where(F.col(copies) > 1).dropDuplicates(names)
    changed = joined.where(F.col(copies) <= 1).unionByName(once).withColumn(
        cut_text, F.when(F.size(repeats) > 0, cut("text", repeats)).otherwise(F.col("text"))
    )
    changed = changed.where((F.trim(cut_text) != "") | (F.size(repeats) == 0))
    return clean.unionByName(changed.withColumn("text", F.col(cut_text)).select(docs.columns))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat across all ``documents``."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words",
        words_in(F.col("repeats")).alias("n_repeated"),
        words_in(F.concat("repeats", "originals")).alias("n_shared"),
        ((F.size("repeats") + F.size("originals")) > 0).alias("shared"),
        "repeats", "originals",
    )

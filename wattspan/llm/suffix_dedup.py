"""Removal of long byte strings that an earlier document has, by run-length compressed indexes.

Every string of ``length`` bytes is filed under the least hash among its shorter strings of
``anchor`` bytes. Neighbouring strings mostly share that anchor and form one piece, so equal
strings lie in pieces of one anchor, and pieces under different anchors never need to meet.

1. Anchors are counted from packed lists of 8 bytes each; which ones occur twice is kept in a
   bit map of bounded size (a false positive costs time only). Of these, a second map keeps
   which ones have pieces that differ.
2. Pieces of anchors that occur twice are shuffled by anchor. Equal pieces fold onto their first
   document; only pieces of an anchor that differ take their bytes along.
3. In a task, the earlier half of such an anchor's pieces goes into a run-length index and the
   later half is streamed through it, then the same within the halves.

An anchor with very many pieces is split: its strings are filed by their own hash instead,
under which only equal strings meet.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import BASE, BYTE_CODES, mix64, stage, table
from wattspan.llm.run_length_index import RunLengthIndex, flat_ranges

LENGTH = 50
# Bytes hashed at once; longer texts are cut into blocks that overlap.
BLOCK = 1 << 18
# Symbols of pieces that one index holds at most, and that a task works on at once.
CHUNK = 1 << 20
# Bits of the maps: anchors that occur twice and those that differ (32 MB each), and anchors
# that are split (128 kB).
SHARED_BITS, SPLIT_BITS = 28, 20
# Pieces under one anchor from which on it is split, and what one batch counts at most.
SPLIT_FROM = 2000
MOST_COUNTED = 63
# Bytes of text that a task takes up at once, and bytes of pieces that it hands on at once.
TAKEN_BYTES, SENT_BYTES = 12 << 20, 4 << 20
# Bytes of packed anchors that a counting task should hold.
COUNTED_BYTES = 64 << 20
NO_ID = np.iinfo(np.int64).max

COUNT_SCHEMA = "bucket INT, anchors BINARY"
MAP_SCHEMA = "bucket INT, shared BINARY, split BINARY"
PIECE_SCHEMA = "h LONG, c LONG, doc LONG, tag LONG, at INT, windows INT, piece BINARY"
SPAN_SCHEMA = "doc LONG, tag LONG, first INT, beyond INT"
RESULT_SCHEMA = "doc_id LONG, n_bytes LONG, spans ARRAY<STRUCT<first: INT, beyond: INT>>, kept BINARY"

_TABLES: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for one block."""
    if not _TABLES:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            factors = np.full(2 * BLOCK, base, np.uint64)
            factors[0] = 1
            _TABLES[name] = np.cumprod(factors, dtype=np.uint64)
    return _TABLES["up"], _TABLES["down"]


class Pieces(NamedTuple):
    """Pieces of a batch: place in the joined bytes, number of strings, anchor, content."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray
    content: np.ndarray

    def chosen(self, which: np.ndarray) -> Pieces:
        return Pieces(*(column[which] for column in self))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[: len(values) - step], values[step:])
        size += step
    return values


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array with a byte between them, their starts and sizes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    return np.frombuffer(b"\0".join(texts), np.uint8), starts, sizes


def cut(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> Pieces:
    """The pieces of all texts. A text shorter than ``length`` has none."""
    anchor = length // 2 + 1
    width = length - anchor + 1
    up, down = _powers()
    # Segments of at most BLOCK strings, each with the bytes of its last string.
    strings = np.maximum(sizes - length + 1, 0)
    parts = -(-strings // BLOCK)
    number = flat_ranges(np.zeros(len(sizes), np.int64), parts)
    seg_start = np.repeat(starts, parts) + number * BLOCK
    seg_strings = np.minimum(np.repeat(strings, parts) - number * BLOCK, BLOCK)
    found: list[Pieces] = []
    low = 0
    while low < len(seg_start):
        base = int(seg_start[low])
        ends = seg_start + seg_strings + length - 1
        high = max(low + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        block = raw[base : int(ends[high - 1])]
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(BYTE_CODES[block] * up[: len(block)], out=total[1:])
        grams = mix64((total[anchor:] - total[:-anchor]) * down[: len(block) - anchor + 1])
        least = _sliding_min(grams, width)
        change = np.zeros(len(least) + 1, bool)
        change[1:-1] = least[1:] != least[:-1]
        first, count = seg_start[low:high] - base, seg_strings[low:high]
        change[first] = True
        change[first + count] = True  # strings across two texts, until the next one starts
        inside = np.zeros(len(least) + 1, np.int8)
        inside[first] += 1
        inside[first + count] -= 1
        at = np.flatnonzero(change)
        size = np.diff(at, append=len(least))
        inside = np.cumsum(inside)[at] > 0
        at, size = at[inside & (size > 0)], size[inside & (size > 0)]
        # Periodic text has one least hash for long; pieces stay short all the same.
        cuts = -(-size // width)
        step = flat_ranges(np.zeros(len(at), np.int64), cuts) * width
        at, size = np.repeat(at, cuts) + step, np.minimum(np.repeat(size, cuts) - step, width)
        content = mix64((total[at + size + length - 1] - total[at]) * down[at])
        found.append(Pieces(at + base, size, mix64(least[at] ^ np.uint64(0x5851F42D4C957F2D)), content))
        low = high
    if not found:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none.astype(np.uint64), none.astype(np.uint64))
    return Pieces(*(np.concatenate(column) for column in zip(*found)))


def _taken(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], slice]]:
    """The texts of a batch in parts of bounded bytes, with the rows of each part."""
    texts = batch.column("raw").to_pylist()
    load = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) // TAKEN_BYTES
    edges = [0, *(np.flatnonzero(np.diff(load)) + 1), len(texts)]
    for low, high in zip(edges, edges[1:]):
        if low < high:
            yield texts[low:high], slice(low, high)


# --- 1: which anchors occur twice, and which differ -----------------------------


def _packed(bucket_of: np.ndarray, entries: np.ndarray) -> pa.RecordBatch:
    """Entries in order of their bucket as one row for each bucket."""
    heads = np.flatnonzero(np.diff(bucket_of, prepend=-1))
    lists = np.split(entries, heads[1:]) if len(entries) else []
    return pa.record_batch(
        [pa.array(bucket_of[heads]), pa.array([part.tobytes() for part in lists], pa.binary())],
        ["bucket", "anchors"],
    )


def _bucket(anchors: np.ndarray, bits: int) -> np.ndarray:
    return (anchors >> np.uint64(64 - bits)).astype(np.int32)


def packed_anchors(docs: DataFrame, length: int, bucket_bits: int) -> DataFrame:
    """Distinct anchors of each part of a batch by their first bits, packed.

    The last six bits of an anchor give way to its number of pieces in the part.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _ in _taken(batch):
                pieces = cut(*joined(texts), length)
                keys, times = np.unique(pieces.anchor >> np.uint64(6), return_counts=True)
                keys = (keys << np.uint64(6)) | np.minimum(times, MOST_COUNTED).astype(np.uint64)
                yield _packed(_bucket(keys, bucket_bits), keys)

    return docs.select("raw").mapInArrow(count, COUNT_SCHEMA)


def packed_contents(docs: DataFrame, length: int, bucket_bits: int, shared, split) -> DataFrame:
    """Distinct pairs of anchor and content where the anchor occurs twice and is not split."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _ in _taken(batch):
                pieces = cut(*joined(texts), length)
                pieces = pieces.chosen(in_map(shared.value, pieces.anchor))
                pieces = pieces.chosen(~in_map(split.value, pieces.anchor))
                order = np.lexsort((pieces.content, pieces.anchor))
                pairs = np.stack([pieces.anchor[order], pieces.content[order]], axis=1)
                pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])[: len(pairs)]]
                yield _packed(_bucket(pairs[:, 0], bucket_bits), pairs)

    return docs.select("raw").mapInArrow(pair, COUNT_SCHEMA)


def _map_part(anchors: np.ndarray, bits: int, bucket_bits: int) -> bytes:
    own = np.zeros(1 << (bits - bucket_bits), np.uint8)
    own[(anchors >> np.uint64(64 - bits)) & np.uint64(len(own) - 1)] = 1
    return zlib.compress(np.packbits(own).tobytes(), 1)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    lists: dict[int, list[bytes]] = {}
    for batch in batches:
        for bucket, anchors in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lists.setdefault(bucket, []).append(anchors)
    for bucket in sorted(lists):
        yield bucket, np.frombuffer(b"".join(lists.pop(bucket)), np.uint64).copy()


def _map_row(bucket: int, shared: bytes, split: bytes) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([bucket], pa.int32()), pa.array([shared], pa.binary()), pa.array([split], pa.binary())],
        ["bucket", "shared", "split"],
    )


def anchor_maps(packed: DataFrame, bucket_bits: int, partitions: int, split_from: int) -> DataFrame:
    """For each bucket, its part of the maps of anchors that occur twice or are split."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys in _by_bucket(batches):
            keys.sort()
            anchors = keys >> np.uint64(6)
            heads = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
            times = np.add.reduceat((keys & np.uint64(63)).astype(np.int64), heads)
            anchors = keys[heads]
            yield _map_row(
                bucket,
                _map_part(anchors[times >= 2], SHARED_BITS, bucket_bits),
                _map_part(anchors[times >= split_from], SPLIT_BITS, bucket_bits),
            )

    return packed.repartition(partitions, "bucket").mapInArrow(add, MAP_SCHEMA)


def content_maps(packed: DataFrame, bucket_bits: int, partitions: int) -> DataFrame:
    """For each bucket, its part of the map of anchors whose pieces differ."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, pairs in _by_bucket(batches):
            anchor, content = pairs.reshape(-1, 2).T
            order = np.argsort(anchor, kind="stable")
            anchor, content = anchor[order], content[order]
            differ = (anchor[1:] == anchor[:-1]) & (content[1:] != content[:-1])
            yield _map_row(bucket, _map_part(anchor[1:][differ], SHARED_BITS, bucket_bits), b"")

    return packed.repartition(partitions, "bucket").mapInArrow(add, MAP_SCHEMA)


def gathered_map(rows: list, column: str, bits: int) -> np.ndarray:
    """A map whole from its parts: 32 MB or 128 kB, whatever the size of the corpus."""
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows:
        part = np.frombuffer(zlib.decompress(row[column]), np.uint8)
        whole[row["bucket"] * len(part) : (row["bucket"] + 1) * len(part)] = part
    return whole


def in_map(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Which anchors have their bit, numbered by their first bits, set."""
    index = anchors >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[index >> np.uint64(3)] >> (7 - (index & np.uint64(7)).astype(np.uint8))) & 1 == 1


# --- 2: pieces of those anchors -----------------------------------------------


def _split(pieces: Pieces, raw: np.ndarray, length: int) -> Pieces:
    """Every string of the pieces as a piece of its own, filed by its own hash."""
    start = flat_ranges(pieces.start, pieces.windows)
    own = np.zeros(len(start), np.uint64)
    for k in range(length):
        own = own * np.uint64(BASE) + BYTE_CODES[raw[start + k]]
    own = mix64(own)
    return Pieces(start, np.ones(len(start), np.int64), own, own)


def _binary(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    data = raw[flat_ranges(starts, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _merged(first: np.ndarray, beyond: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of intervals given in order of their starts."""
    reach = np.maximum.accumulate(beyond)
    heads = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return first[heads], np.append(reach[heads[1:] - 1], reach[-1])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def shared_pieces(docs: DataFrame, length: int, shared, split, differing) -> DataFrame:
    """Pieces of the anchors that occur twice, one row for each place.

    Of equal pieces in one part of a batch only those of the least document are handed on. In
    later documents they are covered already: such stretches have no ``windows``, and their
    size in place of the content. Only pieces of differing anchors have content and bytes.
    """

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_of = batch.column("doc").to_numpy(zero_copy_only=False)
            tags_of = batch.column("tag").to_numpy(zero_copy_only=False)
            for texts, rows in _taken(batch):
                yield from part(*joined(texts), docs_of[rows], tags_of[rows])

    def row_batch(h, c, doc, tag, at, windows, piece) -> pa.RecordBatch:
        names = [field.split()[0] for field in PIECE_SCHEMA.split(", ")]
        numbers = [pa.array(column.astype(np.int64)) for column in (c, doc, tag)]
        small = [pa.array(column.astype(np.int32)) for column in (at, windows)]
        return pa.record_batch([pa.array(h.view(np.int64)), *numbers, *small, piece], names)

    def part(raw, starts, sizes, doc, tag) -> Iterator[pa.RecordBatch]:
        pieces = cut(raw, starts, sizes, length)
        pieces = pieces.chosen(in_map(shared.value, pieces.anchor))
        hot = in_map(split.value, pieces.anchor)
        if hot.any():
            finer = _split(pieces.chosen(hot), raw, length)
            pieces = Pieces(*map(np.concatenate, zip(pieces.chosen(~hot), finer)))
        if not len(pieces.start):
            return
        owner = np.searchsorted(starts, pieces.start, "right") - 1
        key = mix64(pieces.anchor ^ (pieces.content * np.uint64(BASE)))
        order = np.lexsort((doc[owner], key))
        pieces, owner, key = pieces.chosen(order), owner[order], key[order]
        heads = np.concatenate([[True], key[1:] != key[:-1]])
        kept = doc[owner] == doc[owner][heads][np.cumsum(heads) - 1]

        later = np.flatnonzero(~kept)
        later = later[np.argsort(pieces.start[later], kind="stable")]
        if len(later):
            start = pieces.start[later]
            first, beyond = _merged(start, start + pieces.windows[later] + length - 1)
            of = np.searchsorted(starts, first, "right") - 1
            yield row_batch(
                tag[of], beyond - first, doc[of], tag[of], first - starts[of],
                np.zeros(len(of)), pa.nulls(len(of), pa.binary()),
            )

        pieces, of = pieces.chosen(kept), owner[kept]
        differ = in_map(differing.value, pieces.anchor)
        differ &= pieces.anchor != pieces.content
        for which in (np.flatnonzero(differ), np.flatnonzero(~differ)):
            some = pieces.chosen(which)
            size = some.windows + length - 1
            with_bytes = len(which) > 0 and bool(differ[which[0]])
            content = some.content.view(np.int64) if with_bytes else np.zeros(len(which))
            load = np.cumsum(size if with_bytes else np.zeros(len(which), np.int64)) // SENT_BYTES
            edges = [0, *(np.flatnonzero(np.diff(load)) + 1), len(which)]
            for low, high in zip(edges, edges[1:]):
                own = slice(low, high)
                source = of[which[own]]
                piece = _binary(raw, some.start[own], size[own]) if with_bytes else pa.nulls(high - low, pa.binary())
                yield row_batch(
                    some.anchor[own], content[own], doc[source], tag[source],
                    some.start[own] - starts[source], some.windows[own], piece,
                )

    return docs.mapInArrow(select, PIECE_SCHEMA)


# --- 3: matches among the pieces of an anchor ----------------------------------


def _later_matches(
    anchor: np.ndarray, doc: np.ndarray, sizes: np.ndarray, raw: np.ndarray, length: int, chunk: int
) -> tuple[np.ndarray, np.ndarray]:
    """Strings of pieces that a piece of an earlier document has: piece and place in it.

    Pieces come in order of anchor and document. Documents of an anchor are numbered; for
    every bit of that number, those without it are indexed and those with it streamed. Two
    documents differ in some bit, the highest of which the later one has.
    """
    offset = np.cumsum(sizes) - sizes
    fresh = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    other = np.cumsum(fresh | np.concatenate([[True], doc[1:] != doc[:-1]]))
    group = np.cumsum(fresh) - 1
    number = other - other[fresh][group]
    ends = np.append(np.flatnonzero(fresh)[1:], len(anchor)) - 1
    highest = number[ends][group]
    places: list[np.ndarray] = []
    for bit in range(int(highest.max(initial=0)).bit_length()):
        has = (number >> bit) & 1 == 1
        known, sought = np.flatnonzero(~has & (highest >> bit > 0)), np.flatnonzero(has)
        load = np.cumsum(sizes[known] + 1) // chunk
        for part in np.split(known, np.flatnonzero(np.diff(load)) + 1):
            text = raw[flat_ranges(offset[part], sizes[part])]
            index = RunLengthIndex(text, sizes[part], doc[part], length)
            # Anchors of other parts have nothing in common with this one.
            near = sought[np.isin(group[sought], group[part])] if len(part) < len(known) else sought
            if not len(near):
                continue
            pattern, place, at = index.matches(raw[flat_ranges(offset[near], sizes[near])], sizes[near])
            earlier = index.first_owner(at) < doc[near[pattern]]
            places.append(near[pattern[earlier]] * length + place[earlier])
    found = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
    return found // length, found % length


def _spans(rows: pa.Table, length: int, chunk: int) -> pa.RecordBatch:
    """Covered stretches of the documents in ``rows``, which hold whole anchors in order."""
    names = ("h", "c", "doc", "tag", "at", "windows")
    h, c, doc, tag, at, windows = (rows.column(n).to_numpy().astype(np.int64) for n in names)
    ready = np.flatnonzero(windows == 0)
    out = [(ready, at[ready], at[ready] + c[ready])]

    own = np.flatnonzero(windows > 0)
    if len(own):
        new = (h[own][1:] != h[own][:-1]) | (c[own][1:] != c[own][:-1])
        heads = np.concatenate([[True], new])
        of = np.cumsum(heads) - 1
        first = own[heads]
        copy = doc[own] > doc[first][of]
        copies = own[copy]
        out.append((copies, at[copies], at[copies] + windows[copies] + length - 1))

        column = rows.column("piece").combine_chunks()
        differing = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)[first])
        differing = differing[np.lexsort((doc[first[differing]], h[first[differing]]))]
        if len(differing):
            chosen = first[differing]
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :]
            data = np.frombuffer(column.buffers()[2], np.uint8)
            sizes = windows[chosen] + length - 1
            raw = data[flat_ranges(offsets[chosen].astype(np.int64), sizes)]
            piece, place = _later_matches(h[chosen], doc[chosen], sizes, raw, length, chunk)
            if len(piece):
                # Runs of neighbouring strings, then every place that has the piece.
                run = np.concatenate([[True], (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)])
                low = place[run]
                high = place[np.append(np.flatnonzero(run)[1:], len(place)) - 1] + length
                which = differing[piece[run]]
                having, number = own[~copy], of[~copy]  # the numbers are in order
                begin = np.searchsorted(number, which, "left")
                times = np.searchsorted(number, which, "right") - begin
                row = having[flat_ranges(begin, times)]
                out.append((row, at[row] + np.repeat(low, times), at[row] + np.repeat(high, times)))
    row, begin, beyond = (np.concatenate(part) for part in zip(*out))
    return pa.record_batch(
        [pa.array(doc[row]), pa.array(tag[row]), pa.array(begin.astype(np.int32)), pa.array(beyond.astype(np.int32))],
        ["doc", "tag", "first", "beyond"],
    )


def covered_spans(pieces: DataFrame, length: int, chunk: int) -> DataFrame:
    """``doc``, ``tag`` and a stretch of bytes that an earlier document has, as rows.

    Rows are sorted by anchor within their task and worked off in parts of whole anchors.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < 2 * chunk:
                continue
            rows = pa.Table.from_batches(held)
            anchors = rows.column("h").to_numpy()
            edge = int(np.searchsorted(anchors, anchors[-1], "left"))
            if edge:
                yield _spans(rows.slice(0, edge), length, chunk)
                held = rows.slice(edge).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield _spans(pa.Table.from_batches(held), length, chunk)

    ordered = pieces.repartition("h").sortWithinPartitions("h", "c", "doc")
    return ordered.mapInArrow(judge, SPAN_SCHEMA)


# --- the operator -------------------------------------------------------------


def repeated_strings(
    docs: DataFrame, length: int = LENGTH, split_from: int = SPLIT_FROM, chunk: int = CHUNK
) -> DataFrame:
    """Texts without the bytes of any string of ``length`` bytes that an earlier document has.

    Earlier is a smaller ``doc_id``; rows without an id come after all others and are not
    earlier than each other. Strings are looked for in the texts as given. Every row gives
    ``doc_id``, ``n_bytes``, the maximal removed ``spans`` in bytes, and the ``kept`` bytes,
    which may begin or end within a character. Null is as an empty text; rows that repeat an
    id stay, and do not remove from each other. Other columns are ignored.
    """
    if length < 8:
        raise ValueError("strings of fewer than 8 bytes are no anchors")
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce("text", F.lit(""))
    units = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("tag"),
        text.cast("binary").alias("raw"),
    )
    size = units.agg(F.sum(F.length("raw"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // COUNTED_BYTES)
    bucket_bits = min(SPLIT_BITS - 3, max(6, int(partitions).bit_length() + 2))
    counted = anchor_maps(packed_anchors(units, length, bucket_bits), bucket_bits, partitions, split_from).collect()
    bounded = [("shared", SHARED_BITS), ("split", SPLIT_BITS)]
    shared, split = (spark.sparkContext.broadcast(gathered_map(counted, *of)) for of in bounded)
    pairs = packed_contents(units, length, bucket_bits, shared, split)
    told = content_maps(pairs, bucket_bits, partitions).collect()
    differing = spark.sparkContext.broadcast(gathered_map(told, "shared", SHARED_BITS))

    pieces = shared_pieces(units.drop("doc_id"), length, shared, split, differing)
    spans = covered_spans(pieces, length, chunk)
    per_text = stage(
        spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "beyond")).alias("found")),
        "repeated-strings",
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("found").to_pylist()):
                runs: list[dict[str, int]] = []
                for span in sorted(found or [], key=lambda s: s["first"]):
                    if runs and span["first"] <= runs[-1]["beyond"]:
                        runs[-1]["beyond"] = max(runs[-1]["beyond"], span["beyond"])
                    else:
                        runs.append(dict(span))
                edges = [0, *(edge for run in runs for edge in (run["first"], run["beyond"])), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append(runs)
            sizes = pa.array([len(r) for r in batch.column("raw").to_pylist()], pa.int64())
            kind = pa.list_(pa.struct([("first", pa.int32()), ("beyond", pa.int32())]))
            yield pa.record_batch(
                [batch.column("doc_id"), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    joined_rows = units.join(per_text, ["doc", "tag"], "left").select("doc_id", "raw", "found")
    return joined_rows.mapInArrow(remove, RESULT_SCHEMA)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document that an earlier one has in strings of 50, and what is left."""
    found = repeated_strings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

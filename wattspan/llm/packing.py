"""Packing of token sequences: shortest pack first over the histogram of lengths.

Documents become token pieces of at most ``capacity`` ids; a histogram of piece lengths,
which has at most ``capacity`` rows whatever the input, is packed on the driver; the
patterns found are joined back to the pieces by their rank among those of their length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattspan.llm.common import stage, table
from wattspan.llm.tokens import encoder

CAPACITY = 1024
END_ID = 0
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
BLOCK_BITS = 12
TEXTS_AT_ONCE = 256


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    spaces: str = "kept",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty
    text is the end id alone; repeated rows and rows without an id are documents of their
    own. ``ids`` holds little-endian unsigned 32-bit ids, ``start`` counts the ids of the
    document before the piece, ``doc_tokens`` all of them.
    """
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces)
        for batch in batch_iter:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                raw = [ids + end for ids in encode(part.column(1).to_pylist())]
                rows = [
                    (key, at // 4, len(ids[at : at + width]) // 4, len(ids) // 4, ids[at : at + width])
                    for key, ids in zip(part.column(0).to_pylist(), raw)
                    for at in range(0, len(ids), width)
                ]
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


Pattern = tuple[tuple[int, int], ...]


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, Pattern]]:
    """Patterns and how many packs follow each.

    Lengths are placed longest first, each into the packs with most space left. A pattern
    lists (length, copies). Every step uses up a pattern or all but a remainder of a
    length, so there are at most about three patterns per length.
    """
    packs: dict[int, Counter[Pattern]] = defaultdict(Counter)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max(packs, default=0)
            if space >= length:
                pattern, available = packs[space].popitem()
                if not packs[space]:
                    del packs[space]
            else:
                space, pattern, available = capacity, (), left
            copies = min(space // length, left)
            used = min(available, left // copies)
            if pattern and available > used:
                packs[space][pattern] += available - used
            packs[space - copies * length][(*pattern, (length, copies))] += used
            left -= used * copies
    return [(n, pattern) for by_space in packs.values() for pattern, n in by_space.items()]


def slots(patterns: list[tuple[int, Pattern]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each length the ranges of ranks that a pattern takes, and where they go.

    Rows: length, first rank, end rank, copies per pack, first sequence, offset in it.
    """
    rows, rank, sequence = [], Counter(), 0
    for n, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            first = rank[length]
            rank[length] += n * copies
            rows.append((length, first, rank[length], copies, sequence, offset))
            offset += length * copies
        sequence += n
    return rows


SLOTS = "slot_length long, first_rank long, end_rank long, copies long, base long, at long"


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with the ``sequence_id`` and the ``offset`` in it that each takes.

    Any table with a ``length`` column from 1 to ``capacity`` will do, and its other
    columns stay; they are stored and shuffled, so wide ones are better left out.
    Sequences are numbered from 0 and filled from offset 0 without gaps. Equal lengths
    are dealt in the order of the stored rows. A hot length is ranked in blocks of 4,096
    neighbouring rows, whose counts are summed. Raises on a length out of range.
    """
    spark = pieces.sparkSession
    staged = stage(pieces.withColumn("row", F.monotonically_increasing_id()), "packing")
    staged = staged.withColumn("block", F.shiftright("row", BLOCK_BITS))
    counts = staged.groupBy("block", "length").agg(F.count("*").alias("n"))
    histogram = {
        r["length"]: r["n"]
        for r in staged.groupBy("length").agg(F.count("*").alias("n")).limit(capacity + 1).collect()
    }
    if any(not n or not 0 < n <= capacity for n in histogram):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    found = slots(shortest_pack_first(histogram, capacity))
    # Patterns are bounded by the number of lengths, and so is this table.
    places = F.broadcast(spark.createDataFrame(found, SLOTS))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base")
    )
    within = Window.partitionBy("block", "length").orderBy("row")
    ranked = (
        staged.withColumn("nth", F.row_number().over(within) - 1)
        .join(bases, ["block", "length"])
        .withColumn("rank", F.col("rank_base") + F.col("nth"))
    )
    placed = ranked.join(
        places,
        (F.col("length") == F.col("slot_length"))
        & (F.col("rank") >= F.col("first_rank"))
        & (F.col("rank") < F.col("end_rank")),
    )
    turn = F.col("rank") - F.col("first_rank")
    return placed.select(
        *pieces.columns,
        (F.col("base") + F.floor(turn / F.col("copies"))).alias("sequence_id"),
        (F.col("at") + F.pmod(turn, F.col("copies")) * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids as binary, its length and the pieces in it.

    ``packed`` must still hold ``ids``. A sequence has at most ``capacity`` pieces.
    """
    pieces = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return packed.groupBy("sequence_id").agg(pieces.alias("pieces")).select(
        "sequence_id",
        F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["length"]).alias("length"),
        F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"),
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1,024 tokens."""
    import public_tokenizers

    pieces = token_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )

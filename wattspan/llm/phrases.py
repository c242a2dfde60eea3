"""Phrase collocations by sampled candidates and their negative border.

A sample of the documents proposes phrases at a lowered threshold. A full pass counts exactly
all of them and their negative border: phrases that are not proposed, while what is left of
them without the first and without the last word is. Where a border phrase turns out frequent,
it joins the proposed ones, and a further pass counts what newly borders on them, until no
frequent phrase is left outside. Every frequent phrase is then counted, whatever the sample was.

The proposed phrases travel as a bit map of bounded size; a false positive only has further
phrases counted. A pass first adds up its phrases in buckets by their hash: one whose bucket stays
below the threshold is not frequent, so only the rest is counted by its words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattspan.llm.common import BASE, BYTE_CODES, LOWER, SMALL_BATCHES, UPPER, let_go, mix64, stage, table
from wattspan.session import session_conf

LONGEST = 4
LEAST = 30
KEPT_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"
# One document in so many is sampled, and the share of the expected count that is enough there.
SAMPLED_ONE_IN, LOWERED = 8, 0.5
# Bits of the map of proposed phrases: 16 MB.
MAP_BITS = 27
# Bytes of text that a task takes up at once.
TAKEN_BYTES = 5 << 20
# The first of the bits of a phrase's hash number its part of the map.
PART_BITS = 8

# As many of them number the part in which phrases are added up by their words.
COUNT_PART_BITS = 12

COUNT_SCHEMA = "lang STRING, size INT, phrase BINARY, n LONG, hash LONG"
LISTED = ["size", "phrase", "n", "hash"]
PACKED_SCHEMA = "part INT, lang STRING, size ARRAY<INT>, phrase ARRAY<BINARY>, n ARRAY<LONG>, hash ARRAY<LONG>"
MAP_SCHEMA = "part INT, bits BINARY"

# What separates pieces, and words within them.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
IS_END = np.isin(np.arange(256), list(PIECE_ENDS))
IS_SPACE = np.isin(np.arange(256), list(SPACES))

WORD_BLOCK = 1 << 16
_POWERS: dict[str, np.ndarray] = {}


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``raw``; in blocks of whole words."""
    if not _POWERS:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            factors = np.full(WORD_BLOCK, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    found, low = [np.zeros(0, np.uint64)], 0
    while low < len(starts):
        base = int(starts[low])
        high = int(np.searchsorted(ends, base + WORD_BLOCK, "right"))
        if high <= low:  # one long word
            word, value = raw[base : ends[low]], np.uint64(0)
            for part in np.split(word, range(WORD_BLOCK, len(word), WORD_BLOCK)):
                own = (BYTE_CODES[part] * _POWERS["up"][: len(part)]).sum(dtype=np.uint64)
                value = mix64(np.array([value ^ own]))[0]
            found.append(np.array([value], np.uint64))
            low += 1
            continue
        block = raw[base : int(ends[high - 1])]
        total = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(BYTE_CODES[block] * _POWERS["up"][: len(block)], out=total[1:])
        first = starts[low:high] - base
        found.append((total[ends[low:high] - base] - total[first]) * _POWERS["down"][first])
        low = high
    return mix64(np.concatenate(found))


class Words:
    """Words of several texts of one language: their bytes, pieces and hashes."""

    def __init__(self, texts: list[bytes], lang: str) -> None:
        # A newline between texts ends a piece.
        self.raw = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        inside = ~(IS_SPACE | IS_END)[self.raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.searchsorted(np.flatnonzero(IS_END[self.raw]), self.starts)
        seed = zlib.crc32(lang.encode("utf-8", "surrogatepass"))
        self.hashes = mix64(_word_hashes(self.raw, self.starts, self.ends) ^ np.uint64(seed * 0x9E3779B1))

    def phrases(self, size: int, before: np.ndarray | None) -> np.ndarray:
        """Hash of the phrase of ``size`` words at every word; some reach beyond their piece."""
        if size == 1:
            return self.hashes
        count = max(0, len(self.hashes) - size + 1)
        return mix64(before[:count] * np.uint64(BASE) + self.hashes[size - 1 :][:count])

    def whole(self, size: int) -> np.ndarray:
        """Which phrases of ``size`` words lie within their piece."""
        count = max(0, len(self.piece) - size + 1)
        return self.piece[:count] == self.piece[size - 1 :][:count]

    def text(self, first: np.ndarray, size: int) -> list[bytes]:
        """The phrases that start at the given words, joined by single spaces."""
        raw, low, high = self.raw.tobytes(), self.starts[first], self.ends[first + size - 1]
        own = sum(self.ends[first + k] - self.starts[first + k] for k in range(size))
        phrases = [raw[a:b] for a, b in zip(low.tolist(), high.tolist())]
        for k in np.flatnonzero(high - low != own + size - 1).tolist():
            phrases[k] = b" ".join(filter(None, phrases[k].replace(b"\t", b" ").split(b" ")))
        return [p.replace(b"\t", b" ") for p in phrases] if b"\t" in raw else phrases


_OPENED: dict[str, np.ndarray] = {}


class PhraseMap:
    """A map of phrases for all tasks. It travels compressed, so that a sparse one is small."""

    def __init__(self, spark: SparkSession, bits: np.ndarray) -> None:
        self.name = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1))

    @property
    def value(self) -> np.ndarray:
        """The map, unpacked once for each process; a process keeps the last three."""
        if self.name not in _OPENED:
            while len(_OPENED) > 2:
                _OPENED.pop(next(iter(_OPENED)))
            _OPENED[self.name] = np.frombuffer(zlib.decompress(self.sent.value), np.uint8)
        return _OPENED[self.name]

    def drop(self) -> None:
        self.sent.unpersist()


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    index = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[index >> np.uint64(3)] >> (index & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, in parts of bounded bytes, from as many batches as it takes.

    A language's part is complete with ``TAKEN_BYTES``; the largest goes before where all hold twice that.
    """
    held: dict[str, list[bytes]] = {}
    load: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("raw").to_pylist()):
            held.setdefault(lang, []).append(text)
            load[lang] = load.get(lang, 0) + len(text)
            total += len(text)
            if load[lang] < TAKEN_BYTES:
                if total < 2 * TAKEN_BYTES:
                    continue
                lang = max(load, key=load.get)
            total -= load.pop(lang)
            yield lang, held.pop(lang)
    yield from held.items()


def _rows(words: Words, size: int, hashes: np.ndarray, at: np.ndarray) -> tuple:
    """The phrases among those at ``at``: their hashes, sizes, numbers and words."""
    own, first, times = np.unique(hashes[at], return_index=True, return_counts=True)
    return own, np.full(len(own), size, np.int32), times.astype(np.int64), pa.array(words.text(at[first], size), pa.binary())


def _packed(lang: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a part of a batch, one list for each part that their hashes fall into."""
    hashes, sizes, times = (np.concatenate(c) for c in list(zip(*rows))[:3])
    order = np.argsort(hashes, kind="stable")
    part = (hashes[order] >> np.uint64(64 - COUNT_PART_BITS)).astype(np.int32)
    heads = np.flatnonzero(np.diff(part, prepend=-1))
    edges = pa.array(np.append(heads, len(part)).astype(np.int32))
    phrases = pa.concat_arrays([r[3] for r in rows]).take(pa.array(order))
    lists = [pa.array(sizes[order]), phrases, pa.array(times[order]), pa.array(hashes[order].view(np.int64))]
    columns = [pa.array(part[heads]), pa.array([lang] * len(heads), pa.string())]
    columns += [pa.ListArray.from_arrays(edges, values) for values in lists]
    return pa.RecordBatch.from_arrays(columns, ["part", "lang", *LISTED])


def all_counts(docs: DataFrame) -> DataFrame:
    """Numbers of all phrases of up to ``LONGEST`` words, by part of a batch; for the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _taken(batches):
            words, hashes = Words(texts, lang), None
            for size in range(1, LONGEST + 1):
                hashes = words.phrases(size, hashes)
                own, times = np.unique(hashes[words.whole(size)], return_counts=True)
                yield pa.record_batch(
                    [pa.array(own.view(np.int64)), pa.array(times.astype(np.int64))], ["hash", "n"]
                )

    return docs.mapInArrow(count, "hash LONG, n LONG")


def _bordering(words: Words, proposed, counted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, hashes and places of the phrases that a pass counts.

    These are the proposed phrases and their negative border: all whose parts without the first
    and without the last word are in the map ``proposed``; a single word has no such parts.
    Those that were so by the map ``counted`` too are left out.
    """
    hashes = words.phrases(1, None)
    if counted is None:
        yield 1, hashes, np.arange(len(hashes))
    for size in range(2, LONGEST + 1):
        within = in_map(proposed.value, hashes)
        chosen = within[:-1] & within[1:] & words.whole(size)
        if counted is not None:
            earlier = in_map(counted.value, hashes)
            chosen &= ~(earlier[:-1] & earlier[1:])
        hashes = words.phrases(size, hashes)
        yield size, hashes, np.flatnonzero(chosen)


def bucket_counts(docs: DataFrame, proposed, counted=None) -> DataFrame:
    """Numbers of the phrases of a pass by bucket, packed by part of the map.

    A bucket is a bit of the map; five bytes an entry. Numbers beyond 255 are as 255, which is
    enough for any threshold, since buckets then need no more.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _taken(batches):
            words = Words(texts, lang)
            found = [h[at] >> np.uint64(64 - MAP_BITS) for _, h, at in _bordering(words, proposed, counted)]
            own, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            part = (own >> np.uint64(MAP_BITS - PART_BITS)).astype(np.int32)
            heads = np.flatnonzero(np.diff(part, prepend=-1))
            own, times = own.astype(np.uint32), np.minimum(times, 255).astype(np.uint8)
            edges = np.append(heads, len(own))
            packed = [(own[a:b].tobytes(), times[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
            columns = [pa.array(part[heads])] + [pa.array([p[k] for p in packed], pa.binary()) for k in (0, 1)]
            yield pa.record_batch(columns, ["part", "buckets", "times"])

    return docs.mapInArrow(count, "part INT, buckets BINARY, times BINARY")


def heavy_map(packed: DataFrame, least: int) -> np.ndarray:
    """The map of buckets with at least ``least`` occurrences: 16 MB at any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << (MAP_BITS - PART_BITS)
        current, own = None, np.zeros(size, np.int64)

        def ended() -> pa.RecordBatch:
            bits = np.packbits(own >= min(least, 255), bitorder="little").tobytes()
            columns = [pa.array([current], pa.int32()), pa.array([zlib.compress(bits, 1)], pa.binary())]
            return pa.record_batch(columns, ["part", "bits"])

        # Rows are sorted by part, so that one part at a time is held.
        for batch in batches:
            for part, buckets, times in zip(*(batch.column(k) for k in range(3))):
                if part.as_py() != current:
                    if current is not None:
                        yield ended()
                    current = part.as_py()
                    own[:] = 0
                # A bucket is in a packed list once.
                at = np.frombuffer(buckets.as_py(), np.uint32) & np.uint32(size - 1)
                own[at] += np.frombuffer(times.as_py(), np.uint8)
        if current is not None:
            yield ended()

    spread = packed.repartition("part").sortWithinPartitions("part")
    return _gathered(spread.mapInArrow(add, MAP_SCHEMA))


def _gathered(parts: DataFrame, bits: np.ndarray | None = None) -> np.ndarray:
    whole = np.zeros(1 << (MAP_BITS - 3), np.uint8) if bits is None else bits.copy()
    for row in parts.collect():
        part = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
        whole[row["part"] * len(part) : (row["part"] + 1) * len(part)] |= part
    return whole


def border_counts(docs: DataFrame, proposed, heavy, counted=None) -> DataFrame:
    """Numbers, by part of a batch, of the phrases of a pass whose bucket is in ``heavy``; packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _taken(batches):
            words, found = Words(texts, lang), []
            for size, hashes, at in _bordering(words, proposed, counted):
                at = at[in_map(heavy.value, hashes[at])]
                if len(at):
                    found.append(_rows(words, size, hashes, at))
            if found:
                yield _packed(lang, found)

    return docs.mapInArrow(count, PACKED_SCHEMA)


def _proposed_map(hashes: DataFrame, bits: np.ndarray | None = None) -> np.ndarray:
    """The map with all ``hashes`` set, besides those of ``bits``: 16 MB at any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            numbers = (own >> np.uint64(64 - PART_BITS)).astype(np.int64)
            places = (own >> np.uint64(64 - MAP_BITS)) & np.uint64((1 << (MAP_BITS - PART_BITS)) - 1)
            for number in np.unique(numbers).tolist():
                if number not in parts:
                    parts[number] = np.zeros(1 << (MAP_BITS - PART_BITS - 3), np.uint8)
                place = places[numbers == number]
                bit = (1 << (place & np.uint64(7)).astype(np.int64)).astype(np.uint8)
                np.bitwise_or.at(parts[number], place >> np.uint64(3), bit)
        for number, part in parts.items():
            columns = [pa.array([number], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())]
            yield pa.record_batch(columns, ["part", "bits"])

    # Signed numbers keep their first bits under a shift that fills with zeros.
    number = F.shiftrightunsigned("hash", 64 - PART_BITS)
    spread = hashes.select("hash").repartition(number)
    return _gathered(spread.mapInArrow(add, MAP_SCHEMA), bits)


def _summed(packed: DataFrame, least: int) -> DataFrame:
    """Exact numbers over all parts of batches, of phrases with at least ``least``."""

    def flat(batch: pa.RecordBatch) -> pa.Table:
        # All lists of a row are of one length.
        of = pc.list_parent_indices(batch.column("hash"))
        columns = [batch.column(name).take(of) for name in ("part", "lang")]
        return pa.table([*columns, *(batch.column(name).flatten() for name in LISTED)], names=["part", "lang", *LISTED])

    def total(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        sums = rows.group_by(["lang", "size", "phrase"], use_threads=False).aggregate([("n", "sum"), ("hash", "min")])
        sums = sums.filter(pc.greater_equal(sums.column("n_sum"), least))
        names = ["lang", "size", "phrase", "n_sum", "hash_min"]
        yield from sums.select(names).rename_columns(["lang", *LISTED]).to_batches()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        # Rows are sorted by part, so that one part at a time is held besides a batch.
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = flat(batch) if held is None else pa.concat_tables([held, flat(batch)])
            last = pc.equal(rows.column("part"), batch.column("part")[-1])
            yield from total(rows.filter(pc.invert(last)))
            held = rows.filter(last)
        if held is not None:
            yield from total(held)

    spread = packed.repartition("part").sortWithinPartitions("part")
    return spread.mapInArrow(add, COUNT_SCHEMA).withColumn("phrase", F.col("phrase").cast("string"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, one_in: int = SAMPLED_ONE_IN) -> DataFrame:
    """All phrases of one to ``LONGEST`` words with at least ``least`` occurrences in a language.

    Returns ``lang``, ``size``, ``phrase``, ``n`` and ``words``, the number of all words of the
    language. The sample takes one document in ``one_in`` by a hash of its text, so it is the
    same in any run; it affects the number of passes, not the result. A null text is empty and
    a null language is ``und``; repeated rows count as often as they occur, and other columns
    are ignored.
    """
    spark = docs.sparkSession
    units = docs.select(
        F.coalesce("lang", F.lit(NO_LANG)).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("raw"),
    )
    sample = units.where(F.pmod(F.xxhash64("raw"), F.lit(one_in)) == 0)
    with session_conf(spark, SMALL_BATCHES):
        enough = max(2, int(least / one_in * LOWERED))
        seen = all_counts(sample).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= enough)
        bits, counted, found = _proposed_map(seen), None, None
        del seen
        let_go(spark)
        while True:
            proposed = PhraseMap(spark, bits)
            heavy = PhraseMap(spark, heavy_map(bucket_counts(units, proposed, counted), least))
            let_go(spark)
            rows = _summed(border_counts(units, proposed, heavy, counted), least)
            rows = stage(rows, "phrases")
            found = rows if found is None else found.unionByName(rows)
            outside = rows.where(F.col("size") < LONGEST).mapInArrow(_outside(proposed), "hash LONG")
            grown = _proposed_map(outside, bits)
            heavy.drop()
            if counted is not None:
                counted.drop()
            if np.array_equal(grown, bits):
                break
            bits, counted = grown, proposed
    return found.drop("hash").join(word_totals(units), "lang")


def _outside(proposed):
    """Hashes of rows that the map has not."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("hash").to_numpy()
            yield pa.record_batch([pa.array(own[~in_map(proposed.value, own.view(np.uint64))])], ["hash"])

    return select


def word_totals(units: DataFrame) -> DataFrame:
    """Number of words of every language."""
    word = F.regexp_count(F.col("raw").cast("string"), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    return units.groupBy("lang").agg(F.sum(word).cast("long").alias("words"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, one_in: int = SAMPLED_ONE_IN) -> DataFrame:
    """The ``top`` phrases of two to four words of each language, by their weakest cut.

    A phrase with ``a`` occurrences, cut into two with ``l`` and ``r``, has the score
    ``floor(2000000 a / (l + r))``; its lowest counts, of equal ones that of the first cut. A
    phrase is dropped when a longer frequent phrase that holds it has at least 80 % of its
    occurrences. Ties are ordered by occurrences and the phrase's bytes. See
    :func:`frequent_phrases` for nulls and repeated rows.
    """
    # Single words too are needed as parts.
    known = stage(frequent_phrases(docs, least, one_in), "phrases-all")
    split = F.split("phrase", " ")
    candidates = known.where("size >= 2").withColumn("w", split)

    def joined(first: int, count: F.Column | int) -> F.Column:
        return F.concat_ws(" ", F.slice("w", first, count))

    inner = [(k, n) for n in (2, 3) for k in range(1, LONGEST - n + 2)]
    held = candidates.where("size >= 3").select(
        "lang",
        "n",
        F.explode(
            F.filter(
                F.array(*(F.when(F.col("size") >= F.greatest(F.lit(k + n - 1), F.lit(n + 1)), joined(k, n)) for k, n in inner)),
                lambda p: p.isNotNull(),
            )
        ).alias("phrase"),
    )
    longer = held.groupBy("lang", "phrase").agg(F.max("n").alias("longer_n"))
    wide = "decimal(38,0)"
    fits = F.col("longer_n").cast(wide) * 100 >= F.col("n").cast(wide) * KEPT_PERCENT
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(fits, F.lit(False)))

    cuts = kept.select(
        "lang", "phrase", "size", "n", "words", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    parts = cuts.select(
        "lang", "phrase", "n", "words", "k",
        joined(1, F.col("k")).alias("left"),
        F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("right"),
    )
    numbers = known.select("lang", "phrase", "n")
    for side in ("left", "right"):
        own = numbers.select("lang", F.col("phrase").alias(side), F.col("n").alias(f"{side}_n"))
        parts = parts.join(own, ["lang", side])
    score = F.expr(f"(cast(n AS decimal(30,0)) * {SCALE}BD) div (cast(left_n AS decimal(30,0)) + right_n)")
    scored = parts.withColumn("score", score.cast("long"))
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "left_n", "right_n", "n", "words")).alias("cut")
    )
    flat = weakest.select(
        "lang",
        "phrase",
        F.col("cut.n").alias("a"),
        F.col("cut.left_n").alias("l"),
        F.col("cut.right_n").alias("r"),
        F.col("cut.words").alias("n"),
        F.col("cut.score").alias("score"),
    )
    return ranked(flat, top)


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of ``rows`` in each language, with their ``rank`` from 1.

    Rows are sorted over all tasks, and numbered within a task and language from what the
    tasks before hold of the language, so that no task ranks all rows of a common language.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    spread = rows.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id())
    spread = stage(spread, "phrases-ranked")
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy("lang", "part").agg(F.count("*").alias("here"))
    bases = counts.select("lang", "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("base"))
    at = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    found = spread.withColumn("at", at).join(bases.where(F.col("base") < top), ["lang", "part"])
    return found.withColumn("rank", F.col("base") + F.col("at")).where(F.col("rank") <= top).drop("part", "at", "base")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    found = collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def _grams(size: int) -> str:
    words = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(size))
    return f"""SELECT lang, {size} AS size, {words} AS phrase FROM (
      SELECT lang, w, unnest(range(1, len(w) - {size - 2})) AS i FROM pieces WHERE len(w) >= {size})"""


SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
), cut AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM ({" UNION ALL ".join(_grams(k) for k in (1, 2, 3, 4))})
  GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}
), c AS (
  SELECT * FROM f WHERE size >= 2
), kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c AS b WHERE b.lang = c.lang AND b.size > c.size
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100::HUGEINT * b.a >= {KEPT_PERCENT}::HUGEINT * c.a)
), cuts AS (
  SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w FROM (
    SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT cuts.*, x.a AS l, y.a AS r,
         CAST({SCALE}::HUGEINT * cuts.a // (x.a + y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:k], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT weakest.*, totals.n, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest JOIN totals USING (lang)) WHERE rank <= {TOP}
"""

"""Shared helpers: reading tables, staging results, words, hashes, Arrow batches."""

from __future__ import annotations

import gc
import re
import time

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.session import session_conf, work_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# Words: runs of digits, a-z and everything beyond ASCII, once A-Z is lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = re.compile(WORD)
ANY_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"
ASCII_LOWER = str.maketrans(UPPER, LOWER)

# Whole texts reach Python in small batches where this is set: Spark and Python hold a batch
# several times over, and the rows of a batch are counted without regard to their length.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let_go(spark: SparkSession) -> None:
    """Have the shuffle files of plans that nothing refers to any more removed.

    Frames of Python's that were collected refer to their plans in cycles, which only Python's
    own collection ends. Those of the last plan go only with a second collection of the JVM's,
    a moment after the first.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.3)
    spark._jvm.System.gc()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files survive lost executors, and what later reads them sees one and the
    same result even where the plan before is not deterministic. Shuffle files of the plan
    are of no more use then; Spark removes those of plans that the driver's JVM has collected,
    so it is asked to, rather than leaving them on the executors' disks for the whole job.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    let_go(spark)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, or with underscores added until no column has it, whatever its case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """The fifth of documents that never serve for learning, by the id's CRC."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def words_of(text: str | None) -> list[str]:
    """Normalised words, the same as the native expression of ``WORD``."""
    return WORDS.findall(text.translate(ASCII_LOWER)) if text else []


# A byte of a word is part of a digit, of a-z or of a character beyond ASCII. Words are
# hashed as polynomials of random codes of their bytes, whose base has an inverse.
WORD_BYTES = np.array([chr(b).isdigit() or "a" <= chr(b) <= "z" or b > 0x7F for b in range(256)])
BYTE_CODES = np.random.default_rng(5).integers(1, 2**64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
BYTES_AT_ONCE = 1 << 16


def _powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


UP, DOWN = _powers(BASE, BYTES_AT_ONCE), _powers(pow(BASE, -1, 2**64), BYTES_AT_ONCE)


def hashed_words(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of :func:`words_of`, made without the words."""
    return hashed_texts([text])[0]


def hashed_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and how many words each has.

    Long texts are hashed in blocks of whole words, of about ``BYTES_AT_ONCE`` bytes.
    """
    raws = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    # Bytes have their ASCII letters alone lowered. A newline between texts ends a word.
    raw = np.frombuffer(b"\n".join(raws).lower(), np.uint8)
    edges = np.flatnonzero(np.diff(WORD_BYTES[raw], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    counts = np.diff(np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws])), prepend=0)
    found, low = [np.zeros(0, np.uint64)], 0
    while low < len(starts):
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + BYTES_AT_ONCE, "right")))
        part = raw[base : ends[high - 1]]
        size = len(part)
        up, down = UP[:size], DOWN[:size]
        if size > BYTES_AT_ONCE:  # one long word
            up, down = _powers(BASE, size), DOWN[:1]
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(BYTE_CODES[part] * up, out=total[1:])
        first = starts[low:high] - base
        found.append((total[ends[low:high] - base] - total[first]) * down[first])
        low = high
    return mix64(np.concatenate(found)), counts


def digest(text: Column) -> Column:
    """A 128-bit key of a text, for finding its rows again; null is as empty."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def keep_rows(
    docs: DataFrame, rows: DataFrame, how: str = "left_semi", once: bool = False
) -> DataFrame:
    """The rows of ``docs`` that have, or with ``left_anti`` have not, a row in ``rows``.

    ``rows`` names them by ``doc_id``, which may be null, and ``digest`` of the text. With
    ``once``, one of several rows with the same id and text stays, but all whose text has no
    words, since such rows are no copies of each other.
    """
    key = ["_id", "_none", "_digest"]

    def keyed(df: DataFrame, text_digest: Column) -> DataFrame:
        own = F.col("doc_id").cast("long")
        return df.withColumns(
            {"_id": F.coalesce(own, F.lit(0)), "_none": own.isNull(), "_digest": text_digest}
        )

    named = keyed(rows, F.col("digest")).select(key).distinct()
    kept = keyed(docs, digest(F.col("text"))).join(named, key, how)
    if once:
        # Rows without words are told apart by a number of their own.
        worded = F.coalesce(F.col("text").rlike(ANY_WORD), F.lit(False))
        kept = kept.withColumn("_own", F.when(worded, 0).otherwise(F.monotonically_increasing_id()))
        kept = kept.dropDuplicates([*key, "_own"])
    return kept.select(docs.columns)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of unsigned 64-bit numbers (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes:
    """64-bit hashes of words, kept for the words met most recently.

    The table is emptied when full, which affects speed only.
    """

    def __init__(self, limit: int = 300_000) -> None:
        self.limit = limit
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words, in order; a shorter text is one run."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    return mix64(total)

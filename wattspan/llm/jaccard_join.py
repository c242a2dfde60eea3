"""Similarity join on word n-grams with Bayesian pruning of candidates.

Texts of the same words are one node. Nodes that share a band of MinHash values are linked
to the least of them, and the components of these links hold all candidate pairs. Within a
component MinHash values are compared a few at a time; a pair is dropped once the posterior
probability that it reaches the threshold is below the tolerance, and pairs that
remain are verified on their whole sets of n-grams.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import SMALL_BATCHES, WordHashes, digest, shingle_hashes, stage, table, words_of
from wattspan.llm.graph import components
from wattspan.session import session_conf

SHINGLE = 5
THRESHOLD = 0.8
# A pair at the threshold shares a band but for (1 - 0.8^6)^40, 5 in a million.
BANDS, ROWS = 40, 6
STEP = 24
TOLERANCE = 1e-6
# Members of a component meet in pairs of blocks of about this size.
BLOCK = 128
ROWS_AT_ONCE = 1024
COLUMNS_AT_ONCE = 32_768


def hash_family(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    factors = random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 2**63, count, dtype=np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """16 bits of the least value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), ROWS_AT_ONCE):
        values = shingles[low : low + ROWS_AT_ONCE, None] * factors + terms
        np.minimum(least, values.min(axis=0), out=least)
    return ((least >> np.uint64(24)) & np.uint64(0xFFFF)).astype(np.uint16)


def needed_matches(threshold: float, tolerance: float, total: int, step: int) -> list[tuple[int, int]]:
    """For each number of values compared, the fewest matches with which a pair stays.

    With a uniform prior the posterior of the similarity after ``m`` matches in ``n`` is a
    beta distribution, and it exceeds ``t`` as often as a binomial of ``n + 1`` trials with
    chance ``t`` gives at most ``m``.
    """
    found = []
    for n in [*range(step, total, step), total]:
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append((n, m))
    return found


def prune(
    left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of signatures that stay through all comparisons."""
    matches = (left[:, None, : needed[0][0]] == right[None, :, : needed[0][0]]).sum(axis=2)
    a, b = np.nonzero(matches >= needed[0][1])
    matches, before = matches[a, b], needed[0][0]
    for n, least in needed[1:]:
        matches = matches + (left[a, before:n] == right[b, before:n]).sum(axis=1)
        kept = matches >= least
        a, b, matches, before = a[kept], b[kept], matches[kept], n
    return a, b


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each pair of sets has in common, by products of incidences."""
    values = np.concatenate([*left, *right])
    _, place = np.unique(values, return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    result = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(place, [low, low + COLUMNS_AT_ONCE])
        width = min(COLUMNS_AT_ONCE, int(place[-1]) + 1 - low)
        held = np.zeros((len(left) + len(right), width), np.float32)
        held[owner[a:b], place[a:b] - low] = 1
        result += held[: len(left)] @ held[len(left) :].T
    return result.astype(np.int64)


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row linked to each row through the pairs given."""
    label = np.arange(size)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def text_key(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def _sign(docs: DataFrame, shingle: int, hashes: int) -> DataFrame:
    """One row per document with words: id, digest of the text, key of its words, signature."""
    factors, terms = hash_family(hashes)

    def sign(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hashes = WordHashes()
        last: tuple[bytes, bytes] = (b"", b"")
        for batch in batch_iter:
            keys, signs = [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                if not words:
                    keys.append(None)
                    signs.append(None)
                    continue
                key = text_key(words)
                if key != last[0]:
                    own = signature(shingle_hashes(word_hashes(words), shingle), factors, terms)
                    last = (key, own.tobytes())
                keys.append(key)
                signs.append(last[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                names=["doc_id", "digest", "key", "sign"],
            )

    return docs.mapInArrow(sign, "doc_id long, digest string, key binary, sign binary")


def join_within(threshold: float, shingle: int, bands: int, rows: int, tolerance: float):
    """The function that joins two blocks of a component, or one with itself.

    Returns for each node its links here, counted in documents, and the least node of those
    it is connected with.
    """
    needed = needed_matches(threshold, tolerance, bands * rows, STEP)

    def join(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        copies = group.column("copies").to_numpy()
        block = group.column("block").to_numpy()
        signs = np.frombuffer(b"".join(group.column("sign").to_pylist()), np.uint16).reshape(len(node), -1)
        first = group.column("first")[0].as_py()
        same = first == group.column("second")[0].as_py()
        left = np.flatnonzero(block == first)
        right = left if same else np.flatnonzero(block != first)
        a, b = prune(signs[left], signs[right], needed)
        if same:
            a, b = a[a < b], b[a < b]
        links = np.zeros(len(node), np.int64)
        label = np.arange(len(node))
        if len(a):
            hashes, texts = WordHashes(), group.column("text")

            def sets(chosen: np.ndarray) -> list[np.ndarray]:
                return [np.unique(shingle_hashes(hashes(words_of(texts[int(i)].as_py())), shingle)) for i in chosen]

            rows_a, at_a = np.unique(a, return_inverse=True)
            rows_b, at_b = np.unique(b, return_inverse=True)
            sets_a, sets_b = sets(left[rows_a]), sets(right[rows_b])
            common = common_counts(sets_a, sets_b)[at_a, at_b]
            size_a = np.array([len(s) for s in sets_a])[at_a]
            size_b = np.array([len(s) for s in sets_b])[at_b]
            # Whole numbers, so that a similarity of exactly the threshold counts.
            near = common * 1_000_000 >= round(threshold * 1_000_000) * (size_a + size_b - common)
            x, y = left[a[near]], right[b[near]]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            # Nodes are in ascending order, so the least row is the least node.
            label = forest(len(node), x, y)
        some = links > 0
        return pa.table(
            {"node": node[some], "links": links[some], "least": node[label][some]},
        )

    return lambda group: join(group.sort_by("node"))


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``doc_id``, ``class_id``, ``n_links``, ``is_first`` and ``digest`` for each row of ``docs``.

    Two documents are linked when the sets of their word ``shingle``-grams have a Jaccard
    similarity of at least ``threshold``; a shorter text is one gram of all its words.
    ``n_links`` counts the other documents linked to a row, copies included. A class is a
    component of links, and ``class_id`` the least id in it; ``is_first`` marks one row of
    the class, which has that id. A text without words, or null, is linked to nothing and a
    class of its own. Null ids count as greater than others. ``docs`` needs ``doc_id`` and
    ``text``; other columns are ignored. ``digest`` is that of :func:`common.digest`.
    """
    chosen = docs.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), "text")
    signed = _sign(chosen, shingle, bands * rows)
    with session_conf(docs.sparkSession, SMALL_BATCHES):
        signed = stage(signed.withColumn("row", F.monotonically_increasing_id()), "join-signatures")
    worded = signed.where("key IS NOT NULL")
    # doc_id is nullable; its order has null last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "digest")
    nodes = worded.groupBy("key").agg(
        F.count("*").alias("copies"), F.min(order).alias("least"), F.first("sign").alias("sign")
    )
    nodes = nodes.select(
        F.monotonically_increasing_id().alias("node"), "key", "copies", "least", "sign"
    )
    nodes = stage(nodes, "join-nodes")

    width = 2 * rows
    band = [F.xxhash64(F.lit(k), F.substring("sign", width * k + 1, width)) for k in range(bands)]
    banded = nodes.select("node", F.explode(F.array(*band)).alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n"))
    linked = banded.join(shared.where("n > 1").drop("n"), "band")
    near = components(linked.where("node <> first").select("node", "first"), "node", "first", "join-candidates")

    members = near.unionByName(near.select(F.col("root").alias("node"), "root").distinct())
    sizes = near.groupBy("root").agg(F.ceil((F.count("*") + 1) / BLOCK).alias("blocks"))
    members = members.join(sizes, "root").join(nodes.drop("key"), "node")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    texts = chosen.withColumn("none", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    wanted = members.select(
        "node", "root", "blocks", "block", "copies", "sign",
        F.coalesce("least.doc_id", F.lit(0)).alias("doc_id"), "least.none", "least.digest",
    )
    # Repeated rows of a document give the same text again, which the join within drops.
    found = texts.join(wanted, ["doc_id", "none", "digest"]).drop("doc_id", "none", "digest")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    paired = found.withColumn("other", other).select(
        "root", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        "node", "copies", "sign", "block", "text",
    )
    joined = (
        paired.dropDuplicates(["root", "first", "second", "node"])
        .groupBy("root", "first", "second")
        .applyInArrow(join_within(threshold, shingle, bands, rows, tolerance), "node long, links long, least long")
    )
    joined = stage(joined, "join-links")
    links = joined.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(joined.select("node", "least"), "node", "least", "join-classes")

    known = (
        nodes.select("node", "key", "copies", "least")
        .join(links, "node", "left")
        .join(classes, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    heads = known.groupBy("root").agg(F.min("least").alias("head"))
    known = known.join(heads, "root").select(
        "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "head"
    )
    return signed.drop("sign").join(known, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("key").isNull() | (F.col("head.row") == F.col("row"))).alias("is_first"),
        "digest",
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``documents``: five-word grams, similarity 0.8 or more."""
    return jaccard_join(table(spark, sf_dir, "documents")).drop("digest")

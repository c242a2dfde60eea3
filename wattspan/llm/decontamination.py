"""Benchmark decontamination: token windows of documents looked up in a hash set.

The n-grams of the benchmark, normalised, go to all executors as a set of hashes; every
window of every document is tested against it, and windows that hit are verified by their
words. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattspan.llm.common import LOWER, UPPER, WORD, digest, stage, table

WINDOW = 10
# A set of hashes travels in the plan up to this many; a larger benchmark is joined.
SET_LIMIT = 200_000
# Windows of the benchmark with their words are broadcast up to this many.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    """Runs of digits, a-z (after lowering A-Z) and characters beyond ASCII, in order."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct ``item_id``, ``size``, ``gram`` of every item.

    An item of fewer words than ``window`` but not none is one window of that size; one
    without words has none. Item ids are strings here, and may be null.
    """
    split = items.select(F.col("item_id").cast("string"), words(F.col("text")).alias("w"))
    split = split.where("size(w) > 0")
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    return (
        split.select("item_id", size.alias("size"), "w", F.explode(starts).alias("at"))
        .select("item_id", "size", F.concat_ws(" ", F.slice("w", F.col("at"), F.col("size"))).alias("gram"))
        .distinct()
    )


def _grams(size: int) -> str:
    """SQL for the hashes of all windows of ``size`` words of ``w``, by start from 1."""
    return (
        f"IF(size(w) < {size}, array(), transform(sequence(1, size(w) - {size - 1}),"
        f" i -> xxhash64(slice(w, i, {size}))))"
    )


def _hits(split: DataFrame, grams: DataFrame, sizes: list[int], count: int) -> DataFrame:
    """``split`` with ``hits``: start and size of the windows whose hash is in the set."""
    empty = "CAST(array() AS array<struct<at:int,size:int>>)"
    parts = []
    if count <= SET_LIMIT:
        hashed = grams.selectExpr("size", "xxhash64(split(gram, ' ')) AS h").distinct()
        known: dict[int, list[int]] = {}
        for row in hashed.collect():
            known.setdefault(row["size"], []).append(row["h"])
        for size, members in known.items():
            listed = ",".join(f"{m}L" if m != -(2**63) else "-9223372036854775807L-1L" for m in members)
            parts.append(
                f"IF(size(w) < {size}, {empty}, transform(filter(sequence(1, greatest(1, size(w) - {size - 1})),"
                f" i -> xxhash64(slice(w, i, {size})) IN ({listed})),"
                f" i -> named_struct('at', i, 'size', {size})))"
            )
        return split.withColumn("hits", F.expr(f"concat({', '.join(parts)})" if parts else empty))
    keyed = split.withColumn("row", F.monotonically_increasing_id())
    keyed = stage(keyed, "decontamination-words")
    hashed = grams.selectExpr("size", "xxhash64(split(gram, ' ')) AS h").distinct()
    found = None
    for size in sizes:
        windows = keyed.select("row", F.posexplode(F.expr(_grams(size))).alias("at", "h"))
        hit = windows.join(hashed.where(F.col("size") == size), "h", "left_semi")
        hit = hit.select("row", F.struct((F.col("at") + 1).cast("int").alias("at"), F.lit(size).alias("size")).alias("x"))
        found = hit if found is None else found.unionByName(hit)
    listed = found.groupBy("row").agg(F.collect_list("x").alias("hits"))
    return keyed.join(listed, "row", "left").withColumn(
        "hits", F.coalesce("hits", F.expr(empty))
    ).drop("row")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``digest``, ``n_words``, ``spans`` and ``items`` of every row of ``docs``.

    ``spans`` are the verified windows (first word from 0, words), ``items`` the ids of the
    items found, in order as strings; an item without an id has spans but is not named. A null or empty text has no words. Repeated rows and
    null ids stay; other columns are ignored. The scan stores, for each document, only the
    windows that hit the set, which are then verified by their words and grouped.
    """
    grams = stage(benchmark_windows(items, window), "benchmark-windows")
    sizes = [r["size"] for r in grams.select("size").distinct().limit(window + 1).collect()]
    count = grams.count()
    split = docs.select(
        F.col("doc_id").cast("long"),
        digest(F.col("text")).alias("digest"),
        F.coalesce(words(F.col("text")), F.expr("CAST(array() AS array<string>)")).alias("w"),
    )
    hit = _hits(split, grams, sizes, count).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "digest",
        F.size("w").cast("long").alias("n_words"),
        F.expr("transform(hits, x -> named_struct('at', x.at - 1, 'size', x.size, 'gram', concat_ws(' ', slice(w, x.at, x.size))))").alias("hits"),
    )
    scanned = stage(hit, "decontamination-hits")
    if count <= BROADCAST_WINDOWS:
        grams = F.broadcast(grams)
    no_spans = F.expr("CAST(array() AS array<struct<at:int,size:int>>)")
    no_items = F.expr("CAST(array() AS array<string>)")
    clean = scanned.where("size(hits) = 0").select(
        "doc_id", "digest", "n_words", no_spans.alias("spans"), no_items.alias("items")
    )
    rows = scanned.where("size(hits) > 0").withColumn("hit", F.explode("hits"))
    rows = rows.select("row", "doc_id", "digest", "n_words", "hit.at", "hit.size", "hit.gram")
    known = grams.select("gram", "item_id", F.lit(True).alias("known"))
    verified = rows.join(known, "gram", "left")
    span = F.when(F.col("known"), F.struct("at", "size"))
    dirty = verified.groupBy("row", "doc_id", "digest", "n_words").agg(
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    return clean.unionByName(dirty.drop("row"))


def hit_words(spans: Column) -> Column:
    """The number of words inside any span."""
    positions = F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1)))
    return F.size(F.array_distinct(positions)).cast("long")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every one of ``documents``."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


SQL = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}') AS w
    FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
    FROM item_words, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
doc_words AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}'), []) AS w
    FROM documents),
windows AS (
    SELECT r, s.size, i, array_to_string(w[i : i + s.size - 1], ' ') AS gram
    FROM doc_words, (SELECT DISTINCT size FROM grams) s, unnest(range(1, len(w) - s.size + 2)) AS u(i)),
hits AS (SELECT r, i, w.size, item_id FROM windows w JOIN grams g USING (gram)),
covered AS (SELECT r, count(DISTINCT p) AS n FROM hits, unnest(range(i, i + size)) AS u(p) GROUP BY r),
found AS (
    SELECT r, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
    FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(f.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(c.n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered c USING (r) LEFT JOIN found f USING (r)
""".replace("{word}", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

"""Approximate nearest neighbours by inner product with an adaptive scan of dimensions.

Vectors are filed under the nearest of a set of centroids. A query probes the lists of its
nearest centroids; there, rotated vectors are read in blocks of columns, and a candidate is
abandoned as soon as a hypothesis test on its partial product says that it will not reach
the query's best so far. Survivors are scored exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattspan.llm.common import stage, table

# Centroids are fitted on at most about this many vectors.
SAMPLE = 16_384
MAX_LISTS = 1_024
LISTS_PER_ROOT = 2.5
COLUMN_BLOCK = 16
# Deviations of the test: it abandons a true neighbour about once in 200 times.
SIGNIFICANCE = 2.6
# Vectors and queries meet in blocks of about these sizes.
VECTOR_BLOCK, QUERY_BLOCK = 4_096, 2_048
QUERIES_AT_ONCE = 128


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthonormal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, count: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centroids of the directions in ``sample`` (spherical k-means)."""
    points = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    random = np.random.default_rng(seed)
    centers = points[random.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(points @ centers.T, axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1)
        filled = norms > 0
        centers[filled] = sums[filled] / norms[filled, None]
    return centers


def adaptive_scan(
    own: np.ndarray, turned: np.ndarray, bar: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rotated queries and vectors that may have a product of ``bar`` or more.

    In a random rotation all columns are alike: ``d`` of ``D`` columns hold ``d / D`` of a
    product on average, with a variance of about ``d (D - d) / D^3`` of the squared norms.
    A pair is abandoned when its partial product lies ``SIGNIFICANCE`` deviations below
    what a product at the bar would have shown.
    """
    dim = turned.shape[1]
    own_norms, norms = np.linalg.norm(own, axis=1), np.linalg.norm(turned, axis=1)
    edges = [*range(0, dim, COLUMN_BLOCK), dim]

    def slack(end: int) -> float:
        return SIGNIFICANCE * math.sqrt(end * (dim - end) / dim**3)

    partial = own[:, : edges[1]] @ turned[:, : edges[1]].T
    reach = partial + slack(edges[1]) * np.outer(own_norms, norms)
    q, x = np.nonzero(reach >= bar[:, None] * (edges[1] / dim))
    total = partial[q, x]
    for a, b in zip(edges[1:], edges[2:]):
        total = total + np.einsum("nd,nd->n", own[q, a:b], turned[x, a:b])
        alive = total + slack(b) * own_norms[q] * norms[x] >= bar[q] * (b / dim)
        q, x, total = q[alive], x[alive], total[alive]
    return q, x


def scan_lists(
    queries: np.ndarray, probed: np.ndarray, vectors: np.ndarray, lists: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query rows, vector rows and exact products of at least each query's ``k`` best.

    ``probed`` has the lists that each query visits, ``lists`` that of each vector. The
    bar of a query is the ``k``-th best product that it has met so far.
    """
    turn = rotation(vectors.shape[1])
    order = np.argsort(lists, kind="stable")
    names, starts = np.unique(lists[order], return_index=True)
    ends = [*starts[1:].tolist(), len(order)]
    turned = vectors @ turn
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        chosen = queries[low : low + QUERIES_AT_ONCE]
        own, visits = chosen @ turn, probed[low : low + QUERIES_AT_ONCE]
        # Products are compared with a margin for rounding.
        margin = 1e-9 * np.linalg.norm(chosen, axis=1) * np.linalg.norm(vectors, axis=1).max()
        top = np.full((len(chosen), k), -np.inf)
        found = []
        for name, start, end in zip(names, starts, ends):
            asking = np.flatnonzero((visits == name).any(axis=1))
            if len(asking):
                rows = order[start:end]
                bar = top[asking].min(axis=1) - margin[asking]
                q, x = adaptive_scan(own[asking], turned[rows], bar)
                exact = np.einsum("nd,nd->n", chosen[asking[q]], vectors[rows[x]])
                found.append((asking[q], rows[x], exact))
                met = np.full((len(asking), k + len(rows)), -np.inf)
                met[:, :k] = top[asking]
                met[q, k + x] = exact
                top[asking] = np.partition(met, -k, axis=1)[:, -k:]
        if found:
            q, x, exact = map(np.concatenate, zip(*found))
            kept = exact >= top.min(axis=1)[q]
            yield low + q[kept], x[kept], exact[kept]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct ``vec_id``, ``embedding`` of rows that can take part.

    Null ids, null or zero vectors, those with null or non-finite components and those
    whose length is not the commonest are left out.
    """
    bad = "x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')"
    sound = vectors.select(F.col("vec_id").cast("long"), "embedding").where(
        f"vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding, {bad})"
        " AND exists(embedding, x -> x <> 0)"
    )
    common = sound.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d")
    first = common.first()
    return sound.where(F.size("embedding") == (first["d"] if first else 0)).distinct()


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    lists: int | None = None,
    probes: float = 0.65,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's ``k`` largest products.

    Both tables hold ``vec_id`` and ``embedding`` from :func:`valid_vectors`. A query's own
    id is no candidate; ties go to the smaller id. Equal vectors are searched once, as
    one entry with its ``k + 1`` smallest ids, which is all that a result can show. The number
    of lists follows the square root of that of vectors unless ``lists`` is given;
    ``probes`` is the share of them that a query visits, or more where as many of the smallest
    lists would not hold ``k`` entries besides its own.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType.simpleString()
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    entries = (
        vectors.withColumn("nth", nth).where(F.col("nth") <= k + 1)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = stage(entries, "vector-entries")
    total = entries.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    share = max(1, total // SAMPLE)
    sampled = entries.where(F.pmod(F.xxhash64("embedding"), F.lit(share)) == 0)
    arrow = sampled.select("embedding").limit(2 * SAMPLE).toArrow()
    if not arrow.num_rows:
        arrow = entries.select("embedding").limit(SAMPLE).toArrow()
    dim = len(arrow.column(0)[0])
    wanted = lists or min(MAX_LISTS, max(1, round(LISTS_PER_ROOT * math.sqrt(total))))
    centers = centroids(_matrix(arrow.column(0), dim), wanted)

    def visits(matrix: np.ndarray) -> np.ndarray:
        return np.argpartition(matrix @ centers.T, -visited, axis=1)[:, -visited:]

    def assign(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            near = np.argmax(_matrix(batch.column(0), dim) @ centers.T, axis=1)
            columns = [pa.array(near.astype(np.int32)), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["list", "embedding", "ids"])

    filed = stage(entries.mapInArrow(assign, f"list int, embedding {kind}, ids array<long>"), "vector-lists")
    # Lists are put together into bins, and large ones are dealt over several.
    bins = max(1, math.ceil(total / VECTOR_BLOCK))
    blocks = np.ones(len(centers), np.int64)
    sizes = np.zeros(len(centers), np.int64)
    for row in filed.groupBy("list").count().collect():  # one row per list
        sizes[row["list"]] = row["count"]
        blocks[row["list"]] = min(bins, math.ceil(row["count"] / VECTOR_BLOCK))
    enough = int(np.searchsorted(np.cumsum(np.sort(sizes)), min(total, k + 1))) + 1
    visited = max(1, min(len(centers), max(enough, math.ceil(probes * len(centers)))))
    asked = queries.select("embedding").distinct().withColumn("query", F.monotonically_increasing_id())
    asked = stage(asked, "vector-queries")
    query_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))

    def route(batch_iter: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_iter:
            if batch.num_rows:
                near = visits(_matrix(batch.column(1), dim))
                row = np.arange(batch.num_rows)[:, None] * bins
                keys = [
                    (row + (near + b) % bins)[blocks[near] > b] for b in range(int(blocks.max()))
                ]
                row, target = np.divmod(np.unique(np.concatenate(keys)), bins)
                columns = [batch.column(0).take(row), pa.array(target), batch.column(1).take(row)]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "bin", "embedding"])

    own_blocks = F.element_at(F.lit(blocks.tolist()), F.col("list") + 1)
    each = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    left = filed.select(
        F.pmod(F.col("list") + F.pmod(F.xxhash64("embedding"), own_blocks), F.lit(bins)).alias("bin"),
        each.alias("query_block"), "list", "embedding", "ids",
    )
    right = (
        asked.select("query", "embedding")
        .mapInArrow(route, f"query long, bin long, embedding {kind}")
        .withColumn("query_block", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int"))
    )

    def meet(entry: pa.Table, asking: pa.Table) -> pa.Table:
        rows, ids, scores = [], [], []
        if entry.num_rows and asking.num_rows:
            own = asking.column("query").to_numpy()
            lists_of = entry.column("ids").combine_chunks()
            matrix = _matrix(asking.column("embedding"), dim)
            found = scan_lists(
                matrix, visits(matrix), _matrix(entry.column("embedding"), dim),
                entry.column("list").to_numpy(), k + 1,
            )
            for q, x, exact in found:
                rows.append(pa.array(own[q]))
                ids.append(lists_of.take(pa.array(x)))
                scores.append(pa.array(exact))
        fields = [pa.field("query", pa.int64()), pa.field("ids", pa.list_(pa.int64())), pa.field("score", pa.float64())]
        columns = [pa.chunked_array(c, f.type) for c, f in zip((rows, ids, scores), fields)]
        return pa.Table.from_arrays(columns, schema=pa.schema(fields))

    met = left.groupBy("bin", "query_block").cogroup(right.groupBy("bin", "query_block")).applyInArrow(
        meet, "query long, ids array<long>, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = (
        met.select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    )
    named = queries.select(F.col("vec_id").alias("query_id"), "embedding").join(asked, "embedding")
    final = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        named.select("query_id", "query").join(top, "query")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all ``embeddings`` for those whose id is divisible by 20."""
    vectors = stage(valid_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))

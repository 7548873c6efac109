"""Exact top-k inner products: vectors by descending length, pruned by Cauchy-Schwarz bounds.

Vectors are cut into blocks by descending length. Rotated onto the singular vectors, a short head
carries most of an inner product, and head sum + product of the tail lengths bounds the whole.
Only pairs whose bound reaches the query's k-th best score so far are computed in integers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import stage

#: Rows of a candidate block and of a query block: what one task holds at a time.
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
#: The rotation is fitted on at most so many vectors; it changes the speed, never the result.
FIT_ROWS = 10_000
#: Candidates compared at once inside a block, and the share of dimensions in the head.
STEP = 512
HEAD_SHARE = 0.25


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id``, ``v`` (integers floor(scale * x)) and ``norm`` of every usable row.

    Without id, without vector, or with a null or non-finite component a row takes no part.
    Shorter vectors count as padded with zeros.
    """
    finite = F.forall(
        vector_column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)),
    )
    return (
        vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & finite)
        .select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.transform(vector_column, lambda x: F.floor(scale * x.cast("double"))).alias("v"),
        )
        .withColumn(
            "norm",
            F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)),
        )
    )


def rotation(rows: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors, strongest first, of at most ``FIT_ROWS`` vectors."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(FIT_ROWS).toArrow()
    matrix = _matrix(sample["v"], dims).astype("float64")
    _, axes = np.linalg.eigh(matrix.T @ matrix)
    return axes[:, ::-1]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    out = np.zeros((len(lists), dims), dtype="int64")
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _best(owner, score, candidate, k):
    """Indices of the k best entries of each owner, ties to the smaller candidate."""
    order = np.lexsort((candidate, -score, owner))
    sorted_owner = owner[order]
    first = np.flatnonzero(np.r_[True, sorted_owner[1:] != sorted_owner[:-1]])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank < k]


def _searcher(axes: np.ndarray, dims: int, k: int):
    head = max(1, math.ceil(dims * HEAD_SHARE)) if dims else 0

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], "int64") for n in ("query_id", "vec_id", "score")})
        c_norm = candidates["norm"].to_numpy()
        by_length = np.argsort(-c_norm, kind="stable")
        c_norm = c_norm[by_length]
        c_id = candidates["vec_id"].to_numpy()[by_length]
        c = _matrix(candidates["v"], dims)[by_length]
        q_id, q_norm = queries["q_id"].to_numpy(), queries["q_norm"].to_numpy()
        q = _matrix(queries["q_v"], dims)
        floor = queries["floor"].to_numpy().astype("float64").copy()
        c_turned, q_turned = c @ axes, q @ axes
        c_tail = np.linalg.norm(c_turned[:, head:], axis=1)
        q_tail = np.linalg.norm(q_turned[:, head:], axis=1)
        # What rounding in the rotated sums can take away from a bound, with room to spare.
        slack = 1e-6 + 1e-9 * q_norm
        owner = np.empty(0, "int64")
        score, found = np.empty(0, "int64"), np.empty(0, "int64")
        for low in range(0, len(c), STEP):
            part = slice(low, low + STEP)
            live = np.flatnonzero((q_norm + slack) * (c_norm[low] + 1e-6) >= floor)
            if not len(live):
                break
            bound = q_turned[live, :head] @ c_turned[part, :head].T
            bound += q_tail[live, None] * c_tail[None, part]
            bound += slack[live, None] * (1 + c_norm[None, part])
            a, b = np.nonzero(bound >= floor[live, None])
            a, b = live[a], b + low
            other = q_id[a] != c_id[b]
            a, b = a[other], b[other]
            exact = np.empty(len(a), "int64")
            for i in range(0, len(a), 1 << 16):
                j = slice(i, i + (1 << 16))
                exact[j] = (q[a[j]] * c[b[j]]).sum(axis=1)
            owner, score, found = np.r_[owner, a], np.r_[score, exact], np.r_[found, c_id[b]]
            keep = _best(owner, score, found, k)
            owner, score, found = owner[keep], score[keep], found[keep]
            full = np.bincount(owner, minlength=len(q)) >= k
            worst = np.full(len(q), np.iinfo("int64").max)
            np.minimum.at(worst, owner, score)
            floor[full] = np.maximum(floor[full], worst[full])
        return pa.table({"query_id": q_id[owner], "vec_id": found, "score": score})

    return search


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k highest integer inner products.

    ``is_query`` is a condition on ``vec_id``, which is a key. Ties go to the smaller id; a query
    is never its own candidate; with fewer candidates all are returned. A first pass over the block
    of the longest vectors gives each query a score to beat; queries sorted by that score per unit
    length then meet only the blocks that are long enough, one pair of blocks per group.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score long"
    usable = quantized(vectors, id_column, vector_column, scale)
    size = usable.agg(
        F.count("*").alias("n"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dims"),
        F.count(F.when(is_query, 1)).alias("n_queries"),
    ).first()
    if not size.n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    search = _searcher(rotation(usable, size.dims), size.dims, k)

    blocks = stage(
        usable.repartitionByRange(
            max(1, math.ceil(size.n / BLOCK_ROWS)), F.desc("norm"), "vec_id"
        ).withColumn("block", F.spark_partition_id()),
        "vector-blocks",
    )
    longest = {
        r.block: r.norm for r in blocks.groupBy("block").agg(F.max("norm").alias("norm")).collect()
    }  # one number per block
    order = sorted(longest)
    n_chunks = max(1, math.ceil(size.n_queries / QUERY_ROWS))
    chunk = F.pmod(F.xxhash64("q_id"), F.lit(n_chunks)).cast("int")

    # A score to beat: the k-th best among the longest vectors.
    head = blocks.where(F.col("block") == order[0]).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    )
    # Own column names: the two sides of a cogroup must not share attributes.
    asked = blocks.where(is_query).select(
        F.col("vec_id").alias("q_id"), F.col("v").alias("q_v"), F.col("norm").alias("q_norm")
    )
    first = (
        head.groupBy("chunk")
        .cogroup(
            asked.withColumns({"q_chunk": chunk, "floor": F.lit(-math.inf)}).groupBy("q_chunk")
        )
        .applyInArrow(search, schema)
        .groupBy("query_id")
        .agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        .where(F.col("n") >= k)
    )
    asked = (
        asked.join(first, F.col("q_id") == F.col("query_id"), "left")
        .select(
            "q_id",
            "q_v",
            "q_norm",
            F.coalesce(F.col("worst").cast("double"), F.lit(-math.inf)).alias("floor"),
        )
        .withColumn(
            "reach", F.when(F.col("q_norm") > 0, F.col("floor") / F.col("q_norm")).otherwise(-math.inf)
        )
    )
    asked = stage(
        asked.repartitionByRange(n_chunks, "reach", "q_id").withColumn("chunk", F.spark_partition_id()),
        "query-blocks",
    )
    reach = {
        r.chunk: r.reach for r in asked.groupBy("chunk").agg(F.min("reach").alias("reach")).collect()
    }
    # A block is needed if its longest vector can reach what its easiest query must beat.
    needed = {
        b: [c for c in sorted(reach) if longest[b] + 1e-6 + 1e-9 * longest[b] >= reach[c]] for b in order
    }
    pairs = spark.createDataFrame(
        [(b, c) for b in order for c in needed[b]], "pair_block int, pair_chunk int"
    )
    left = blocks.join(F.broadcast(pairs), F.col("block") == F.col("pair_block")).select(
        "vec_id", "v", "norm", "pair_block", "pair_chunk"
    )
    right = asked.join(F.broadcast(pairs), F.col("chunk") == F.col("pair_chunk")).select(
        "q_id",
        "q_v",
        "q_norm",
        "floor",
        F.col("pair_block").alias("q_block"),
        F.col("pair_chunk").alias("q_chunk"),
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        left.groupBy("pair_block", "pair_chunk")
        .cogroup(right.groupBy("q_block", "q_chunk"))
        .applyInArrow(search, schema)
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op9_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The five best inner products of every query vector against all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

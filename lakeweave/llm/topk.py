"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Candidates are blocks of postings: for each term (dimension), the rows of the block that hold it and
their integer weights. A query row is sparse: its non-zero terms and weights. For each of its terms the
query adds weight x posting to a dense array with a score for each candidate of the block; a partition
selection keeps the block's k best, and the blocks' lists are merged by query.

Both sides are cut into blocks of bounded size, queries are sent to each block of candidates, and a
group holds one block of each, so memory doesn't grow with the input. Every query meets every candidate;
nothing is pruned.

Cases: vectors that are null, or hold null, NaN or infinite components, take no part on either side.
Finite components of any size take part: rows whose sums of products could leave int64 are
summed in Python's integers, and a score among a query's k best that doesn't fit the result's 64 bits raises
an error rather than being wrong or left out. Vectors may differ in length; missing components are 0. Null ids take no part. Rows that repeat an id
are candidates each; a query never gets rows of its own id. Ties go to the smaller id. Empty tables give
no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm.common import shuffle_width, written

BLOCK_ROWS = 8192
FOUND = "query_id long, vec_id long, score long, over boolean"


def finite(vector: Column) -> Column:
    """The vector as doubles; null unless all components are finite numbers."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    return F.when(F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), wide)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists of doubles as a dense matrix, shorter ones filled up with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def quantise(rows: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as int64, and the rows too large for a sum of products within int64 (left 0 there)."""
    with np.errstate(over="ignore"):
        q = np.floor(rows * float(scale))
    most = math.isqrt((2**63 - 1) // max(1, rows.shape[1]))
    large = (np.abs(q) > min(most, 2**52)).any(axis=1)
    q[large] = 0
    return q.astype(np.int64), large


def whole(row: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of a row as Python's integers, of any size."""
    return [math.floor(x * scale) if math.isfinite(x * scale) else math.floor(x) * scale for x in row.tolist()]


def accumulate(queries: np.ndarray, candidates: np.ndarray):
    """Dense scores for each query row, term at a time. Yields int64 arrays of len(candidates)."""
    postings = []
    for term in range(candidates.shape[1]):
        rows = np.flatnonzero(candidates[:, term])
        weights = candidates[rows, term]
        postings.append((None if len(rows) == len(candidates) else rows, np.ascontiguousarray(weights)))
    for query in queries:
        scores = np.zeros(len(candidates), np.int64)
        for term in np.flatnonzero(query[: len(postings)]):
            rows, weights = postings[term]
            if rows is None:
                scores += weights * query[term]
            else:
                scores[rows] += weights * query[term]
        yield scores


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id: a partition selection, then a sort of few."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over, level = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        if len(level) > (need := k - len(over)):
            level = level[np.argpartition(ids[level], need - 1)[:need]]
        chosen = np.concatenate((over, level))
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))]


def best_of_large(ids: np.ndarray, scores: list[int], k: int) -> tuple[list[int], list[int], list[bool]]:
    """As ``best_of`` for scores of any size: places, scores held within int64, and whether they had to be."""
    chosen = heapq.nsmallest(k, range(len(ids)), key=lambda i: (-scores[i], ids[i]))
    held = [max(-(2**63 - 1), min(2**63 - 1, scores[i])) for i in chosen]
    return chosen, held, [scores[i] != h for i, h in zip(chosen, held, strict=True)]


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """For each row of vectors (vec_id, embedding) that is_query holds for, its k best other rows."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), finite(F.col("embedding")).alias("q"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("q").isNotNull())
    rows = written(spark, rows.withColumn("h", F.xxhash64("vec_id", "q") % 2147483647 + 2147483647), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("m")).first()
    across = max(1, -(-sizes.n // BLOCK_ROWS), min(sizes.n // 512, spark.sparkContext.defaultParallelism))
    down = max(1, -(-sizes.m // BLOCK_ROWS))
    right = rows.select("vec_id", "q", (F.col("h") % across).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("r"))
    left = rows.where("asks").select("vec_id", "q", (F.col("h") % down).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("c"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": [], "over": []}
        if left.num_rows and right.num_rows:
            asks, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            asked, held = _matrix(left["q"].combine_chunks()), _matrix(right["q"].combine_chunks())
            (queries, large_query), (candidates, large) = quantise(asked, scale), quantise(held, scale)
            every, width = np.arange(len(ids)), min(asked.shape[1], held.shape[1])
            exact = {int(j): whole(held[j, :width], scale) for j in (np.arange(len(held)) if large_query.any() else np.flatnonzero(large))}
            for i, scores in enumerate(accumulate(queries, candidates)):
                others = np.flatnonzero(~own) if (own := ids == asks[i]).any() else every
                if large_query[i] or exact:
                    mine = whole(asked[i, :width], scale)
                    redo = exact if large_query[i] else {j: exact[j] for j in np.flatnonzero(large).tolist()}
                    all_scores = scores.tolist()
                    for j, theirs in redo.items():
                        all_scores[j] = sum(x * y for x, y in zip(mine, theirs, strict=True))
                    chosen, best, over = best_of_large(ids[others], [all_scores[j] for j in others.tolist()], k)
                else:
                    here, found = (ids, scores) if others is every else (ids[others], scores[others])
                    chosen = best_of(here, found, k)
                    best, over = found[chosen], [False] * len(chosen)
                out["query_id"].append(np.full(len(chosen), asks[i]))
                out["vec_id"].append(ids[others[chosen]])
                out["score"].append(np.array(best, np.int64))
                out["over"].append(np.array(over, bool))
        kinds = {name: np.int64 for name in out} | {"over": bool}
        return pa.table({name: np.concatenate([np.zeros(0, kinds[name]), *parts]).astype(kinds[name]) for name, parts in out.items()})

    found = left.groupBy("c", "r").cogroup(right.groupBy("c", "r")).applyInArrow(search, FOUND)
    # The blocks' lists meet by query: at most k rows from each block.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id", "over")))
    merged = found.repartition(shuffle_width(spark), "query_id").groupBy("query_id").agg(F.slice(ordered, 1, k).alias("best"))
    fits = F.when(F.col("b.over"), F.raise_error(F.lit("a score among the best is outside 64-bit integers")).cast("long")).otherwise(-F.col("b.neg"))
    return merged.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), fits.alias("score"))

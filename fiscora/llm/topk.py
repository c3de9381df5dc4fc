"""Exact top-k inner products by a three-phase uniform threshold.

The score of a vector for a query is a sum over ``m`` segments of the dimensions; each
segment is one list of local scores. Vectors and queries are dealt into blocks, and a
task holds one block of each.

1. Every block takes the first entries of each of its ``m`` local score lists, adds them
   up to full scores, and sends the ``k`` best per query. The k-th best of all blocks is a
   score that at least ``k`` vectors reach: a safe cutoff.
2. The cutoff goes out with the queries. A vector can reach it only if one of its local
   scores reaches cutoff / m, so each block collects the entries at or above that uniform
   threshold; an entry below it counts as the threshold itself, which gives an upper
   bound, and vectors whose bound stays under the cutoff fall out.
3. The scores of what remains are resolved exactly, and those that reach the cutoff are
   ranked.

All scores are whole numbers and no candidate is left out for its rank, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, partitions

SCALE = 256
SEGMENTS = 8
VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024
STEP = 32  # queries multiplied at once inside a task
EXACT = 2**53
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``v``: components as floor(scale * x). See ``top_k`` for what takes no part."""
    rows = narrow(vectors, "vec_id", "embedding").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
    return rows.select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.int64).reshape(len(values), len(values.iloc[0]))


def _segments(q: np.ndarray, v: np.ndarray, segments: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Local scores of some queries, ``(m, queries, vectors)``, exact whole numbers."""
    width = max(1, -(-q.shape[1] // segments))
    cuts = [slice(a, a + width) for a in range(0, q.shape[1], width)] or [slice(0, 0)]
    top = max(1, q.shape[1]) * float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0))
    if top < EXACT:  # every product and sum is a whole double
        left, right = q.astype(np.float64), v.astype(np.float64)
    else:
        left, right = q.astype(object), v.astype(object)
    for a in range(0, len(q), STEP):
        yield slice(a, a + STEP), np.stack([left[a : a + STEP, c].dot(right[:, c].T) for c in cuts])


def _as_long(scores: np.ndarray) -> list[int]:
    return [max(-LONG - 1, min(LONG, int(s))) for s in scores]


def _first_phase(k: int, segments: int):
    def lists(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        if len(vectors) and len(queries):
            rows_, q_rows = vectors["row"].to_numpy(), queries["row"].to_numpy()
            depth = min(k + 1, len(rows_))  # one more, since the query itself may head a list
            for rows, local in _segments(_matrix(queries["v"]), _matrix(vectors["v"]), segments):
                total = local.sum(axis=0)
                best_first = np.argsort(-local, axis=2) if local.dtype == object else np.argpartition(-local, depth - 1, axis=2)
                heads = best_first[:, :, :depth]
                for i, query in enumerate(q_rows[rows]):
                    seen = np.unique(heads[:, i, :])
                    seen = seen[rows_[seen] != query]
                    scores = sorted(total[i, seen], reverse=True)[:k]
                    out.extend((query, s) for s in _as_long(np.array(scores, dtype=object)))
        return pd.DataFrame(out, columns=["query", "score"]).astype("int64")

    return lists


def _last_phases(k: int, segments: int):
    def resolve(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts: list[pd.DataFrame] = []
        if len(vectors) and len(queries):
            ids, rows_, q_rows = vectors["vec_id"].to_numpy(), vectors["row"].to_numpy(), queries["row"].to_numpy()
            cutoffs = queries["cutoff"].to_numpy()
            for rows, local in _segments(_matrix(queries["v"]), _matrix(vectors["v"]), segments):
                cutoff = cutoffs[rows].astype(local.dtype)[:, None]
                if local.dtype == object:  # the least long stands for anything below it
                    cutoff[cutoff == -LONG - 1] = -(10**60)
                # a little lower than cutoff / m, so that rounding never loses an entry
                uniform = cutoff / len(local) - 1 if local.dtype != object else cutoff // len(local) - 1
                bound = np.maximum(local, uniform[None]).sum(axis=0)
                collected = (local >= uniform[None]).any(axis=0) & (bound >= cutoff)
                i, j = np.nonzero(collected & (rows_[None, :] != q_rows[rows][:, None]))
                score = local[:, i, j].sum(axis=0)
                keep = score >= cutoff[i, 0]
                i, j, score = i[keep], j[keep], score[keep]
                # no more than k of a block can be among the best, however many tie
                order = np.lexsort((ids[j], -score, i))
                i, j, score = i[order], j[order], score[order]
                best = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j, score = i[best], j[best], score[best]
                parts.append(pd.DataFrame({"query": q_rows[rows][i], "query_id": queries["vec_id"].to_numpy()[rows][i], "vec_id": ids[j], "score": _as_long(score)}))
        empty = pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        return (pd.concat(parts) if parts else empty).astype("int64")

    return resolve


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, segments: int = SEGMENTS) -> DataFrame:
    """The ``k`` best other vectors of every query vector, by integer inner product.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` picks the queries by ``vec_id``.
    Returns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller id.

    Vectors that are NULL or hold a NULL or non-finite component, and rows without an id,
    take no part. A row is every other row's candidate, also of its own id; rows of one id are told
    apart by number, and each that is a query has its own ranks. Only vectors
    of equal length are compared; empty vectors score 0. Scores beyond 64 bits are held at
    the limit. A query with fewer than ``k`` others gets them all. Other columns are ignored.
    """
    if k < 1:
        raise ValueError("k must be positive")
    work = Workspace(vectors.sparkSession, "topk")
    # numbered as they are written, so that a row keeps its number
    rows = work.put(whole_vectors(vectors, scale).withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.filter(is_query)
    counts = rows.agg(F.count("*"), F.count_if(is_query)).first()
    v_blocks, q_blocks = partitions(counts[0], VECTOR_BLOCK), partitions(counts[1], QUERY_BLOCK)

    def dealt(frame: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        # both sides need the same key types to meet
        return frame.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(own_blocks)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))
        )

    by = ["dim", "v_block", "q_block"]
    blocks = dealt(rows, "v_block", v_blocks, "q_block", q_blocks).groupBy(*by)
    lists = blocks.cogroup(dealt(queries, "q_block", q_blocks, "v_block", v_blocks).groupBy(*by)).applyInPandas(
        _first_phase(k, segments), "query long, score long"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    cutoffs = (
        lists.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .groupBy(F.col("query").alias("row"))
        .agg(F.min("score").alias("cutoff"), F.count("*").alias("n"))
        # fewer than k known scores: anything may belong to the result
        .select("row", F.when(F.col("n") >= k, F.col("cutoff")).otherwise(F.lit(-LONG - 1)).alias("cutoff"))
    )
    with_cutoff = work.put(queries.join(cutoffs, "row"), "cutoffs")
    found = blocks.cogroup(dealt(with_cutoff, "q_block", q_blocks, "v_block", v_blocks).groupBy(*by)).applyInPandas(
        _last_phases(k, segments), "query long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )

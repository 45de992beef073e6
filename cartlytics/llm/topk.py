"""Exact top-k search by Fagin's threshold algorithm.

Candidates and queries are dealt into blocks of bounded size; each pair of a
query block and a candidate block is one task-sized cell.  In a cell every
dimension has its list of candidates sorted by value.  For a query the lists
are read in rounds from their better end (the low end where the query's
component is negative); newly seen candidates are scored by random access;
the sum over dimensions of component times the last value read bounds every
unseen score, and reading stops when that bound is below the k-th best score
(strictly, so that ties on smaller ids are never missed).  The cells' winners
are merged by rank.

Vectors are turned into integers floor(scale * x), so scores are exact.

Defined results: vectors that are null, or hold null or non-finite
components, and rows with a null vec_id take no part.  Shorter vectors count
as padded with zeros; an empty vector scores 0.  Ties go to the smaller
vec_id.  Repeated rows are candidates in their own right; a query's own rows
are all those with its vec_id, and a repeated query is answered once (its
smallest vector, in array order).  Fewer than k candidates give all of them.
Scores that leave the 64-bit range saturate.  Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

EXACT = float(2 ** 53)
LONG = (-(1 << 63), (1 << 63) - 1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) rows that take part, as arrays of doubles."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.col("embedding").cast("array<double>").alias("vector")))


def _matrix(vectors, scale: float) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(out * scale)


def _widen(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def threshold_search(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
                     first: int = 64):
    """Per query its k best (position in ``ids``, score), best first.  Exact for
    whole numbers as long as sums of products stay below 2**53; beyond that
    Python integers are used."""
    n, width = values.shape
    largest = (np.abs(values).max(initial=0) * np.abs(queries).max(initial=0)) * max(width, 1)
    exact = bool(largest < EXACT)
    if not exact:
        values = np.array([[int(x) for x in row] for row in values], dtype=object).reshape(n, width)
        queries = np.array([[int(x) for x in row] for row in queries], dtype=object).reshape(len(queries), width)
    ascending = np.argsort(values, axis=0, kind="stable") if width else np.empty((n, 0), int)
    ordered = np.take_along_axis(values, ascending, axis=0) if width else values
    columns = np.arange(width)
    results = []
    for own, q in zip(query_ids, queries, strict=True):
        down = np.array([x < 0 for x in q], bool)
        seen = np.zeros(n, bool)
        scores = np.zeros(n, dtype=values.dtype if exact else object)
        depth, best = 0, np.empty(0, int)
        while depth < n:
            reach = min(n, max(first, depth * 4))
            rows = np.arange(depth, reach)[:, None]
            at = np.where(down[None, :], rows, n - 1 - rows)
            fresh = np.unique(ascending[at, columns[None, :]]) if width else np.arange(n)
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            scores[fresh] = values[fresh] @ q if width else 0
            depth = reach if width else n
            pool = np.concatenate([best, fresh[ids[fresh] != own]])
            order = np.lexsort((ids[pool], -scores[pool])) if exact else np.array(
                sorted(range(len(pool)), key=lambda i: (-scores[pool[i]], ids[pool[i]])), int)
            best = pool[order[:k]]
            if len(best) == k and depth < n:
                last = np.where(down, depth - 1, n - depth)
                if (ordered[last, columns] * q).sum() < scores[best[-1]]:
                    break
        results.append((best, scores[best]))
    return results


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 10, scale: float = 1024.0,
          query_block: int = 1024, candidate_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query row against all rows."""
    rows = save(usable(vectors), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    candidate_blocks = max(1, math.ceil(counts["n"] / candidate_block))
    query_blocks = max(1, math.ceil(counts["q"] / query_block))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    def blocks(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = F.xxhash64("vec_id", "vector")
    left = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb"),
                          blocks(candidate_blocks).alias("cb"))
    right = rows.select(F.col("vec_id").alias("candidate"), F.col("vector").alias("point"),
                        blocks(query_blocks).alias("qb"),
                        F.pmod(dealt, F.lit(candidate_blocks)).cast("int").alias("cb"))

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"part": [], "query_id": [], "vec_id": [], "score": []}
        if len(q) and len(c):
            a, b = _matrix(list(q["vector"]), scale), _matrix(list(c["point"]), scale)
            width = max(a.shape[1], b.shape[1])
            ids = c["candidate"].to_numpy(np.int64)
            found = threshold_search(ids, _widen(b, width), q["vec_id"].to_numpy(np.int64), _widen(a, width), k)
            for query, (at, scores) in zip(q["vec_id"], found, strict=True):
                out["part"] += [int(c["cb"].iloc[0]) // 256] * len(at)
                out["query_id"] += [int(query)] * len(at)
                out["vec_id"] += ids[at].tolist()
                out["score"] += [min(max(int(s), LONG[0]), LONG[1]) for s in scores]
        return pd.DataFrame({name: np.array(v, np.int64) for name, v in out.items()})

    winners = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(
        cell, "part long, query_id long, vec_id long, score long")
    entry = F.struct((-F.col("score").cast("decimal(20,0)")).alias("low"), "vec_id", "score")

    def best(df, *keys):  # at most 256 blocks' winners meet in a list, then one list per 256 blocks
        return df.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list("hit")), 1, k).alias("best"))

    parts = best(winners.select("query_id", "part", entry.alias("hit")), "query_id", "part")
    whole = best(parts.select("query_id", F.explode("best").alias("hit")), "query_id")
    ranked = whole.select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                         F.col("hit.score").alias("score"))

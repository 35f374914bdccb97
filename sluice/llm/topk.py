"""Exact top-k inner products by a three-phase uniform threshold.

The score of a query and a vector is the sum of ``lists`` partial scores, one per block of dimensions.  Vectors are
dealt into row groups and queries into query blocks of bounded size; each (query block, row group) pair is one unit
of work, so the stated query set meets all rows in blocks and nothing grows with the table in one task.

1. Each row group gathers, for each query, the ``k`` best entries of each local list.  Their sums, with the list's
   least value for the parts not gathered, are lower bounds of real scores, so the k-th best of them over all groups
   is a safe cutoff.
2. The cutoff goes out with the query blocks (one number per query).  A vector that reaches it must reach
   ``cutoff / lists`` in one list at least: those entries, and only those, are collected.
3. The missing parts of the collected entries are resolved exactly; the best ``k`` of each group are merged.

Every step is exact: partial scores are integer products, held in doubles where their size allows it (below 2^53) and
in 64-bit integers elsewhere.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null id, take no part;
a component times the scale saturates at the 64-bit range, and a score has to fit into 64 bits; only vectors of equal length
are compared; rows equal in id and vector count once, rows of one id with different vectors are rows of their own (as
candidates, of the other's query too, and as queries); ties go to the smaller id; further columns are not read; an empty
table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

GROUP_ROWS, BLOCK_QUERIES, LISTS = 5_000, 1_000, 2
_BOUND = "query_id long, low double"
_BOUND_ARROW = pa.schema([("query_id", pa.int64()), ("low", pa.float64())])
_HIT = "row long, query_id long, vec_id long, score long"
_HIT_ARROW = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, vec_id, dim, v)``: components floor(scale * x), with a key ``id`` for each row (rows equal in all are one)."""
    x = F.col(vec_col)
    good = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    rows = vectors.filter(F.coalesce(good, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("long")).alias("v"))
    return rows.distinct().select(F.monotonically_increasing_id().alias("id"), "vec_id", "v", F.size("v").alias("dim"))


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    return np.asarray(t["v"].combine_chunks().flatten()).reshape(t.num_rows, dim) if t.num_rows else np.zeros((0, dim), np.int64)


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products; doubles (with fast matrix products) only where they cannot round."""
    big = max(1.0, float(np.abs(q.astype(np.float64)).max(initial=0))) * max(1.0, float(np.abs(v.astype(np.float64)).max(initial=0)))
    if big * max(1, q.shape[1]) < 2.0**52:
        return q.astype(np.float64) @ v.T.astype(np.float64)
    return q @ v.T


def _lists(dim: int, lists: int) -> list[slice]:
    edges = np.linspace(0, dim, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _blocks(t: pa.Table, dim: int, rows: int = 5_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    ids, names, v = np.asarray(t["id"]), np.asarray(t["vec_id"]), _matrix(t, dim)
    for at in range(0, len(ids), rows):
        yield ids[at : at + rows], names[at : at + rows], v[at : at + rows]


def _lower_bounds(k: int, lists: int):
    def phase1(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not queries.num_rows or not vectors.num_rows:
            return _BOUND_ARROW.empty_table()
        q_ids, q = np.asarray(queries["id"]), _matrix(queries, dim)
        best = np.full((len(q_ids), 0), -np.inf)
        for ids, _, v in _blocks(vectors, dim):
            parts = [_product(q[:, s], v[:, s]).astype(np.float64) for s in _lists(dim, lists)]
            own = q_ids[:, None] == ids[None, :]
            least = [p.min(axis=1, keepdims=True) for p in parts]
            low = np.full((len(q_ids), len(ids)), -np.inf)
            for p in parts:  # an entry gathered from one list only counts with the least of the others
                p[own] = -np.inf
            for i, p in enumerate(parts):
                top = np.argpartition(-p, min(k, p.shape[1]) - 1, axis=1)[:, :k]
                seen = np.zeros(p.shape, bool)
                np.put_along_axis(seen, top, True, axis=1)
                parts[i] = (p, seen)
            any_seen = np.logical_or.reduce([s for _, s in parts])
            total = sum(np.where(s, p, m) for (p, s), m in zip(parts, least))
            low[any_seen] = total[any_seen]
            low[own] = -np.inf
            best = np.concatenate([best, low], axis=1)
            if best.shape[1] > k:
                best = -np.partition(-best, k - 1, axis=1)[:, :k]
        # a sum of products beyond 2^53 may round up as a double: step down by far more than that
        best = best - np.where(np.isfinite(best), np.abs(best), 0) * 2.0**-40 - 1
        at = np.isfinite(best)
        return pa.table([pa.array(np.repeat(q_ids, at.sum(axis=1))), pa.array(best[at])], schema=_BOUND_ARROW)

    return phase1


def _resolved(k: int, lists: int):
    def phases23(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        if not queries.num_rows or not vectors.num_rows:
            return _HIT_ARROW.empty_table()
        q_ids, q = np.asarray(queries["id"]), _matrix(queries, dim)
        cutoff = np.asarray(queries["cutoff"].combine_chunks().fill_null(-np.inf))[:, None]
        got: list[np.ndarray] = []
        for ids, names, v in _blocks(vectors, dim):
            reach = np.zeros((len(q_ids), len(ids)), bool)
            for s in _lists(dim, lists):
                part = _product(q[:, s], v[:, s])
                reach |= part >= np.where(np.isfinite(cutoff), cutoff / lists - np.abs(cutoff) * 2.0**-40, -np.inf)
            reach &= q_ids[:, None] != ids[None, :]
            qi, vi = np.nonzero(reach)
            score = np.empty(len(qi), np.int64)
            for a in range(0, len(qi), 100_000):
                s = slice(a, a + 100_000)
                score[s] = (q[qi[s]] * v[vi[s]]).sum(axis=1)
            got.append(_best(qi, names[vi], score, k))
        qi, vec, score = _best(*np.concatenate(got, axis=1), k)
        return pa.table([pa.array(q_ids[qi]), pa.array(np.asarray(queries["vec_id"])[qi]), pa.array(vec), pa.array(score)], schema=_HIT_ARROW)

    return phases23


def _best(qi: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    order = np.lexsort((vec, -score, qi))
    qi, vec, score = qi[order], vec[order], score[order]
    first = np.concatenate(([True], qi[1:] != qi[:-1])) if len(qi) else np.zeros(0, bool)
    rank = np.arange(len(qi)) - np.repeat(np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(qi))))
    return np.stack([qi[rank < k], vec[rank < k], score[rank < k]]).astype(np.int64)


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256,
                lists: int = LISTS, group_rows: int = GROUP_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores for each row whose id is divisible by ``every``.

    A query leaves out its own row only; rows that share an id but not the vector are candidates and queries of their own.
    """
    rows = C.cut(quantised(vectors, id_col, vec_col, scale), "topk-vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    groups, blocks = -(-n.n // group_rows) or 1, -(-n.q // block_queries) or 1
    deal = lambda parts, seed: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(parts)).cast("int")
    every_of = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    queries = rows.filter(is_query).withColumn("qb", deal(blocks, 1)).withColumn("rg", every_of(groups))
    dealt = rows.withColumn("rg", deal(groups, 2)).withColumn("qb", every_of(blocks))
    dealt = dealt.toDF(*dealt.columns)  # attributes of its own: both sides come from one table
    unit = ["dim", "qb", "rg"]
    low = queries.groupBy(*unit).cogroup(dealt.groupBy(*unit)).applyInArrow(_lower_bounds(k, lists), _BOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("low"))
    cutoff = low.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select(F.col("query_id").alias("id"), F.col("low").alias("cutoff"))
    armed = queries.join(cutoff, "id", "left")
    hits = armed.groupBy(*unit).cogroup(dealt.groupBy(*unit)).applyInArrow(_resolved(k, lists), _HIT)
    final = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_top_k(spark, sf_dir: str) -> DataFrame:
    return exact_top_k(C.table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON (q.vec_id <> c.vec_id OR q.e <> c.e) AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

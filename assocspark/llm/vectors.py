"""Exact nearest neighbours by inner product: a block matrix join on int8 tiles with error bounds.

Vectors are dealt to blocks; a tile is one block of queries against one block of candidates. Inside a tile both are quantised to int8 with a
scale per vector. The product of the codes is an inner product with a known bound on its error, so a candidate whose upper bound lies below
the k-th best lower bound cannot be among the k nearest; the others are computed again in double precision, in component order. Each
query keeps its k best of a tile (a running heap over strips of candidates), and those of all tiles are merged. Rows that repeat an id and a
vector become one before they are dealt, and vectors of one id are dealt to all blocks of candidates, so that no id fills a tile.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERIES, CANDIDATES = 2048, 16384
#: Candidates of one int8 product, and pairs computed again at a time.
STRIP, PAIRS = 4096, 1 << 18
#: Components whose int8 products a float32 sums exactly.
EXACT = (1 << 24) // (127 * 127)
NEAREST = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the coded vectors and of what they leave out."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None])
    back = code * scale[:, None]
    return code.astype(np.int8), scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def tile_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Products of int8 codes, exact: float32 sums of few enough components."""
    out = np.zeros((len(q), len(v)))
    for a in range(0, q.shape[1], EXACT):
        out += q[:, a:a + EXACT].astype(np.float32) @ v[:, a:a + EXACT].astype(np.float32).T
    return out


def exact(q: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added up in component order; q and v are given by component."""
    out = np.zeros(len(i))
    for d in range(len(q)):
        out += q[d][i] * v[d][j]
    return out


def nearest_in_tile(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k nearest rows of ``v`` under another id: query number, id, score."""
    qc, qs, qn, qe = quantise(q)
    whole = np.linalg.norm(q, axis=1)
    qt = np.ascontiguousarray(q.T)
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(q))]  # worst first: (score, -id)
    floor = np.full(len(q), -np.inf)
    for a in range(0, len(v), STRIP):
        part, own = v[a:a + STRIP], ids[a:a + STRIP]
        vc, vs, vn, ve = quantise(part)
        vt = np.ascontiguousarray(part.T)
        near = tile_products(qc, vc) * qs[:, None] * vs
        slack = (qe[:, None] * vn + whole[:, None] * ve) * (1 + 1e-9) + 1e-12 * np.abs(whole[:, None] * vn)
        same = query_ids[:, None] == own
        low = np.where(same, -np.inf, near - slack)
        if len(own) >= k:
            floor = np.maximum(floor, np.partition(low, len(own) - k, axis=1)[:, len(own) - k])
        i, j = np.nonzero((near + slack >= floor[:, None]) & ~same)
        for p in range(0, len(i), PAIRS):
            pi, pj = i[p:p + PAIRS], j[p:p + PAIRS]
            score = exact(qt, vt, pi, pj)
            for x, s, name in zip(pi.tolist(), score.tolist(), (-own[pj]).tolist(), strict=True):
                heap = heaps[x]
                if len(heap) < k:
                    heapq.heappush(heap, (s, name))
                elif (s, name) > heap[0]:
                    heapq.heapreplace(heap, (s, name))
        floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in heaps])
    number = np.repeat(np.arange(len(q)), [len(h) for h in heaps])
    flat = [x for h in heaps for x in h]
    return number, np.array([-x[1] for x in flat], np.int64), np.array([x[0] for x in flat])


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("vector").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: Column | str, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows of every row that ``queries`` selects, by largest inner product, ties to the smaller id.

    A row is no neighbour of rows under its own id. Vectors that are null, empty, zero or hold null or non-finite components, and rows without
    an id, take no part; vectors are compared with those of equal dimension. Of rows that repeat an id and a vector one counts.
    """
    condition = F.expr(queries) if isinstance(queries, str) else queries
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(condition, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).groupBy("vec_id", "vector").agg(
        F.bool_or("asks").alias("asks")).withColumn("dim", F.size("vector"))
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    q_blocks, v_blocks = max(1, -(-asked // QUERIES)), max(1, -(-n // CANDIDATES))
    hashed = F.xxhash64("vec_id", F.lit(1))
    ask = rows.where("asks").select("dim", F.pmod(hashed, F.lit(q_blocks)).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))).alias("j"), F.lit(True).alias("asks"), "vec_id", "vector")
    base = rows.select("dim", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("i"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(v_blocks)).cast("int").alias("j"), F.lit(False).alias("asks"), "vec_id", "vector")

    def tile(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("asks"))
        ids, matrix = np.asarray(table.column("vec_id")), _matrix(table)
        order = np.lexsort((*matrix.T[::-1], ids))
        keep = np.ones(len(order), bool)
        keep[1:] = (ids[order][1:] != ids[order][:-1]) | (matrix[order][1:] != matrix[order][:-1]).any(axis=1) | (asks[order][1:] != asks[order][:-1])
        asking, rest = order[asks[order]], order[keep & ~asks[order]]
        asking = asking[np.unique(ids[asking], return_index=True)[1]]
        number, names, score = nearest_in_tile(ids[asking], matrix[asking], ids[rest], matrix[rest], k) if len(asking) and len(rest) else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": pa.array(ids[asking][number], pa.int64()), "vec_id": pa.array(names, pa.int64()), "score": pa.array(score, pa.float64())})

    found = ask.unionByName(base).groupBy("dim", "i", "j").applyInArrow(tile, NEAREST).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

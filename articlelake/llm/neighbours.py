"""Nearest neighbours by inner product: a join of int8 blocks with error bounds.

In each tile both sides are rounded to int8 with a scale per row. The product of the
rounded matrices, with the norms of what rounding took away, bounds every inner product
from both sides (Cauchy-Schwarz). A pair survives where its upper bound reaches the k-th
best known so far; only survivors are computed from the original vectors, in double
precision from the first component to the last, and go into a heap per query. So the
result is exact, not approximate.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do
rows without an id. Repeated rows (same id and vector) count once; rows with the same id
and other vectors are rows of their own, and a query is never its own candidate by id.
Shorter vectors are filled with zeros. Fewer than k candidates give fewer rows; an empty
table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm import blocks

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192
_STRIP = 2048


def rounded(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the norms of the rounded rows and of the remainders."""
    scale = np.abs(rows).max(axis=1, initial=0) / 127
    scale[scale == 0] = 1
    whole = np.rint(rows / scale[:, None]).astype(np.int8)
    near = whole * scale[:, None]
    return whole, scale, np.linalg.norm(near, axis=1), np.linalg.norm(rows - near, axis=1)


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    total = np.zeros(len(right))
    for d in range(right.shape[1]):
        total += left[..., d] * right[:, d]
    return total


def _few_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that k + 1 equal vectors of smaller id precede: they can't be among k best."""
    _, group = np.unique(rows.view(f"V{rows.shape[1] * rows.itemsize}").ravel(), return_inverse=True)
    order = np.argsort(group, kind="stable")  # ids ascend within a group
    begins = np.flatnonzero(np.diff(group[order], prepend=-1))
    nth = np.arange(len(order)) - np.repeat(begins, np.diff(begins, append=len(order)))
    before = np.empty(len(ids), dtype=np.int64)
    before[order] = nth
    return before <= k


def nearest_in_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """Per query the k best (score, -id) of the candidates, whose ids ascend."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    if rows.shape[1] == 0 or not len(rows):
        return heaps
    keep = _few_copies(ids, np.ascontiguousarray(rows + 0.0), k)
    ids, rows = ids[keep], rows[keep]
    # float32 products of int8 values are whole numbers, and exact below 2**24
    kind = np.float32 if rows.shape[1] * 127 * 127 < 1 << 24 else np.float64
    q_int, q_scale, q_near, q_rest = rounded(queries)
    q_int = q_int.astype(kind)
    q_norm = q_near + q_rest
    for start in range(0, len(rows), _STRIP):
        own, own_ids = rows[start : start + _STRIP], ids[start : start + _STRIP]
        c_int, c_scale, c_near, c_rest = rounded(own)
        with np.errstate(all="ignore"):
            about = (q_int @ c_int.astype(kind).T).astype(np.float64) * q_scale[:, None] * c_scale
            off = q_norm[:, None] * c_rest + q_rest[:, None] * c_near
            off += 1e-12 * q_norm[:, None] * (c_near + c_rest)  # rounding of the sums themselves
            about[query_ids[:, None] == own_ids] = -np.inf
            low = about - off
            low[np.isnan(low)] = -np.inf
            floor = np.full(len(queries), -np.inf)
            if len(own) >= k:
                floor = np.partition(low, len(own) - k, axis=1)[:, len(own) - k]
            known = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
            lives = ~(about + off < np.maximum(floor, known)[:, None]) & (query_ids[:, None] != own_ids)
        for q in np.flatnonzero(lives.any(axis=1)):
            at = np.flatnonzero(lives[q])
            heap = heaps[q]
            for score, vec_id in zip(exact(queries[q], own[at]).tolist(), (-own_ids[at]).tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, (score, vec_id))
                elif (score, vec_id) > heap[0]:
                    heapq.heapreplace(heap, (score, vec_id))
    return heaps


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query row."""
    vector = F.col(vector_column)
    takes_part = blocks.finite(vector) & F.exists(vector, lambda x: x != 0)
    doubles = F.when(takes_part, F.transform(vector, lambda x: x.cast("double")))

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = blocks.in_order(candidates)
        width = blocks.width_of(queries, candidates)
        query_ids = queries["vec_id"].to_numpy()
        heaps = []
        if queries.num_rows and candidates.num_rows:
            own = blocks.matrix(queries["vector"], width, np.float64)
            others = blocks.matrix(candidates["vector"], width, np.float64)
            heaps = nearest_in_tile(query_ids, own, candidates["vec_id"].to_numpy(), others, k)
        found = [(i, r, -v, s) for i, r, h in zip(query_ids.tolist(), queries["row"].to_pylist(), heaps) for s, v in h]
        return pa.table(dict(zip(("query_id", "row", "vec_id", "score"), map(list, zip(*found)) if found else [[]] * 4)), schema=_TILE)

    stored = blocks.vectors(rows, id_column, doubles, is_query)
    return blocks.ranked(blocks.over_tiles(stored, tile, "double", query_block, candidate_block), k)


_TILE = pa.schema([("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

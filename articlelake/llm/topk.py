"""Exact top-k by integer inner product: exhaustive, term at a time.

A block of candidates is an inverted index: per term (component) the rows that hold it and
their weights. Each term of a query scatters its weighted postings into a dense array of
scores over the block; a partition selects the k best, and a window merges the blocks.
Nothing is skipped, so the result is exact.

Vectors that are null or hold a null or non-finite component take no part, nor do rows
without an id; zero vectors do, with score 0. Absent components count as zero. Repeated
rows (same id and vector) count once, and a query is never its own candidate by id. Scores
are 64-bit; weights beyond that range are held at its ends. Fewer than k candidates give
fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm import blocks

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 8192


def postings(rows: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Per term the rows that hold it and their weights; a slice where all do."""
    out = []
    for weights in rows.T:
        at = np.flatnonzero(weights)
        out.append((slice(None), np.ascontiguousarray(weights)) if len(at) == len(weights) else (at, weights[at]))
    return out


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, earlier ones of equal scores."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


def top_k(
    rows: DataFrame,
    weights: Column,
    is_query: Column,
    k: int,
    id_column: str = "vec_id",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score over `weights`, an array of longs (null: takes no part)."""

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        candidates = blocks.in_order(candidates)
        width = blocks.width_of(queries, candidates)
        ids = candidates["vec_id"].to_numpy()
        found = []
        if queries.num_rows and candidates.num_rows:
            index = postings(blocks.matrix(candidates["vector"], width, np.int64))
            own = blocks.matrix(queries["vector"], width, np.int64)
            for query_id, row, query in zip(queries["vec_id"].to_pylist(), queries["row"].to_pylist(), own):
                scores = np.zeros(len(ids), dtype=np.int64)
                for term in np.flatnonzero(query):
                    at, held = index[term]
                    scores[at] += query[term] * held
                others = np.flatnonzero(ids != query_id)
                best = others[select(scores[others], k)]
                found += [(query_id, row, v, s) for v, s in zip(ids[best].tolist(), scores[best].tolist())]
        return pa.table(dict(zip(_TILE.names, map(list, zip(*found)) if found else [[]] * 4)), schema=_TILE)

    stored = blocks.vectors(rows, id_column, weights, is_query)
    return blocks.ranked(blocks.over_tiles(stored, tile, "long", query_block, candidate_block), k)


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component in double precision; null for vectors that take no part."""
    return F.when(blocks.finite(vector), F.transform(vector, lambda x: F.floor(x.cast("double") * float(factor))))


_TILE = pa.schema([("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

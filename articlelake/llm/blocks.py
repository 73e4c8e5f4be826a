"""Stated queries against all rows, in blocks: the grid that both vector searches use.

Queries are dealt into blocks of about `query_block` rows and candidates into blocks of
about `candidate_block`; every pair of blocks is a tile, worked on by one task that holds
one block of each. Tiles keep a few rows a query; a window over those ranks them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.frames import stored

TILE_SQL = "query_id long, row long, vec_id long, score {}"


def vectors(rows: DataFrame, id_column: str, vector: Column, is_query: Column) -> DataFrame:
    """Stored (vec_id, vector, is_query, row); repeated rows count once, rows without an id not at all."""
    chosen = rows.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"), is_query.alias("is_query"))
    chosen = chosen.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).distinct()
    return stored(chosen.withColumn("row", F.xxhash64("vec_id", "vector")), "vectors")


def finite(vector: Column) -> Column:
    """Whether the vector has no null and no non-finite component; false for a null vector."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Best k of each query row, highest score first, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def over_tiles(rows: DataFrame, tile: Callable[[pa.Table, pa.Table], pa.Table], score_type: str, query_block: int, candidate_block: int) -> DataFrame:
    """Run `tile(queries, candidates)` for each pair of blocks of stored `vectors`."""
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("is_query").cast("int")), F.lit(0))).first()
    across, down = max(1, -(-n_queries // query_block)), max(1, -(-n // candidate_block))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda count: F.pmod("row", F.lit(count)).cast("int")
    queries = rows.where("is_query").select("vec_id", "row", "vector", own(across).alias("q"), every(down).alias("c"))
    candidates = rows.select("vec_id", "row", "vector", own(down).alias("c"), every(across).alias("q"))
    return queries.groupBy("q", "c").cogroup(candidates.groupBy("q", "c")).applyInArrow(tile, TILE_SQL.format(score_type))


def matrix(column: pa.ChunkedArray, width: int, dtype: type) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=dtype)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def width_of(*tables: pa.Table) -> int:
    longest = [max(t["vector"].combine_chunks().value_lengths().to_pylist(), default=0) for t in tables if t.num_rows]
    return max(longest, default=0)


def in_order(candidates: pa.Table) -> pa.Table:
    return candidates.sort_by("vec_id")

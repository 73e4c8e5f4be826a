"""Codes of vectors: nearest entries of one codebook for each of four parts, learned in exact integers.

Components become integers. Each part of the vectors is sorted along a Hilbert curve and
laid out in flat blocks with the least and greatest value of each dimension (the block's
box) and their sums. In a round, distances between box and entries tell which entries can
be nearest to any row of a block; exact integer products decide among this shortlist. A
block with one entry on it is settled by its sums alone. A round sends one row per entry
and task to the sums; the codebooks, of `entries` rows a part, are all that the driver
holds. Every step is exact, so the result doesn't depend on the layout.

Nulls: rows whose vector is null or has null or non-finite components are dropped; rows
without an id are coded but come last where the codebook is begun, equal ids are taken by
their values there. A null label is a label of its own. Vectors of other lengths are
filled with zeros to the longest, and that to a multiple of four. Fewer rows than entries
begin a shorter codebook; an empty table, or one of empty vectors only, has no codebook.
Vectors too large for exact 64-bit distances fail with a message.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm.blocks import finite, matrix
from articlelake.llm.frames import numbers, rows, shuffle_partitions, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 256
_KEY_BITS = 4  # of each dimension, on the curve


def hilbert_keys(values: np.ndarray, bits: int = _KEY_BITS) -> np.ndarray:
    """Places of non-negative integer points, below 2**bits, on a Hilbert curve: bytes that sort like them.

    Transposes by exchanging and inverting low bits from the highest plane down, then undoes
    the Gray code; the planes' bits are then read dimension by dimension.
    """
    x = values.astype(np.int64).copy()
    n = x.shape[1]
    for plane in range(bits - 1, 0, -1):
        high, low = 1 << plane, (1 << plane) - 1
        for i in range(n):
            up = (x[:, i] & high).astype(bool)
            swap = np.where(up, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flips = np.zeros(len(x), dtype=np.int64)
    for plane in range(bits - 1, 0, -1):
        flips ^= np.where(x[:, n - 1] & (1 << plane), (1 << plane) - 1, 0)
    x ^= flips[:, None]
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)


def shortlist(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to a point of the box, in their order.

    An entry leaves if its least distance to the box exceeds another's greatest, or if at
    every point of the box it is farther than the entry with the least greatest distance:
    the difference of two squared distances is linear, so its least value is at a corner.
    """
    least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(axis=1)
    greatest = (np.maximum(np.abs(book - low), np.abs(book - high)) ** 2).sum(axis=1)
    best = int(greatest.argmin())
    listed = np.flatnonzero(least <= greatest[best])
    step = book[listed] - book[best]
    along = np.maximum(step * low, step * high).sum(axis=1)
    norms = (book[listed] ** 2).sum(axis=1) - (book[best] ** 2).sum()
    return listed[norms - 2 * along <= 0]


def nearest(points: np.ndarray, book: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the listed entries to each point and its squared distance; ties to the lower index."""
    own = book[listed]
    products = _products(points, own.T)
    distances = (own**2).sum(axis=1)[None, :] - 2 * products
    at = distances.argmin(axis=1)
    return listed[at], distances[np.arange(len(points)), at] + (points**2).sum(axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; doubles hold them where no sum can reach 2**53."""
    if int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def components(vectors: DataFrame, vector: Column, scale: int, id_column: str, label_column: str) -> DataFrame:
    """Stored rows (row, vec_id, label, ints) of the vectors that take part, with a number of their own.

    Integers are doubles here; a value that no 64-bit distance could hold fails the job.
    """
    kept = vectors.where(finite(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("ints"),
    )
    return stored(kept.withColumn("row", F.monotonically_increasing_id()), "code-vectors")


_BLOCKS = pa.schema(
    [("position", pa.int32()), ("n", pa.int32()), ("rows", pa.binary()), ("points", pa.binary())]
    + [(name, pa.list_(pa.int64())) for name in ("low", "high", "sums")]
)
_BLOCKS_SQL = "position int, n int, rows binary, points binary, low array<long>, high array<long>, sums array<long>"


def _part_rows(vectors: DataFrame, width: int, kind: str, least: int, greatest: int) -> DataFrame:
    """A row per part of each vector: position, place on the curve, row, the part's integers."""
    step = max(1, -(-(greatest - least + 1) >> _KEY_BITS))
    schema = pa.schema([("position", pa.int32()), ("place", pa.binary()), ("row", pa.int64()), ("points", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(pa.chunked_array([batch.column(1)]), PARTS * width, np.int64)
            for position in range(PARTS):
                own = np.ascontiguousarray(whole[:, position * width : (position + 1) * width])
                places = hilbert_keys((own - least) // step)
                yield rows(
                    schema,
                    position=[position] * len(own),
                    place=[p.tobytes() for p in places],
                    row=batch.column(0),
                    points=[p.tobytes() for p in own.astype(kind)],
                )

    return vectors.select("row", "ints").mapInArrow(cut, "position int, place binary, row long, points binary")


def _blocks(parts: DataFrame, width: int, kind: str) -> DataFrame:
    """Stored flat blocks of neighbours on the curve. Equal parts are dealt by row, so none fills a task."""

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = numbers(batch.column("position"))
            row = numbers(batch.column("row"))
            points = np.frombuffer(b"".join(batch.column("points").to_pylist()), dtype=kind).reshape(-1, width)
            for own in np.split(np.arange(len(row)), np.flatnonzero(np.diff(position)) + 1):
                for start in range(0, len(own), BLOCK):
                    at = own[start : start + BLOCK]
                    held = points[at]
                    yield rows(
                        _BLOCKS,
                        position=[position[at[0]]],
                        n=[len(at)],
                        rows=[row[at].astype("<i8").tobytes()],
                        points=[held.tobytes()],
                        low=[held.min(axis=0)],
                        high=[held.max(axis=0)],
                        sums=[held.sum(axis=0, dtype=np.int64)],
                    )

    ranged = parts.repartitionByRange(shuffle_partitions(parts.sparkSession), "position", "place", "row")
    ordered = ranged.sortWithinPartitions("position", "place", "row").select("position", "row", "points")
    return stored(ordered.mapInArrow(lay_out, _BLOCKS_SQL), "code-blocks")


def _opened(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for position, n, row, points, low, high, sums in zip(*(column.to_pylist() for column in batch.columns)):
        own = np.frombuffer(points, dtype=f"<i{len(points) // (n * width)}").reshape(n, width).astype(np.int64)
        yield position, np.frombuffer(row, dtype="<i8"), own, np.array([low, high], dtype=np.int64), np.array(sums, dtype=np.int64)


def _round(blocks: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """The codebooks after one round: every entry the floored mean of the parts nearest to it."""
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((*books.shape[:2], width), dtype=np.int64)
        counts = np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            for position, _, points, box, sums in _opened(batch, width):
                listed = shortlist(box[0], box[1], books[position])
                if len(listed) == 1:
                    totals[position, listed[0]] += sums
                    counts[position, listed[0]] += len(points)
                    continue
                entry, _ = nearest(points, books[position], listed)
                np.add.at(totals[position], entry, points)
                np.add.at(counts[position], entry, 1)
        position, entry = np.nonzero(counts)
        yield rows(schema, position=position, entry=entry, n=counts[position, entry], sums=list(totals[position, entry]))

    per_task = blocks.mapInArrow(assign, "position int, entry int, n long, sums array<long>")
    summed = per_task.groupBy("position", "entry").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width))
    )
    after = books.copy()
    for r in summed.collect():  # at most one row per entry
        after[r["position"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return after


def learn(vectors: DataFrame, blocks: DataFrame, width: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, dimension), begun with the vectors of the smallest ids."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "ints", "row").limit(entries).select("ints").collect()
    books = np.zeros((PARTS, len(first), width), dtype=np.int64)
    for n, r in enumerate(first):
        flat = np.zeros(PARTS * width, dtype=np.int64)
        flat[: len(r["ints"])] = r["ints"]
        books[:, n] = flat.reshape(PARTS, width)
    for _ in range(rounds):
        books = _round(blocks, books, width)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _assigned(blocks: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """(row, position, entry, distance) of every part."""
    schema = pa.schema([("row", pa.int64()), ("position", pa.int32()), ("entry", pa.int32()), ("distance", pa.int64())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, row, points, box, _ in _opened(batch, width):
                entry, distance = nearest(points, books[position], shortlist(box[0], box[1], books[position]))
                yield rows(schema, row=row, position=[position] * len(row), entry=entry, distance=distance)

    return blocks.mapInArrow(assign, "row long, position int, entry int, distance long")


def codes(
    table: DataFrame,
    vector_column: str = "embedding",
    id_column: str = "vec_id",
    label_column: str = "label",
    scale: int = 1024,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Learn codebooks and code every vector: (vec_id, label, code, error, label_error) and the codebooks.

    `error` is the squared distance to the coded vector, `label_error` its sum over a label.
    """
    vectors = components(table, F.col(vector_column), scale, id_column, label_column)
    span = vectors.agg(
        F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("width"),
        F.coalesce(F.min(F.array_min("ints")), F.lit(0)).alias("least"),
        F.coalesce(F.max(F.array_max("ints")), F.lit(0)).alias("greatest"),
    ).first()
    width = -(-span["width"] // PARTS)
    least, greatest = min(span["least"], 0), max(span["greatest"], 0)  # zeros fill short vectors
    if PARTS * width * (greatest - least) ** 2 >= 1 << 62:
        raise ValueError(f"components from {least} to {greatest} are too large for exact distances")
    if not width:
        plain = vectors.select("vec_id", "label", F.lit("00" * PARTS).alias("code"), F.lit(0).cast("long").alias("error"))
        return _with_label_error(plain), np.zeros((PARTS, 0, 0), dtype=np.int64)
    kind = "<i2" if -(1 << 15) <= least and greatest < 1 << 15 else "<i4" if -(1 << 31) <= least and greatest < 1 << 31 else "<i8"
    blocks = _blocks(_part_rows(vectors, width, kind, least, greatest), width, kind)
    books = learn(vectors, blocks, width, entries, rounds)
    of = lambda p: F.max(F.when(F.col("position") == p, F.lpad(F.lower(F.hex("entry")), 2, "0")))
    coded = _assigned(blocks, books, width).groupBy("row").agg(
        F.concat(*(of(p) for p in range(PARTS))).alias("code"), F.sum("distance").alias("error")
    )
    named = vectors.select("row", "vec_id", "label").join(coded, "row").drop("row")
    return _with_label_error(stored(named, "codes")), books


def _with_label_error(coded: DataFrame) -> DataFrame:
    per_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    joined = coded.join(per_label, F.col("label").eqNullSafe(F.col("own"))).drop("own")
    return joined.select("vec_id", "label", "code", "error", "label_error")


def decoded(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books[p, int(code[2 * p : 2 * p + 2], 16)] for p in range(books.shape[0])])

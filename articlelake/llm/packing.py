"""Best-fit-decreasing packing of token documents into sequences of a fixed capacity.

Pieces of one length are interchangeable, so the packing is decided on the counts of the
lengths (at most `capacity` numbers, however many documents there are): lengths go from
longest to shortest, and a segment tree over remaining capacities finds the tightest open
bins for each in logarithmic time. Bins with the same room are kept as one range of
numbers. The plan is a few thousand ranges; every piece then finds its place from its
rank among the pieces of its length. Ranks come from counts per task, so the whole
corpus is packed together, and no task sees more than its own rows.

Nulls: a null text is an empty document; it still has its end id. Null or repeated
doc_ids are packed as they come. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.bpe import shared_encoder
from articlelake.llm.frames import numbers, rows, slices, stored, task_number, texts

CAPACITY = 2048
END_ID = 0
_RANK_BITS = 44


class TightestFit:
    """Segment tree over remaining capacities 0..capacity; a leaf holds its open bin ranges."""

    def __init__(self, capacity: int):
        self._size = 1 << capacity.bit_length()
        self._open = [False] * (2 * self._size)
        self._ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        self._ranges[room].append((first, count))
        node = self._size + room
        while node and not self._open[node]:
            self._open[node] = True
            node //= 2

    def take(self, length: int) -> tuple[int, int, int] | None:
        """Remove and return (room, first bin, bins) of the tightest range with room for `length`."""
        node = self._size + length
        if not self._open[node]:
            while node > 1 and (node % 2 or not self._open[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self._size:
                node = 2 * node if self._open[2 * node] else 2 * node + 1
        room = node - self._size
        first, count = self._ranges[room].pop()
        if not self._ranges[room]:
            self._open[node] = False
            while node > 1:
                node //= 2
                self._open[node] = self._open[2 * node] or self._open[2 * node + 1]
        return room, first, count


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over {length: pieces}; one row per range of pieces.

    Columns: length, rank of the first piece, first bin, pieces per bin, offset in the bin.
    After a piece is placed, its bin is tighter than before, so best fit fills it with more
    of the same length while they fit; only then comes the next bin of the range.
    """
    tree, out, bins = TightestFit(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left > 0:
            found = tree.take(length)
            if found is None:
                each = capacity // length
                found = (capacity, bins, -(-left // each))
                bins += found[2]
            room, first, count = found
            each = room // length
            full = min(count, left // each)
            if full:
                out.append((length, rank, first, each, capacity - room))
                tree.add(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if left and full < count:  # fewer are left than this bin would take
                out.append((length, rank, first + full, left, capacity - room))
                tree.add(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < count:
                tree.add(room, first + full, count - full)
    return np.array(out, dtype=np.int64).reshape(-1, 5)


PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
        ("nth", pa.int64()),
    ]
)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize `texts` of documents and cut them, a row per piece; `nth` counts a task's pieces of one length.

    A document of more than `capacity` ids is cut into pieces of `capacity`, the first of
    which takes what doesn't divide. `ids` are packed little-endian, null unless kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(tokenizer), task_number()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([END_ID], dtype=encoder.dtype).tobytes()
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in PIECES.names}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(encoder.encode(text) + end, dtype=encoder.dtype)
                start, nth = 0, 0
                while start < len(ids):
                    length = (len(ids) - start) % capacity or capacity
                    own = ids[start : start + length]
                    out["part"].append(part)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(nth)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(own.astype("<u4").tobytes()))
                    out["ids"].append(own.tobytes() if keep_ids else None)
                    out["nth"].append(int(seen[length]))
                    seen[length] += 1
                    start, nth = start + length, nth + 1
            yield rows(PIECES, **out)

    return docs.mapInArrow(cut, ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'int' if f.type == pa.int32() else 'long'}" for f in PIECES))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place stored `pieces`: adds `sequence_id` and `offset`. `cut` must be a written table.

    The counts collected are one per length, so at most `capacity`.
    """
    per_task = cut.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_task = stored(per_task, "packing-counts")
    bases = per_task.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    ranges = plan(totals, capacity)
    order = np.argsort(ranges[:, 0] << _RANK_BITS | ranges[:, 1])
    ranges = ranges[order]
    keys = ranges[:, 0] << _RANK_BITS | ranges[:, 1]

    names = cut.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length = numbers(batch.column("length"))
            rank = numbers(batch.column("base")) + numbers(batch.column("nth"))
            own = ranges[np.searchsorted(keys, length << _RANK_BITS | rank, side="right") - 1]
            nth = rank - own[:, 1]
            named = {n: batch.column(n) for n in names}
            named["sequence_id"] = pa.array(own[:, 2] + nth // own[:, 3])
            named["offset"] = pa.array(own[:, 4] + nth % own[:, 3] * length)
            yield pa.RecordBatch.from_pydict(named)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return cut.join(bases, ["length", "part"]).mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and place whole documents; a row per piece."""
    cut = stored(pieces(texts(docs), tokenizer, capacity, keep_ids), "packing-pieces")
    return pack(cut, capacity).drop("part", "nth")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: `ids` of the pieces of each, in order. Needs kept ids.

    A sequence holds at most `capacity` ids, so a group is small whatever the corpus.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "piece")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"])).alias("pieces"),
    )

"""Minimum-bin-slack packing of token documents into windows, with no padding at all.

Pieces of one length are interchangeable, so windows are planned on the counts of the
lengths: at most `window` numbers, however many documents there are. For each window the
longest piece left is its seed, and a subset-sum dynamic programme over the counts, held
as one bitset per length, finds the multiset of lengths that comes closest to the room
beside it; walking back through the bitsets gives how many of each length it takes. The
same multiset is used for as many windows as the counts allow. Where no multiset fills
the window, one more piece is cut to fill the rest, and what is left of it goes back to
the counts. Less than a window at the end goes into windows of falling powers of two,
which need no padding.

Ranks of pieces among those of their length come from counts per task, so the corpus is
packed as a whole and no task sees more than its own rows. Only pieces of lengths that
the plan cuts are read a second time with their ids.

Nulls: a null text is an empty document; it still has its end id. Null or repeated
doc_ids are packed as they come. An empty table gives an empty result. A text of any
length is cut into windows by the task that reads it, which holds its ids at once.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.bpe import shared_encoder
from articlelake.llm.frames import rows, slices, stored, task_number, texts

WINDOW = 1024
END_ID = 0


def closest(room: int, counts: dict[int, int]) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum comes closest to `room` from below.

    Bit s of the bitset says whether a sum s can be reached. Longer pieces are preferred.
    """
    mask, reached, steps = (2 << room) - 1, 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        steps.append((length, reached))
        left, batch = min(counts[length], room // length), 1
        while left:
            batch = min(batch, left)
            reached |= reached << length * batch & mask
            left, batch = left - batch, 2 * batch
        if reached >> room:
            break
    total, taken = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total - n * length & 1:
            n += 1
        if n:
            taken[length], total = n, total - n * length
    return taken


class _Left:
    """Pieces left by length, each as runs (length when cut from a document, place in it, first rank, pieces)."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n > 0}
        self._runs: dict[int, list] = defaultdict(list)
        for length, n in self.counts.items():
            self._runs[length].append((length, 0, 0, n))
        self.total = sum(length * n for length, n in self.counts.items())

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """Runs of `n` pieces of a length, which leave."""
        self.counts[length] -= n
        self.total -= n * length
        if not self.counts[length]:
            del self.counts[length]
        while n:
            whole, at, rank, held = self._runs[length].pop()
            own = min(n, held)
            if own < held:
                self._runs[length].append((whole, at, rank + own, held - own))
            n -= own
            yield whole, at, rank, own

    def give(self, length: int, run: tuple[int, int, int, int]) -> None:
        self._runs[length].append(run)
        self.counts[length] = self.counts.get(length, 0) + run[3]
        self.total += length * run[3]


# Columns of a plan. A row places part [at, at + length) of the pieces `whole` long whose
# rank is in [rank, rank + pieces): the i-th goes to window first + (before + i) // each.
PLAN = ("whole", "at", "rank", "pieces", "length", "first", "before", "each", "offset")


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Where the pieces of each length go, as rows of `PLAN`, sorted by whole, at and rank."""
    left, out, first = _Left(counts), [], 0
    while left.total:
        room = window if left.total >= window else 1 << left.total.bit_length() - 1
        longest = max(left.counts)
        taken = {longest: 1} if longest <= room else {}
        spare = {n: c - taken.get(n, 0) for n, c in left.counts.items()}
        for length, n in closest(room - sum(taken), spare).items():
            taken[length] = taken.get(length, 0) + n
        slack = room - sum(length * n for length, n in taken.items())
        cut = max((n for n, c in left.counts.items() if c > taken.get(n, 0)), default=0) if slack else 0
        uses = {**taken, cut: taken.get(cut, 0) + 1} if cut else taken
        windows = min(left.counts[length] // n for length, n in uses.items())
        if room < window:
            windows = 1
        offset = 0
        for length, n in taken.items():
            before = 0
            for whole, at, rank, own in left.take(length, n * windows):
                out.append((whole, at, rank, own, length, first, before, n, offset))
                before += own
            offset += n * length
        if cut:
            before = 0
            for whole, at, rank, own in list(left.take(cut, windows)):
                out.append((whole, at, rank, own, slack, first, before, 1, offset))
                left.give(cut - slack, (whole, at + slack, rank, own))
                before += own
        first += windows
    return np.array(sorted(out), dtype=np.int64).reshape(-1, len(PLAN))


PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("whole", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("nth", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_PIECES_SQL = "part int, doc_id long, start long, whole long, ids_crc32 long, doc_tokens long, nth long, ids binary"
_PLACED = pa.schema([f for f in PIECES if f.name != "ids"] + [(n, pa.int64()) for n in ("at", "length", "sequence_id", "offset")])
_PLACED_SQL = "part int, doc_id long, start long, whole long, ids_crc32 long, doc_tokens long, nth long, at long, length long, sequence_id long, offset long"


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pieces(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """Tokenize `texts` and cut documents of more than `window` ids into windows and a rest.

    `nth` counts a task's pieces of one length `whole`; `ids` are packed little-endian.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(tokenizer), task_number()
        end = np.array([END_ID], dtype=encoder.dtype).tobytes()
        seen: dict[int, int] = defaultdict(int)
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in PIECES.names}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(encoder.encode(text) + end, dtype=encoder.dtype)
                for start in range(0, len(ids), window):
                    own = ids[start : start + window]
                    found = (part, doc_id, start, len(own), _crc(own), len(ids), seen[len(own)], own.tobytes())
                    for name, value in zip(PIECES.names, found):
                        out[name].append(value)
                    seen[len(own)] += 1
            yield rows(PIECES, **out)

    return docs.mapInArrow(cut, _PIECES_SQL)


def _places(ranked: DataFrame, planned: np.ndarray) -> DataFrame:
    """A row for each part of the pieces: `whole` and `rank` decide."""
    levels = []  # the plan by place in the piece: ranks of one place and length don't overlap
    for at in np.unique(planned[:, 1]):
        own = planned[planned[:, 1] == at]
        order = np.lexsort((own[:, 2], own[:, 0]))
        levels.append(own[order])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("whole").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            for level in levels:
                keys = np.stack([level[:, 0], level[:, 2]])
                row = _last_at_most(keys, whole, rank)
                fits = (row >= 0) & (level[row, 0] == whole) & (rank < level[row, 2] + level[row, 3])
                chosen = np.flatnonzero(fits)
                if not len(chosen):
                    continue
                own = level[row[chosen]]
                nth = own[:, 6] + rank[chosen] - own[:, 2]
                part = batch.take(pa.array(chosen))
                named = {n: part.column(n) for n in _PLACED.names if n in part.schema.names}
                named |= {"at": own[:, 1], "length": own[:, 4], "sequence_id": own[:, 5] + nth // own[:, 7]}
                named["offset"] = own[:, 8] + nth % own[:, 7] * own[:, 4]
                named["start"] = part.column("start").to_numpy(zero_copy_only=False) + own[:, 1]
                yield rows(_PLACED, **named)

    return ranked.mapInArrow(place, _PLACED_SQL)


def _last_at_most(keys: np.ndarray, whole: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each (whole, rank) the last of the sorted keys that isn't above it, -1 before the first."""
    shift = np.int64(1) << 44
    return np.searchsorted(keys[0] * shift + keys[1], whole * shift + rank, side="right") - 1


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """Place whole documents in windows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A row per piece, with its `ids` (packed as the tokenizer's narrowest type) where they are kept.
    """
    cut = stored(pieces(texts(docs), tokenizer, window), "window-pieces")
    per_task = stored(cut.groupBy("whole", "part").count(), "window-counts")
    counts = {r["whole"]: r["n"] for r in per_task.groupBy("whole").agg(F.sum("count").alias("n")).collect()}
    planned = plan(counts, window)

    earlier = Window.partitionBy("whole").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("whole", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    ranked = cut.drop("ids").join(bases, ["whole", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = _places(ranked.drop("base"), planned)

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    in_parts = np.unique(planned[planned[:, 0] != planned[:, 4], 0]).tolist()  # lengths of which some piece is cut
    if not in_parts and not keep_ids:
        return placed.select(*columns)
    placed = stored(placed, "window-places")
    wanted = cut.select("part", "whole", "nth", "ids")
    if not keep_ids:
        wanted = wanted.where(F.col("whole").isin(in_parts))
    again = placed if keep_ids else placed.where(F.col("length") < F.col("whole"))
    again = again.drop("ids_crc32").join(wanted, ["part", "whole", "nth"])
    dtype = shared_encoder(tokenizer).dtype

    def own_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = zip(*(batch.column(n).to_pylist() for n in ("ids", "at", "length")))
            parts = [np.frombuffer(ids, dtype=dtype)[at : at + length] for ids, at, length in found]
            named = {n: batch.column(n) for n in columns if n != "ids_crc32"}
            named |= {"ids_crc32": [_crc(p) for p in parts], "ids": [p.tobytes() if keep_ids else None for p in parts]}
            yield rows(_WITH_IDS, **named)

    fields = ", ".join(f"{n} long" for n in columns)
    exact = again.mapInArrow(own_ids, f"{fields}, ids binary")
    if keep_ids:
        return exact
    return placed.where(F.col("length") == F.col("whole")).select(*columns).unionByName(exact.drop("ids"))


_WITH_IDS = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
)


def sequences(placed: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id, the ids in order, and its pieces. Needs kept ids.

    A group holds at most `window` ids, so it is small whatever the corpus.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "start")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["start"], p["offset"])).alias("pieces"),
    )

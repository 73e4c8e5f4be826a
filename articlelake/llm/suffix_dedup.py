"""Removal of passages that an earlier document holds, byte for byte, by suffix arrays.

A byte goes if it lies in a string of `LENGTH` bytes that also starts in a document of
smaller doc_id. All such strings are found, whatever shards their documents lie in:

1. Documents are packed into blocks. Every window of LENGTH bytes is filed under its anchor,
   the run of ANCHOR bytes of least hash inside it (the leftmost of equal ones), so equal
   windows have equal anchors. Neighbouring windows share anchors: there is about one to
   eighteen bytes. Anchors that occur in one document only are set aside, for nothing that
   is filed under them repeats. Only hashes travel, once a block each.
2. For the others, stretches of windows with one anchor are cut out, each distinct one once
   a block with the smallest doc_id that holds it, and dealt to buckets by anchor. However
   many copies a passage has, it comes once from each block. An anchor with more than `HOT`
   distinct stretches, counted by block, is not filed as one: its windows are dealt one by
   one, by the hash of all their bytes, and equal ones meet as equal strings.
3. A bucket is worked through in shards of bounded size, one after another. All stretches of
   an anchor lie in one shard. Its suffix array is built by Larsson-Sadakane refinement,
   common prefixes by Kasai's pass, and suffixes that share LENGTH bytes form groups with
   their smallest doc_id. A shard that is too large nevertheless is worked through in parts,
   merged by binary search among their sorted strings.
4. Blocks get back, per stretch, the smallest doc_id of each window, mark the windows that
   an earlier document holds, and cut the covered bytes.

The blocks are a bucketed table, so the text is never shuffled, not even for the joins.

Nulls: a null text is empty. A row without doc_id is neither earlier nor later than any
other: its text stays and removes nothing. Rows with the same doc_id don't remove each
other's text. Matches never cross documents. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from articlelake.llm.frames import numbers, rows, shuffle_partitions, slices, stored, task_number, text_bytes
from articlelake.llm.shingles import mixed
from articlelake.runtime import run_folder

LENGTH = 50
ANCHOR = 16
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
PIECE_BYTES = 1 << 17  # of a block, for which hashes and minima are held at a time
HOT = 8192
_U = np.uint64
_NONE = np.iinfo(np.int64).max
_BASE = _U(0x9E3779B97F4A7C15)


# --- windows and anchors of a block -------------------------------------------------------


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first position, windows, hash of the anchor, document.

    No window runs over the end of a document, so some documents at a time are worked on.
    """
    found, begin = [], 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, side="right")) - 1)
        low, high = offsets[begin], offsets[end]
        first, windows, hashes, doc = _stretches(data[low:high], offsets[begin : end + 1] - low, length)
        found.append((first + low, windows, hashes, doc + begin))
        begin = end
    found = found or [_stretches(data[:0], np.zeros(1, dtype=np.int64), length)]
    first, windows, hashes, doc = map(np.concatenate, zip(*found))
    return first, windows, hashes, doc


def _stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.int64)
    anchor = min(ANCHOR, length)
    if anchor < 8:
        raise ValueError("repeated strings must have 8 bytes or more")
    if len(data) < length:
        return none, none, none.astype(np.uint64), none
    word = data.astype(np.uint64)
    span = 1
    while span < 8:
        word = word[:-span] | (word[span:] << _U(8 * span))
        span *= 2
    # an anchor is hashed eight bytes at a time, the last eight wherever they begin
    n = len(data) - anchor + 1
    hashes = np.zeros(n, dtype=np.uint64)
    for at in dict.fromkeys([*range(0, anchor - 8, 8), anchor - 8]):
        hashes = mixed(hashes + word[at : at + n] + _U(1))
    order = (hashes & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    at = (_least_in(order, length - anchor + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    # windows that run over the end of a document don't count
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    doc = np.repeat(np.arange(len(windows)), windows)
    first = np.repeat(offsets[:-1] - np.cumsum(windows) + windows, windows) + np.arange(len(doc))
    if not len(first):
        return none, none, none.astype(np.uint64), none
    own = at[first]
    begins = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    # least hashes are small numbers; mixed once more, they spread over all buckets
    return first[begins], np.diff(begins, append=len(first)), mixed(~hashes[own[begins]]), doc[begins]


# --- suffix arrays ------------------------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of `symbols` (0 to 256) and the rank of each, by refinement of groups.

    The first order is by seven symbols. Then groups of equal suffixes, and only those, are
    sorted by the rank of what follows, which doubles the depth each time.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64) + _U(1), np.zeros(7, dtype=np.uint64)])
    word = np.zeros(n, dtype=np.uint64)
    for i in range(7):
        word = word << _U(9) | padded[i : n + i]
    order = np.argsort(word)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    begins = np.flatnonzero(np.append(True, np.diff(word[order]) != 0)) if n else np.zeros(0, dtype=np.int64)
    sizes = np.diff(begins, append=n)
    rank[order] = np.repeat(begins, sizes)
    open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    depth = 7
    while len(open_at):
        suffix = order[open_at]
        group = rank[suffix]
        key = group * (n + 1) + rank[np.minimum(suffix + depth, n)] + 1
        by = np.argsort(key)
        key, suffix = key[by], suffix[by]
        order[open_at] = suffix
        begins = np.flatnonzero(np.append(True, np.diff(key) != 0))
        sizes = np.diff(begins, append=len(key))
        rank[suffix] = np.repeat(open_at[begins], sizes)
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        depth *= 2
    return order, rank[:n]


def common_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Kasai's pass: symbols each suffix shares with the one before it in the order.

    From one position to the next a common prefix loses at most one symbol. The strings that
    begin at `starts` are passed side by side, each from its own first position on.
    """
    n = len(symbols)
    ended = np.concatenate([symbols.astype(np.int64), [-1]])
    before = np.empty(n, dtype=np.int64)
    before[order[1:]] = order[:-1]
    if n:
        before[order[0]] = n  # nothing before it: no symbol equals the end
    shared = np.zeros(n, dtype=np.int64)
    lanes = np.argsort(-lengths, kind="stable")
    held = np.zeros(len(lanes), dtype=np.int64)
    for step in range(int(lengths.max(initial=0))):
        lanes = lanes[: int((lengths[lanes] > step).sum())]
        at = starts[lanes] + step
        other = before[at]
        held = np.maximum(held[: len(lanes)] - 1, 0)
        held[other == n] = 0
        going = np.arange(len(lanes))
        while len(going):
            a, b = at[going] + held[going], other[going] + held[going]
            same = (ended[np.minimum(a, n)] == ended[np.minimum(b, n)]) & (a < n) & (b < n)
            going = going[same]
            held[going] += 1
        shared[at] = held
    return shared


class Shard:
    """Windows of `length` bytes of some distinct strings, grouped by a suffix array."""

    def __init__(self, strings: list[bytes], owners: np.ndarray, length: int):
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self._lengths, self.counts = lengths, lengths - length + 1
        text = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
        starts = np.cumsum(lengths + 1) - lengths - 1
        symbols = text.astype(np.int16) + 1
        symbols[starts + lengths] = 0  # separators come before every byte
        order, rank = suffix_array(symbols)
        shared = common_prefixes(symbols, order, rank, starts, lengths + 1)
        group = np.cumsum(shared[order] < length) - 1
        windows = np.repeat(starts - np.cumsum(self.counts) + self.counts, self.counts) + np.arange(self.counts.sum())
        own = group[rank[windows]]
        used = np.zeros(len(symbols), dtype=bool)
        used[own] = True
        self.group = (np.cumsum(used) - 1)[own]
        self.least = np.full(int(used.sum()), _NONE)
        np.minimum.at(self.least, self.group, np.repeat(owners, self.counts))
        self._text, self._windows, self._length = text, windows, length

    def keys(self) -> np.ndarray:
        """The distinct windows, in the order of the groups, which is sorted."""
        view = np.lib.stride_tricks.sliding_window_view(self._text, self._length)
        first = np.empty(len(self.least), dtype=np.int64)
        first[self.group[::-1]] = self._windows[::-1]
        return np.ascontiguousarray(view[first]).view(f"S{self._length}").ravel()


def merge(shards: list[Shard]) -> None:
    """Give every group the least owner that any shard has for its string, by binary search."""
    if len(shards) < 2:
        return
    keys, least = shards[0].keys(), shards[0].least
    for shard in shards[1:]:
        own = shard.keys()
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        known = keys[at] == own
        least[at[known]] = np.minimum(least[at[known]], shard.least[known])
        where = np.searchsorted(keys, own[~known])
        keys, least = np.insert(keys, where, own[~known]), np.insert(least, where, shard.least[~known])
    for shard in shards:
        shard.least = least[np.searchsorted(keys, shard.keys())]


def least_owners(strings: list[bytes], owners: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """Per distinct string, for each of its windows the least owner of any string that holds it."""
    ends = np.cumsum([len(s) - length + 1 for s in strings]).tolist()
    least = _least(strings, owners, length, shard_bytes)
    return [least[a:b] for a, b in zip([0, *ends], ends)]


def _least(strings: list[bytes], owners: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """The same for the windows of all strings, one after another."""
    sizes = np.cumsum([len(s) + 1 for s in strings])
    cuts = np.searchsorted(sizes, np.arange(shard_bytes, int(sizes[-1]) + shard_bytes, shard_bytes), side="right") if strings else []
    shards, begin = [], 0
    for end in [*cuts[:-1], len(strings)] if len(cuts) else []:
        if end > begin:
            shards.append(Shard(strings[begin:end], owners[begin:end], length))
            begin = end
    merge(shards)
    return np.concatenate([np.zeros(0, dtype=np.int64), *(shard.least[shard.group] for shard in shards)])


# --- the job ------------------------------------------------------------------------------


def _blocks(docs: DataFrame, text_column: str, block_bytes: int) -> DataFrame:
    """Rows packed into blocks: block, texts (one binary), sizes, and the other columns as `rest`."""
    rest = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_column]
    packed = docs.select(F.col(text_column).cast("string").alias("text"), F.struct(*rest).alias("rest"))
    rest_type = packed.schema["rest"].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, part = 0, task_number()
        for batch in slices(batches, block_bytes):
            data, offsets = text_bytes(batch.column("text"))
            others = batch.column("rest")
            lists = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), pa.concat_arrays([others]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | nth]), pa.array([data.tobytes()]), pa.array([np.diff(offsets).tolist()]), lists],
                names=["block", "data", "sizes", "rest"],
            )
            nth += 1

    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("data", T.BinaryType()), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("rest", T.ArrayType(rest_type))]
    )
    return packed.mapInArrow(pack, schema)


def _bucketed(blocks: DataFrame, count: int) -> DataFrame:
    """The blocks as a table dealt by block number, which later joins find as it lies."""
    spark, name = blocks.sparkSession, f"suffix_blocks_{uuid.uuid4().hex}"
    writer = blocks.write.format("parquet").option("path", run_folder(spark, "suffix-blocks"))
    writer.bucketBy(count, "block").saveAsTable(name)
    return spark.table(name)


class _Block:
    """A block as read: its stretches, and which of them are filed under the anchors given."""

    def __init__(self, batch: pa.RecordBatch, nth: int, id_field: int, length: int):
        self.data = np.frombuffer(batch.column("data")[nth].as_py(), dtype=np.uint8)
        sizes = batch.column("sizes")[nth].as_py()
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rest = batch.column("rest")[nth].values
        ids = self.rest.field(id_field).cast(pa.int64())
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        first, windows, hashes, doc = stretches(self.data, self.offsets, length)
        use = self.known[doc]
        self.first, self.windows, self.hashes, self.doc = first[use], windows[use], hashes[use], doc[use]
        self.length = length
        self.anchors, self._anchor = np.unique(self.hashes, return_inverse=True)

    def in_several(self) -> np.ndarray:
        """Of each anchor, whether documents of different ids in this block hold it."""
        low, high = np.full(len(self.anchors), _NONE), np.full(len(self.anchors), -_NONE - 1)
        np.minimum.at(low, self._anchor, self.ids[self.doc])
        np.maximum.at(high, self._anchor, self.ids[self.doc])
        return low != high

    def distinct(self) -> np.ndarray:
        """Of each anchor, how many distinct stretches this block files under it."""
        power = np.cumprod(np.full(len(self.data) + 1, _BASE, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(self.data * power[:-1], dtype=np.uint64)])
        ends = self.first + self.windows + self.length - 1
        # moved to one place, equal strings have equal sums
        hashes = (sums[ends] - sums[self.first]) * power[len(self.data) - self.first]
        order = np.lexsort((hashes, self._anchor))
        anchor, hashes = self._anchor[order], hashes[order]
        new = np.append(True, (np.diff(anchor) != 0) | (hashes[1:] != hashes[:-1]))[: len(anchor)]
        return np.bincount(anchor[new], minlength=len(self.anchors))

    def repeated(self, buckets: int, bits: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """Stretches under repeated anchors, those under hot ones window by window.

        First positions, windows, doc_ids and number of the distinct string of each; these
        strings with their buckets and the part of the bucket. Hot windows have buckets of their own.
        """
        flags, hot = np.zeros(len(self.anchors), dtype=bool), np.zeros(len(self.anchors), dtype=bool)
        bounds = _bounds(self.anchors, buckets)
        for x in bits or []:
            begin, end = bounds[x["bucket"]], bounds[x["bucket"] + 1]
            for to, packed in ((flags, x["bits"]), (hot, x["hot"])):
                to[begin:end] = np.unpackbits(np.frombuffer(packed, dtype=np.uint8), count=end - begin).astype(bool)
        cold, split = (np.flatnonzero(f[self._anchor]) for f in (flags & ~hot, flags & hot))
        n = self.windows[split]
        single = np.repeat(self.first[split] - np.cumsum(n) + n, n) + np.arange(n.sum())
        first = np.concatenate([self.first[cold], single])
        windows = np.concatenate([self.windows[cold], np.ones(len(single), dtype=np.int64)])
        ids = self.ids[np.concatenate([self.doc[cold], np.repeat(self.doc[split], n)])]
        hashes = np.concatenate([self.hashes[cold], _hashes(self.data, single, self.length)])
        own = _bucket(hashes, buckets)
        own[len(cold) :] += buckets
        whole, numbered, ends = self.data.tobytes(), {}, first + windows + self.length - 1
        known = numbered.setdefault
        number = np.array([known(whole[a:b], len(numbered)) for a, b in zip(first.tolist(), ends.tolist())], dtype=np.int64)
        bucket, part = np.zeros(len(numbered), dtype=np.int64), np.zeros(len(numbered), dtype=np.uint8)
        bucket[number] = own
        part[number] = (hashes & _U(255)).astype(np.uint8)
        return first, windows, ids, number, list(numbered), bucket, part


def _hashes(data: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` bytes at each position."""
    out = np.zeros(len(first), dtype=np.uint64)
    if len(first):
        view = np.lib.stride_tricks.sliding_window_view(data, 8)
        for at in dict.fromkeys([*range(0, length - 8, 8), length - 8]):
            out = mixed(out + np.ascontiguousarray(view[first + at]).view(np.uint64).ravel() + _U(1))
    return out


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _bounds(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted anchors."""
    return np.searchsorted(_bucket(anchors, buckets), np.arange(buckets + 1))


def _each(batches: Iterator[pa.RecordBatch], id_field: int, length: int) -> Iterator[tuple[pa.RecordBatch, int, _Block]]:
    for batch in batches:
        for nth in range(batch.num_rows):
            yield batch, nth, _Block(batch, nth, id_field, length)


def repeated_bytes(docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """The rows of `docs` with `text_column` replaced by what is left, and what was removed.

    Adds `kept` (binary: the remaining bytes), `n_bytes`, `n_removed` and `spans` (begin and
    end of each removed run, in bytes), in the place of columns of these names. The text is what `kept` decodes to; a cut inside a
    character leaves out the rest of that character.
    """
    docs = docs.drop(*{"kept", "n_bytes", "n_removed", "spans"} - {id_column, text_column})
    if docs.schema[id_column].dataType != T.LongType():
        docs = docs.withColumn(id_column, F.col(id_column).cast("long"))
    others = [c for c in docs.columns if c != text_column]
    id_field = others.index(id_column)
    spark = docs.sparkSession
    blocks = _bucketed(_blocks(docs, text_column, block_bytes), shuffle_partitions(spark))
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8 * shuffle_partitions(spark), -(-total // bucket_bytes))

    def anchors(batches):
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("hashes", pa.binary()), ("several", pa.binary()), ("counts", pa.binary())])
        for batch, nth, block in _each(batches, id_field, length):
            bounds, several, counts = _bounds(block.anchors, buckets), block.in_several(), block.distinct()
            held = np.flatnonzero(np.diff(bounds))
            parts = [slice(bounds[b], bounds[b + 1]) for b in held]
            yield rows(
                schema,
                block=[batch.column("block")[nth].as_py()] * len(held),
                bucket=held,
                hashes=[block.anchors[p].tobytes() for p in parts],
                several=[np.packbits(several[p]).tobytes() for p in parts],
                counts=[np.minimum(counts[p], 65535).astype("<u2").tobytes() for p in parts],
            )

    def flagged(group: pa.Table) -> pa.Table:
        held = [np.frombuffer(x, dtype=np.uint64) for x in group["hashes"].to_pylist()]
        several = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(h)).astype(bool) for x, h in zip(group["several"].to_pylist(), held)]
        _, at, count = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        flag = count > 1
        flag[at[np.concatenate(several)]] = True
        counts = np.concatenate([np.frombuffer(x, dtype="<u2") for x in group["counts"].to_pylist()])
        crowded = np.bincount(at, weights=counts) > hot
        ends = np.cumsum([len(h) for h in held])[:-1]
        own = np.split(flag[at], ends)
        packed = {name: pa.array([np.packbits(x).tobytes() for x in np.split(f[at], ends)], pa.binary()) for name, f in (("bits", flag), ("hot", crowded))}
        out = pa.table({"block": group["block"], "bucket": group["bucket"], **packed})
        return out.filter(pa.array([bool(x.any()) for x in own]))

    bits = blocks.select("block", "data", "sizes", "rest").mapInArrow(anchors, "block long, bucket int, hashes binary, several binary, counts binary")
    bits = bits.groupBy("bucket").applyInArrow(flagged, "block long, bucket int, bits binary, hot binary")
    bits = stored(bits, "suffix-anchors").groupBy("block").agg(F.collect_list(F.struct("bucket", "bits", "hot")).alias("bits"))

    def cut_out(batches):
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("strings", pa.binary()), ("sizes", pa.binary()), ("parts", pa.binary()), ("owners", pa.binary())])
        for batch, nth, block in _each(batches, id_field, length):
            _, _, ids, number, strings, bucket, part = block.repeated(buckets, batch.column("bits")[nth].as_py())
            owners = np.full(len(strings), _NONE)
            np.minimum.at(owners, number, ids)
            out = {name: [] for name in schema.names}
            order = np.argsort(bucket, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                parts = [strings[i] for i in own.tolist()]
                out["block"].append(batch.column("block")[nth].as_py())
                out["bucket"].append(int(bucket[own[0]]))
                out["strings"].append(b"".join(parts))
                out["sizes"].append(np.array([len(p) for p in parts], dtype="<u4").tobytes())
                out["parts"].append(part[own].tobytes())
                out["owners"].append(owners[own].astype("<i8").tobytes())
            yield rows(schema, **out)

    def owned(group: pa.Table) -> pa.Table:
        numbered, number, owners, parts = {}, [], [], []
        for strings, sizes, part, own in zip(*(group[c].to_pylist() for c in ("strings", "sizes", "parts", "owners"))):
            ends = np.cumsum(np.frombuffer(sizes, dtype="<u4")).tolist()
            number.append([numbered.setdefault(strings[a:b], len(numbered)) for a, b in zip([0, *ends], ends)])
            owners.append(np.frombuffer(own, dtype="<i8"))
            parts.append(np.frombuffer(part, dtype=np.uint8))
        least, part = np.full(len(numbered), _NONE), np.zeros(len(numbered), dtype=np.int64)
        every = np.concatenate([np.array(n) for n in number])
        np.minimum.at(least, every, np.concatenate(owners))
        part[every] = np.concatenate(parts)
        strings, order = list(numbered), np.arange(len(numbered))
        windows = np.array([len(s) - length + 1 for s in strings], dtype=np.int64)
        if group["bucket"][0].as_py() < buckets:  # others are hot windows: equal ones are one string already
            filled = np.cumsum(np.bincount(part, weights=[len(s) + 1 for s in strings]))
            shard = (filled // SHARD_BYTES)[part]
            order = np.argsort(shard, kind="stable")
            shards = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
            least = np.concatenate([_least([strings[i] for i in own.tolist()], least[own], length) for own in shards])
        runs, place = _Runs.of(least, windows[order]), np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        out = [runs.packed(place[own]) for own in number]
        return pa.table({"block": group["block"], "bucket": group["bucket"], "answers": pa.array(out, pa.binary())})

    dealt = blocks.join(bits, "block").select("data", "sizes", "rest", "block", "bits")
    dealt = dealt.mapInArrow(cut_out, "block long, bucket int, strings binary, sizes binary, parts binary, owners binary")
    answers = stored(dealt.groupBy("bucket").applyInArrow(owned, "block long, bucket int, answers binary"), "suffix-answers")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answers")).alias("answers"))

    rest_type = blocks.schema["rest"].dataType.elementType
    added = T.StructType.fromDDL("text string, kept binary, n_bytes bigint, n_removed bigint, spans array<struct<begin: bigint, `end`: bigint>>")
    out_type = T.StructType([*rest_type.fields, *added.fields])

    def cut(batches):
        for batch, nth, block in _each(batches, id_field, length):
            gone = _covered(block, buckets, batch.column("bits")[nth].as_py(), batch.column("answers")[nth].as_py())
            yield _left(block, gone, out_type.names)

    joined = blocks.join(bits, "block", "left").join(answers, "block", "left")
    result = joined.select("data", "sizes", "rest", "block", "bits", "answers").mapInArrow(cut, out_type)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text_column}
    columns = [F.col("text").alias(c) if c == text_column else F.col(names[c]).alias(c) for c in docs.columns]
    return result.select(*columns, "kept", "n_bytes", "n_removed", "spans")


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each `first` on, `count` of them, one after another."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class _Runs:
    """Runs of windows with one owner: how many each string has, where in it they end, and the owners."""

    def __init__(self, count: np.ndarray, ends: np.ndarray, owners: np.ndarray):
        self.count, self.ends, self.owners = count, ends, owners
        self.first = np.cumsum(count) - count

    @classmethod
    def of(cls, owners: np.ndarray, windows: np.ndarray) -> "_Runs":
        """Of the owners of all windows, one string after another."""
        starts = np.cumsum(windows) - windows
        new = np.diff(owners, prepend=-1) != 0
        new[starts] = True
        begins = np.flatnonzero(new)
        of = np.searchsorted(starts, begins, side="right") - 1
        ends = np.append(begins[1:], len(owners)) - starts[of]
        return cls(np.bincount(of, minlength=len(windows)), ends, owners[begins])

    def packed(self, strings: np.ndarray) -> bytes:
        """Those of the strings of these numbers."""
        count = self.count[strings]
        at = _ragged(self.first[strings], count)
        return count.astype("<u4").tobytes() + self.ends[at].astype("<u4").tobytes() + self.owners[at].astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, answers: list[bytes], strings: list[int]) -> "_Runs":
        """The `packed` runs of several lots of so many strings, one lot after another."""
        count, ends, owners = [], [], []
        for answer, n in zip(answers, strings):
            count.append(np.frombuffer(answer, "<u4", n).astype(np.int64))
            held = int(count[-1].sum())
            ends.append(np.frombuffer(answer, "<u4", held, 4 * n).astype(np.int64))
            owners.append(np.frombuffer(answer, "<i8", held, 4 * (n + held)))
        return cls(*map(np.concatenate, (count, ends, owners)))


def _covered(block: _Block, buckets: int, bits: list[dict], answers: list[dict]) -> np.ndarray:
    """Which bytes of the block lie in a window that an earlier document holds."""
    first, _, ids, number, strings, bucket, _ = block.repeated(buckets, bits)
    if not strings:
        return np.zeros(len(block.data), dtype=bool)
    sent = {a["bucket"]: a["answers"] for a in answers}
    order = np.argsort(bucket, kind="stable")
    lots = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
    runs = _Runs.unpacked([sent[int(bucket[own[0]])] for own in lots], [len(own) for own in lots])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    begins = np.append(0, runs.ends[:-1])
    begins[runs.first] = 0
    count = runs.count[place[number]]
    at = _ragged(runs.first[place[number]], count)
    earlier = runs.owners[at] < np.repeat(ids, count)
    at, own = at[earlier], np.repeat(first, count)[earlier]
    n = len(block.data) + 1
    change = np.bincount(own + begins[at], minlength=n) - np.bincount(own + runs.ends[at] + block.length - 1, minlength=n)
    return np.cumsum(change[:-1]) > 0


def _left(block: _Block, gone: np.ndarray, names: list[str]) -> pa.RecordBatch:
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = block.offsets[:-1][block.offsets[:-1] < len(gone)]
    begins[inner] = gone[inner]
    first = np.flatnonzero(begins)
    ends = ~gone
    ends = np.append(ends, True)
    stop = np.flatnonzero(ends)
    last = stop[np.searchsorted(stop, first)] if len(first) else first
    doc = np.searchsorted(block.offsets, first, side="right") - 1
    last = np.minimum(last, block.offsets[doc + 1])
    texts, kept, removed, spans = [], [], [], []
    low = np.searchsorted(doc, np.arange(len(block.ids)))
    high = np.searchsorted(doc, np.arange(len(block.ids)), side="right")
    for n, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist())):
        own = range(low[n], high[n])
        left = block.data[a:b]
        if len(own):
            left = left[~gone[a:b]]
        left = left.tobytes()
        kept.append(left)
        texts.append(left.decode("utf-8", errors="ignore"))
        removed.append(b - a - len(left))
        spans.append([{"begin": int(first[i]) - a, "end": int(last[i]) - a} for i in own])
    sizes = np.diff(block.offsets)
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    added = [pa.array(texts, pa.string()), pa.array(kept, pa.binary()), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, span_type)]
    return pa.RecordBatch.from_arrays([*block.rest.flatten(), *added], names=names)


def digest(left: DataFrame) -> DataFrame:
    """Counts and the hash of the remaining bytes of each row of `repeated_bytes`."""
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

"""Token files compressed by Re-Pair, with random access to single documents.

Documents are dealt by doc_id into ranges, each range is written as shards of a bounded
number of ids. In a shard, the most frequent pairs of neighbouring symbols are replaced by
new symbols, again and again. The shard keeps the rules, the expansion length of each rule
and where each document begins in the compressed sequence, so that one document can be
decoded without the others. Pairs never cross the end of a document.

File format: a Parquet table, a row per shard: `part` and `shard` (their order is the order
of doc_id), `n_docs`, `n_tokens`, `before` (ids of
the same part in earlier shards), and `payload`, little-endian numbers after the magic word:
header (version, symbol bytes, alphabet, rules, symbols, documents; 8 bytes each), then
rules (two 4-byte symbols each), expansion lengths (8 bytes), where documents end in the
sequence (8 bytes), and the sequence. A document's own id lies in the column `doc_ids`.

Nulls: a null text is an empty document, which still has its end id; null doc_ids come
first. Rows with the same doc_id follow each other, ordered by a hash of the text. An empty
table gives no shards and no documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm.bpe import shared_encoder
from articlelake.llm.frames import rows, shuffle_partitions, slices, task_number, texts
from articlelake.runtime import run_folder

END_ID = 2
SHARD_TOKENS = 1 << 20
ROUNDS = 4
PAIRS_PER_ROUND = 1024
MIN_COUNT = 4
_MAGIC = b"RPR1"
_BUCKET_BITS = 18


def _bucket(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)
    return mixed >> np.uint32(32 - _BUCKET_BITS)


def frequent_pairs(symbols: np.ndarray, bucket: np.ndarray, most: int, least: int) -> np.ndarray:
    """Keys (left << 32 | right) of the most frequent neighbours, one a bucket at most.

    `bucket` holds the bucket of each pair, and one past the last where a document ends.
    Counting by buckets first leaves few positions to sort: a pair can't be more frequent
    than its bucket.
    """
    held = np.bincount(bucket, minlength=(1 << _BUCKET_BITS) + 1)[:-1]
    floor = max(least, int(np.partition(held, -2 * most)[-2 * most]))
    heavy = np.append(held >= floor, False)
    at = np.flatnonzero(heavy[bucket])
    keys, counts = np.unique(symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1], return_counts=True)
    order = np.lexsort((keys, -counts))[:most]
    keys = keys[order[counts[order] >= least]]
    own = _bucket((keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32))
    return keys[np.sort(np.unique(own, return_index=True)[1])]


def compress(ids: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS, most: int = PAIRS_PER_ROUND, least: int = MIN_COUNT) -> bytes:
    """Payload of documents `ids[: ends[0]], ids[ends[0] : ends[1]], ...`."""
    symbols = ids.astype(np.uint32)
    alphabet = int(symbols.max()) + 1 if len(symbols) else 1
    last = np.zeros(len(symbols), dtype=bool)
    last[ends[ends > 0] - 1] = True
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.int64)]
    size = np.ones(alphabet, dtype=np.int64)
    for _ in range(rounds):
        bucket = _bucket(symbols[:-1], symbols[1:])
        bucket[last[:-1]] = 1 << _BUCKET_BITS
        pairs = frequent_pairs(symbols, bucket, most, least)
        if not len(pairs):
            break
        left, right = (pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32)
        slot = np.full((1 << _BUCKET_BITS) + 1, -1, dtype=np.int32)
        slot[_bucket(left, right)] = np.arange(len(pairs))
        found = slot[bucket]
        hits = np.flatnonzero(found >= 0)
        which = found[hits].astype(np.int64)
        same = (symbols[hits] == left[which]) & (symbols[hits + 1] == right[which])
        hits, which = hits[same], which[same]
        # Of overlapping occurrences, every other one counts, from the left.
        begins = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        run = np.repeat(begins, np.diff(begins, append=len(hits)))
        chosen = (np.arange(len(hits)) - run) % 2 == 0
        hits, which = hits[chosen], which[chosen]
        used = np.flatnonzero(np.bincount(which, minlength=len(pairs)))
        number = np.zeros(len(pairs), dtype=np.uint32)
        number[used] = len(size) + np.arange(len(used))
        symbols[hits] = number[which]
        last[hits] = last[hits + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[hits + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules.append(np.stack([left[used], right[used]], axis=1))
        lengths.append(size[left[used]] + size[right[used]])
        size = np.concatenate([size, lengths[-1]])
    return pack_shard(symbols, np.concatenate(rules), np.concatenate(lengths), alphabet, last, ends)


def pack_shard(symbols, rules, lengths, alphabet, last, ends) -> bytes:
    width = 2 if alphabet + len(rules) <= 1 << 16 else 4
    # Ends of documents in the sequence; an empty document ends where the one before does.
    filled = np.diff(ends, prepend=0) > 0
    stops = np.concatenate([[0], np.flatnonzero(last) + 1])[np.cumsum(filled)]
    header = np.array([1, width, alphabet, len(rules), len(symbols), len(ends)], dtype="<i8")
    return b"".join(
        [_MAGIC, header.tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<i8").tobytes(), stops.astype("<i8").tobytes(), symbols.astype(f"<u{width}").tobytes()]
    )


class Shard:
    """Reader of one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != _MAGIC:
            raise ValueError("not a Re-Pair shard")
        version, width, self._alphabet, n_rules, n_symbols, self.n_docs = np.frombuffer(payload, "<i8", 6, 4).tolist()
        if version != 1:
            raise ValueError(f"unknown shard version {version}")
        at = 52
        self._rules = np.frombuffer(payload, "<u4", 2 * n_rules, at).reshape(-1, 2)
        at += 8 * n_rules
        self._lengths = np.frombuffer(payload, "<i8", n_rules, at)
        at += 8 * n_rules
        self._stops = np.frombuffer(payload, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self._symbols = np.frombuffer(payload, f"<u{width}", n_symbols, at)

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for, by the stored lengths."""
        out = np.ones(len(symbols), dtype=np.int64)
        rule = symbols >= self._alphabet
        out[rule] = self._lengths[symbols[rule].astype(np.int64) - self._alphabet]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.uint32)
        while (rule := symbols >= self._alphabet).any():
            at = np.flatnonzero(rule)
            begin = np.arange(len(symbols)) + np.cumsum(rule) - rule
            out = np.empty(len(symbols) + len(at), dtype=np.uint32)
            out[begin] = symbols
            pair = self._rules[symbols[at] - self._alphabet]
            out[begin[at]], out[begin[at] + 1] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols

    def document(self, nth: int) -> np.ndarray:
        """Ids of one document; only its own stretch of the sequence is decoded."""
        return self.expand(self._symbols[self._stops[nth - 1] if nth else 0 : self._stops[nth]])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document ends in them."""
        ends = np.concatenate([[0], np.cumsum(self.sizes(self._symbols))])
        return self.expand(self._symbols), ends[self._stops]


SHARDS = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())]
)
_SHARDS_SQL = "part int, shard int, n_docs long, n_tokens long, before long, doc_ids array<long>, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode `texts` of documents and write the shards under `path`, in the order of doc_id.

    A shard is closed when it holds `shard_tokens` ids; a longer document makes a longer one.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = shared_encoder(tokenizer), task_number(), 0
        end = np.array([END_ID], dtype=encoder.dtype).tobytes()
        doc_ids, held, ends, total, before = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            payload = compress(np.frombuffer(b"".join(held), dtype=encoder.dtype), np.array(ends, dtype=np.int64))
            return rows(SHARDS, part=[part], shard=[shard], n_docs=[len(ends)], n_tokens=[total], before=[before], doc_ids=[doc_ids], payload=[payload])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                held.append(ids)
                total += len(ids) // encoder.dtype.itemsize
                doc_ids.append(doc_id)
                ends.append(total)
                if total >= shard_tokens:
                    yield closed()
                    before, shard = before + total, shard + 1
                    doc_ids, held, ends, total = [], [], [], 0
        if ends:
            yield closed()

    tie = F.xxhash64("text")
    ranged = docs.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", tie)
    ordered = ranged.sortWithinPartitions("doc_id", tie).select("doc_id", "text")
    ordered.mapInArrow(encode, _SHARDS_SQL).write.parquet(path)


DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
)


def read(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """Decode all documents: doc_id, start, n_tokens, ids_crc32 and the ids (packed, 4 bytes each).

    `start` counts the ids of all documents before. The sums collected for it are one per
    part, and there is one part per task of the writing stage.
    """
    shards = spark.read.schema(_SHARDS_SQL).parquet(path)
    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    totals = np.zeros(max([r["part"] for r in sums], default=-1) + 1, dtype=np.int64)
    for r in sums:
        totals[r["part"]] = r["n"]
    bases = np.cumsum(totals) - totals

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for nth in range(batch.num_rows):
                part, before, doc_ids, payload = (column[nth].as_py() for column in batch.columns)
                ids, ends = Shard(payload).documents()
                ids = ids.astype("<u4")
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                own = [ids[a:b].tobytes() for a, b in zip(begins, ends)]
                yield rows(
                    DOCUMENTS,
                    doc_id=doc_ids,
                    start=begins + before + bases[part],
                    n_tokens=ends - begins,
                    ids_crc32=[zlib.crc32(x) for x in own],
                    ids=own if keep_ids else [None] * len(own),
                )

    named = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    return shards.select("part", "before", "doc_ids", "payload").mapInArrow(decode, named)


def write_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Round trip of `docs` through a new folder of the shared one."""
    path = run_folder(docs.sparkSession, "repair")
    write(texts(docs), path, tokenizer)
    return read(docs.sparkSession, path, keep_ids=False)

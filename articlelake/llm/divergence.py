"""How far the sources of a language differ in their words, over the terms in enough documents.

Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z lower-cased. Which
terms are in `least` documents of a language is found by refining prefixes: first the
prefixes of four bytes are counted by distinct document, those below the threshold are
discarded with all their terms, and the others are extended to eight bytes, sixteen and so
on, until the terms left are complete. A term as long as the prefix or shorter is complete
at that level; prefixes of longer terms are counted apart from it.

Texts are read once, into blocks of documents that hold each term once and (document,
term, count) by number. Blocks are a table bucketed by block, which no level shuffles: a
block sends its counts of live prefixes and gets back the numbers of those that are kept,
so a term with a rare prefix is never sent whole. Counts of kept terms are summed per block
and go to buckets of terms in packed runs: a hot language, source or term is one number per
block. A bucket then holds all counts of its terms, and what follows is computed there.

Nulls: null texts, languages and sources count as ''. Every row is a document, whatever its
id; repeated rows count as often as they occur. A group without a kept term has counts of
0. A text of any length is taken in stretches of a megabyte; a block holds it whole. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.frames import rows, shuffle_partitions, slices, task_number
from articlelake.runtime import run_folder

LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
BLOCK_BYTES = 16 << 20
_FIRST_PREFIX = 4
_STRETCH = 1 << 20
_TILE = 512  # sources

# --- fixed values (bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F], A-Z lower-cased) ---
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
# -------------------------------------------------------------------------------


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """All terms of a text in order, a stretch at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _STRETCH)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


_BLOCK_SQL = (
    "block long, langs array<string>, sources array<string>, group_of binary, terms binary, per_doc binary, term binary, n binary"
)
_BLOCK = pa.schema(
    [("block", pa.int64()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string()))]
    + [(name, pa.binary()) for name in ("group_of", "terms", "per_doc", "term", "n")]
)


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 in the fewest bytes that hold the greatest, behind one byte that says how many."""
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if int(values.max(initial=0)) < 1 << 8 * int(k[2]))
    return kind[2].encode() + values.astype(kind).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[:1].decode()}", offset=1).astype(np.int64)


def _rising(values: np.ndarray) -> bytes:
    """Rising numbers, packed as their steps."""
    return _packed(np.diff(values, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


def _steps(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers that rise within stretches of the given lengths, as steps from the one before; the first of a stretch stays."""
    steps = np.diff(values, prepend=0)
    first = (np.cumsum(lengths) - lengths)[lengths > 0]
    steps[first] = values[first]
    return steps


def _stepped(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(steps)])
    first = np.cumsum(lengths) - lengths
    return total[1:] - np.repeat(total[first], lengths)


class _Builder:
    """Documents until they make a block."""

    def __init__(self):
        self.docs: list[tuple[str, str]] = []
        self.size = 0
        self._entries: list[np.ndarray] = []
        self._numbers: dict[bytes, int] = {}

    def add(self, lang: str, source: str, text: str | None) -> None:
        numbers, found = self._numbers, []
        for words in terms_of(text):
            own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int32, count=len(words))
            found.append(np.stack(np.unique(own, return_counts=True)).astype(np.int32))
        if len(found) > 1:
            term, where = np.unique(np.concatenate(found, axis=1)[0], return_inverse=True)
            n = np.bincount(where, weights=np.concatenate(found, axis=1)[1])
            found = [np.stack([term, n.astype(np.int32)])]
        self._entries.append(found[0] if found else np.zeros((2, 0), dtype=np.int32))
        self.docs.append((lang, source))
        self.size += len(text or "")

    def block(self, number: int) -> pa.RecordBatch:
        order = sorted(self._numbers)
        rank = np.empty(len(order), dtype=np.int64)
        rank[[self._numbers[t] for t in order]] = np.arange(len(order))
        per_doc = np.array([e.shape[1] for e in self._entries], dtype=np.int64)
        term, n = np.concatenate(self._entries, axis=1)
        term = rank[term]
        by = np.argsort(np.repeat(np.arange(len(per_doc)) * max(len(order), 1), per_doc) + term)
        groups = sorted(set(self.docs))
        at = {g: i for i, g in enumerate(groups)}
        return rows(
            _BLOCK,
            block=[number],
            langs=[[g[0] for g in groups]],
            sources=[[g[1] for g in groups]],
            group_of=[_packed(np.array([at[d] for d in self.docs]))],
            terms=[b" ".join(order)],
            per_doc=[_packed(per_doc)],
            term=[_packed(_steps(term[by], per_doc))],
            n=[_packed(n[by])],
        )


class _Block:
    """One block at the level of prefixes of `size` bytes: terms longer than half of that."""

    def __init__(self, row: dict, size: int):
        self.number, self.size = row["block"], size
        self.sources, self.group_langs = row["sources"], row["langs"]
        self.terms = row["terms"].split()
        self.langs = sorted(set(self.group_langs))
        at = {lang: i for i, lang in enumerate(self.langs)}
        group_of, per_doc = _unpacked(row["group_of"]).astype(np.int32), _unpacked(row["per_doc"])
        self.doc = np.repeat(np.arange(len(per_doc), dtype=np.int32), per_doc)
        self.group = np.repeat(group_of, per_doc)
        self.lang = np.array([at[x] for x in self.group_langs], dtype=np.int64)
        self.term = _stepped(_unpacked(row["term"]), per_doc).astype(np.int32)
        self.n = _unpacked(row["n"]).astype(np.int32)
        self.lengths = np.fromiter(map(len, self.terms), dtype=np.int64, count=len(self.terms))

    def prefixes(self, size: int) -> tuple[list[tuple[bytes, bool]], np.ndarray]:
        """Distinct (prefix, whether that is the whole term) in order, and which one each term has, -1 if it is too short."""
        found, of = [], np.full(len(self.terms), -1, dtype=np.int32)
        for i in np.flatnonzero(self.lengths > (size // 2 if size > _FIRST_PREFIX else 0)).tolist():
            own = (self.terms[i][:size], len(self.terms[i]) <= size)
            if not found or found[-1] != own:
                found.append(own)
            of[i] = len(found) - 1
        return found, of

    def alive(self, size: int, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries whose prefix of `size` bytes is kept: those of complete terms, those that go on."""
        found, of = self.prefixes(size)
        entries = np.flatnonzero(of[self.term] >= 0).astype(np.int32)
        held = np.zeros(len(self.langs) * max(len(found), 1), dtype=bool)
        held[kept] = True
        entries = entries[held[self.lang[self.group[entries]] * len(found) + of[self.term[entries]]]]
        complete = self.lengths[self.term[entries]] <= size
        return entries[complete], entries[~complete]

    def _buckets(self, names: list[bytes], buckets: int) -> np.ndarray:
        return np.fromiter((zlib.crc32(x) % buckets for x in names), dtype=np.int64, count=len(names))

    def counts(self, entries: np.ndarray, buckets: int) -> dict[str, list]:
        """Occurrences per group of the terms of some entries: a run per language and bucket of terms.

        A run names its terms once; `per_name` says in how many sources each of them is.
        """
        width = max(len(self.terms), 1)
        sources = len(self.sources)
        key, where = np.unique(self.term[entries].astype(np.int64) * sources + self.group[entries], return_inverse=True)
        total = np.bincount(where, weights=self.n[entries], minlength=len(key)).astype(np.int64)
        group, term = key % max(sources, 1), key // max(sources, 1)
        used = np.unique(term)
        bucket_of = np.zeros(width, dtype=np.int64)
        bucket_of[used] = self._buckets([self.terms[t] for t in used.tolist()], buckets)
        bucket = bucket_of[term]
        lang = self.lang[group]
        by = np.lexsort((group, term, bucket, lang))
        out = _no_runs()
        for own in _cut(by, lang, bucket):
            terms, per_term = np.unique(term[own], return_counts=True)
            shown, source = np.unique(group[own], return_inverse=True)
            out["lang"].append(self.langs[lang[own[0]]])
            out["bucket"].append(int(bucket[own[0]]))
            out["names"].append(b" ".join([self.terms[t] for t in terms.tolist()]))
            out["sources"].append([self.sources[g] for g in shown.tolist()])
            out["numbers"].append(_packed(source))
            out["per_name"].append(_packed(per_term))
            out["n"].append(_packed(total[own]))
            out["complete"].append(None)
        return out

    def prefix_counts(self, entries: np.ndarray, size: int, buckets: int) -> dict[str, list]:
        """Distinct documents of each (language, prefix) of some entries: a run per language, bucket and completeness.

        `numbers` are what the block knows them by.
        """
        found, of = self.prefixes(size)
        out = _no_runs()
        if not found or not len(entries):
            return out
        prefix, doc = of[self.term[entries]], self.doc[entries]
        new = np.ones(len(prefix), dtype=bool)  # the first entry of a document with the prefix
        new[1:] = (doc[1:] != doc[:-1]) | (prefix[1:] != prefix[:-1])
        counts = np.bincount(self.lang[self.group[entries[new]]] * len(found) + prefix[new])
        key = np.flatnonzero(counts)
        lang, at = key // len(found), key % len(found)
        used = np.unique(at)
        bucket_of = np.zeros(len(found), dtype=np.int64)
        bucket_of[used] = self._buckets([found[i][0] for i in used.tolist()], buckets)
        whole = np.array([c for _, c in found], dtype=np.int64)[at]
        bucket = bucket_of[at]
        by = np.lexsort((at, whole, bucket, lang))
        for own in _cut(by, lang, bucket, whole):
            out["lang"].append(self.langs[lang[own[0]]])
            out["bucket"].append(int(bucket[own[0]]))
            out["complete"].append(bool(whole[own[0]]))
            out["names"].append(b" ".join([found[i][0] for i in at[own].tolist()]))
            out["numbers"].append(_rising(key[own]))
            out["n"].append(_packed(counts[key[own]]))
            out["sources"].append(None)
            out["per_name"].append(None)
        return out


def _cut(by: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The ordered rows in runs of equal columns."""
    if not len(by):
        return []
    differs = np.zeros(len(by) - 1, dtype=bool)
    for c in columns:
        differs |= np.diff(c[by]) != 0
    return np.split(by, np.flatnonzero(differs) + 1)


def _no_runs() -> dict[str, list]:
    return {name: [] for name in ("lang", "bucket", "complete", "names", "numbers", "n", "sources", "per_name")}


# Rows of a level are runs of names in a bucket: prefixes with their documents in a block
# (`complete` says whether those are terms), and kept terms with their counts in its sources.
_LEVEL_SQL = (
    "block long, lang string, bucket int, complete boolean, names binary, numbers binary, n binary, sources array<string>, per_name binary"
)
_LEVEL = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("bucket", pa.int32()), ("complete", pa.bool_())]
    + [(name, pa.binary()) for name in ("names", "numbers", "n")]
    + [("sources", pa.list_(pa.string())), ("per_name", pa.binary())]
)


def _level_rows(block: int, columns: dict[str, list]) -> pa.RecordBatch:
    return rows(_LEVEL, block=[block] * len(columns["lang"]), **columns)


def _blocks(docs: DataFrame) -> tuple[DataFrame, str]:
    """Blocks of rows (lang, source, text), stored as a table bucketed by block, and the name of that table."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, builder = task_number() << 32, _Builder()
        for batch in slices(batches):
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                builder.add(*row)
                if builder.size >= BLOCK_BYTES:
                    yield builder.block(number)
                    number, builder = number + 1, _Builder()
        if builder.docs:
            yield builder.block(number)

    spark, name = docs.sparkSession, f"term_blocks_{uuid.uuid4().hex}"
    writer = docs.mapInArrow(build, _BLOCK_SQL).write.bucketBy(shuffle_partitions(spark), "block")
    writer.options(compression="zstd", path=run_folder(spark, "term-blocks")).saveAsTable(name)
    return spark.table(name), name


def _first_level(blocks: DataFrame, buckets: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row in batch.to_pylist():
                own = _Block(row, _FIRST_PREFIX)
                yield _level_rows(own.number, own.prefix_counts(np.arange(len(own.term)), _FIRST_PREFIX, buckets))

    return blocks.mapInArrow(count, _LEVEL_SQL)


def _kept_numbers(least: int):
    """Of the runs of one bucket, the numbers of the prefixes in enough documents, a row per run."""
    schema = pa.schema([("own", pa.int64()), ("kept", pa.binary())])

    def choose(runs: pa.Table) -> pa.Table:
        seen: dict[tuple[bool, bytes], int] = {}
        at, docs = [], []
        complete = runs.column("complete").to_pylist()
        for names, whole, n in zip(runs.column("names").to_pylist(), complete, runs.column("n").to_pylist()):
            held = names.split(b" ")
            at.append(np.fromiter((seen.setdefault((whole, x), len(seen)) for x in held), dtype=np.int64, count=len(held)))
            docs.append(_unpacked(n))
        everywhere = np.zeros(len(seen), dtype=np.int64)
        np.add.at(everywhere, np.concatenate(at), np.concatenate(docs))
        enough = everywhere >= least
        kept = [_risen(x)[enough[i]] for x, i in zip(runs.column("numbers").to_pylist(), at)]
        some = [i for i, k in enumerate(kept) if len(k)]
        block = runs.column("block").to_pylist()
        return pa.table({"own": [block[i] for i in some], "kept": [_rising(kept[i]) for i in some]}, schema=schema)

    return choose


def _next_level(blocks: DataFrame, level: DataFrame, size: int, least: int, buckets: int) -> DataFrame:
    """Keep the prefixes of `size` bytes in enough documents; count those of twice as many bytes.

    A prefix is summed over its runs, one per block at most; blocks are only read, not shuffled.
    """
    sent = level.where(F.col("complete").isNotNull())
    kept = sent.groupBy("lang", "bucket").applyInArrow(_kept_numbers(least), "own long, kept binary")

    def refine(states: pa.Table, own: pa.Table) -> pa.Table:
        found = []
        for row in states.to_pylist():
            block = _Block(row, size)
            numbers = [_risen(x) for x in own.column("kept").to_pylist()]
            done, on = block.alive(size, np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64))
            found.append(_level_rows(block.number, block.counts(done, buckets)))
            found.append(_level_rows(block.number, block.prefix_counts(on, 2 * size, buckets)))
        return pa.Table.from_batches(found, _LEVEL)

    return blocks.groupBy("block").cogroup(kept.groupBy("own")).applyInArrow(refine, _LEVEL_SQL)


_BUCKET_SQL = "lang string, bucket int, terms binary, sources array<string>, totals array<long>, v long, source binary, term binary, n binary"
_BUCKET = pa.schema(
    [("lang", pa.string()), ("bucket", pa.int32()), ("terms", pa.binary()), ("sources", pa.list_(pa.string()))]
    + [("totals", pa.list_(pa.int64())), ("v", pa.int64())]
    + [(name, pa.binary()) for name in ("source", "term", "n")]
)


def _merged(key: tuple, runs: pa.Table) -> pa.Table:
    """All counts of the terms of one bucket: (source, term, n) by number, sorted by source and term."""
    named = runs.column("sources").to_pylist()
    sources = sorted({s for own in named for s in own})
    at = {s: i for i, s in enumerate(sources)}
    numbers: dict[bytes, int] = {}
    source, term, n = [], [], []
    for own, names, per_name, number, counts in zip(named, *(runs.column(c).to_pylist() for c in ("names", "per_name", "numbers", "n"))):
        held = names.split(b" ")
        each = np.fromiter((numbers.setdefault(t, len(numbers)) for t in held), dtype=np.int64, count=len(held))
        term.append(np.repeat(each, _unpacked(per_name)))
        source.append(np.array([at[s] for s in own], dtype=np.int64)[_unpacked(number)])
        n.append(_unpacked(counts))
    order = sorted(numbers)
    rank = np.empty(len(order), dtype=np.int64)
    rank[[numbers[t] for t in order]] = np.arange(len(order))
    pair, where = np.unique(np.concatenate(source) * len(order) + rank[np.concatenate(term)], return_inverse=True)
    total = np.zeros(len(pair), dtype=np.int64)
    np.add.at(total, where, np.concatenate(n))
    per_source = np.zeros(len(sources), dtype=np.int64)
    np.add.at(per_source, pair // len(order), total)
    return pa.Table.from_batches(
        [
            rows(
                _BUCKET,
                lang=[key[0].as_py()],
                bucket=[key[1].as_py()],
                terms=[b" ".join(order)],
                sources=[sources],
                totals=[per_source],
                v=[len(order)],
                source=[_packed(pair // len(order))],
                term=[_packed(pair % len(order))],
                n=[_packed(total)],
            )
        ]
    )


def _stored(frame: DataFrame, purpose: str) -> DataFrame:
    path = run_folder(frame.sparkSession, purpose)
    frame.write.parquet(path, compression="zstd")
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def kept_counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """Counts of the terms in at least `least` documents of their language, a row per language and bucket of terms.

    `docs` has lang, source and text without nulls. One level doubles the length of the
    prefixes, so there are as many as the longest kept prefix has binary digits. There are
    as many buckets as blocks, so that a bucket holds about as much as a block.
    """
    spark = docs.sparkSession
    blocks, name = _blocks(docs.select("lang", "source", "text"))
    try:
        buckets = max(1, blocks.count())
        size, level, runs = _FIRST_PREFIX, _first_level(blocks, buckets), []
        while True:
            level = _stored(_next_level(blocks, level, size, least, buckets), "terms-level")
            runs.append(level.where(F.col("complete").isNull()).drop("block", "complete"))
            if level.where(F.col("complete").isNotNull()).isEmpty():
                break
            size *= 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    whole = reduce(DataFrame.unionByName, runs)
    return _stored(whole.groupBy("lang", "bucket").applyInArrow(_merged, _BUCKET_SQL), "terms-kept")


def counts(kept: DataFrame) -> DataFrame:
    """(lang, source, term, n) rows of `kept_counts`."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            names = [bucket.sources[i] for i in bucket.source.tolist()]
            terms = [bucket.terms[i] for i in bucket.term.tolist()]
            yield rows(schema, lang=[bucket.lang] * len(names), source=names, term=terms, n=bucket.n)

    return kept.mapInArrow(unpack, "lang string, source string, term string, n long")


class _Bucket:
    def __init__(self, row: dict):
        self.lang, self.sources = row["lang"], row["sources"]
        self.terms = row["terms"].decode("utf-8", "surrogatepass").split(" ")
        self.source, self.term, self.n = (_unpacked(row[c]) for c in ("source", "term", "n"))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[_Bucket]:
    for batch in slices(batches):
        for row in batch.to_pylist():
            yield _Bucket(row)


def share(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly.

    The quotient is taken in steps, so that nothing goes beyond 64 bits: the count is below
    its total, which may have up to 33 bits more than SCALE leaves.
    """
    above, below = count.astype(np.int64) + PRIOR, np.asarray(total, dtype=np.int64) + PRIOR * terms
    out, left = np.zeros(np.broadcast_shapes(above.shape, below.shape), dtype=np.int64), above
    for digit in (1000, 1000, 1000):  # their product is SCALE
        left = left * digit
        out = out * digit + left // below
        left = left % below
    return out + 1


def _in_langs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of `kept_counts` with the sources of their language in tiles: all, left and right.

    A row goes to each pair of tiles; there is one tile up to `_TILE` sources.
    """
    numbered = Window.partitionBy("lang").orderBy("source")
    tiled = groups.withColumn("tile", F.floor((F.row_number().over(numbered) - 1) / _TILE).cast("int"))
    side = F.array_sort(F.collect_list(F.struct("source", "total")))
    tiles = tiled.groupBy("lang", "v", "tile").agg(side.alias("side"))
    left = tiles.select("lang", F.col("v").alias("all_terms"), F.col("side").alias("left"))
    right = tiles.select("lang", F.col("side").alias("right"))
    return kept.join(left, "lang").join(right, "lang")


def _pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum over all kept terms of f, per language, source and other source, from partial sums per task.

    A task adds up one matrix for each pair of tiles it meets; only those pairs are made
    that the result has anyway.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, left, right), total in sums.items():
                yield rows(
                    schema,
                    lang=[lang] * total.size,
                    source=[s for s in left for _ in right],
                    item=list(right) * len(left),
                    value=total.ravel(),
                )
            sums.clear()

        for batch in slices(batches):
            for row in batch.to_pylist():
                bucket, width = _Bucket(row), row["v"]
                grids = []
                for side in (row["left"], row["right"]):
                    at = {s["source"]: i for i, s in enumerate(side)}
                    number = np.array([at.get(s, -1) for s in bucket.sources], dtype=np.int64)[bucket.source]
                    here = number >= 0
                    grid = np.zeros((len(side), width), dtype=np.int64)
                    grid[number[here], bucket.term[here]] = bucket.n[here]
                    grids.append(share(grid, np.array([[s["total"]] for s in side]), row["all_terms"]))
                key = (bucket.lang, *(tuple(s["source"] for s in row[side]) for side in ("left", "right")))
                total = sums.setdefault(key, np.zeros((len(grids[0]), len(grids[1])), dtype=np.int64))
                for i, own in enumerate(grids[0]):
                    total[i] += np.abs(grids[1] - own).sum(axis=1)
                if len(sums) > 16:
                    yield from sent()
        yield from sent()

    per_task = _in_langs(kept, groups).mapInArrow(compare, "lang string, source string, item string, value long")
    return per_task.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _own_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The terms of each source with p > q, the `top` best of each bucket of terms: (lang, source, item, value)."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    sources = groups.groupBy("lang", "v", "lang_total").agg(F.collect_list(F.struct("source", "total")).alias("totals"))
    named = kept.drop("totals", "v").join(sources, "lang")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for row in batch.to_pylist():
                bucket = _Bucket(row)
                total = {s["source"]: s["total"] for s in row["totals"]}
                of_lang = np.zeros(len(bucket.terms), dtype=np.int64)
                np.add.at(of_lang, bucket.term, bucket.n)
                q = share(of_lang, np.array(row["lang_total"]), row["v"])
                p = share(bucket.n, np.array([total[s] for s in bucket.sources])[bucket.source], row["v"])
                value = p - q[bucket.term]
                more = np.flatnonzero(value > 0)
                more = more[np.lexsort((bucket.term[more], -value[more], bucket.source[more]))]
                source = bucket.source[more]
                first = np.searchsorted(source, source)
                more = more[np.arange(len(more)) - first < top]
                yield rows(
                    schema,
                    lang=[bucket.lang] * len(more),
                    source=[bucket.sources[i] for i in bucket.source[more].tolist()],
                    item=[bucket.terms[i] for i in bucket.term[more].tolist()],
                    value=value[more],
                )

    return named.mapInArrow(choose, "lang string, source string, item string, value long")


def divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by distance, and each source's own terms.

    Part `pair` ranks the other sources of the language by the sum of differences over all
    kept terms, part `term` the `top` terms that the source uses more than its language.
    """
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = kept_counts(plain, least)
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("t"))
    totals = totals.groupBy("lang", F.col("t.sources").alias("source")).agg(F.sum("t.totals").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("v").alias("v"), F.sum(F.aggregate("totals", F.lit(0).cast("long"), lambda a, x: a + x)).alias("lang_total"))
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = _stored(groups.na.fill(0, ["total", "v", "lang_total"]), "terms-groups")

    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.join(_pair_sums(kept, groups), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    own = _own_terms(kept, groups, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(own.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))

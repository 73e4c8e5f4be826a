import hashlib

import numpy as np
import pyarrow as pa
import pytest

from articlelake.llm import suffix_dedup
from tests.llm.conftest import prose


def brute_force(rows, length):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            if d is not None:
                least[b[i : i + length]] = min(d, least.get(b[i : i + length], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if d is not None and least[b[i : i + length]] < d:
                gone[i : i + length] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), len(b) - len(left), int(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, block", [(50, 1 << 21), (20, 2000)])
def test_matches_brute_force(docs, planted_rows, length, block):
    found = suffix_dedup.repeated_bytes(docs, length=length, block_bytes=block)
    assert sorted(map(tuple, suffix_dedup.digest(found).collect()), key=str) == brute_force(planted_rows, length)


def test_a_hot_anchor_is_spread_over_tasks(spark, docs, planted_rows, monkeypatch):
    """A phrase between other bytes in every document; the same rows in small parts and shards."""
    rows = [(i, f"{prose(i, 12)} The same sixteen bytes, always {prose(700 + i % 40, 12)}") for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    made, real = [], suffix_dedup.stored

    def spy(kept, purpose):
        made.append((purpose, real(kept, purpose)))
        return made[-1][1]

    monkeypatch.setattr(suffix_dedup, "stored", spy)
    found = suffix_dedup.repeated_bytes(frame, block_bytes=4000, hot=20)
    assert sorted(map(tuple, suffix_dedup.digest(found).collect()), key=str) == brute_force(rows, 50)
    answers = dict(made)["suffix-answers"].groupBy("bucket").count().collect()
    assert len(answers) > 40
    found = suffix_dedup.repeated_bytes(docs, length=20, block_bytes=2000, hot=1)
    assert sorted(map(tuple, suffix_dedup.digest(found).collect()), key=str) == brute_force(planted_rows, 20)


def test_distinct_stretches_are_counted():
    texts = [prose(i % 3, 40).encode() for i in range(9)] + [b"a" * 200]
    offsets = np.cumsum([0, *map(len, texts)])
    first, windows, hashes, _ = suffix_dedup.stretches(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets, 50)
    whole, expected = b"".join(texts), {}
    for a, n, h in zip(first.tolist(), windows.tolist(), hashes.tolist()):
        expected.setdefault(h, set()).add(whole[a : a + n + 49])
    sizes, rest = pa.array([np.diff(offsets).tolist()]), pa.array([[{"id": i} for i in range(len(texts))]])
    batch = pa.RecordBatch.from_arrays([pa.array([whole]), sizes, rest], names=["data", "sizes", "rest"])
    block = suffix_dedup._Block(batch, 0, 0, 50)
    assert dict(zip(block.anchors.tolist(), block.distinct().tolist())) == {h: len(x) for h, x in expected.items()}


def test_rows_keep_their_columns_and_text_follows(docs):
    found = suffix_dedup.repeated_bytes(docs)
    assert {"doc_id", "text", "lang", "source", "n_chars", "rank", "block"} <= set(found.columns)
    row = found.where("doc_id = 301").first()
    assert row["text"].encode() == bytes(row["kept"]) and row["n_removed"] >= len(prose(99, 60))
    assert sum(s["end"] - s["begin"] for s in row["spans"]) == row["n_removed"]


def test_shards_of_one_bucket_are_merged():
    rng = np.random.default_rng(3)
    pool = [bytes(rng.integers(97, 100, 40, dtype=np.uint8)) for _ in range(30)]
    strings = list(dict.fromkeys(pool[a] + pool[b] for a, b in rng.integers(0, 30, (200, 2))))
    owners = rng.permutation(len(strings)).astype(np.int64)
    whole = suffix_dedup.least_owners(strings, owners, 50)
    parts = suffix_dedup.least_owners(strings, owners, 50, shard_bytes=1000)
    expected = {}
    for s, o in zip(strings, owners.tolist()):
        for i in range(len(s) - 49):
            expected[s[i : i + 50]] = min(o, expected.get(s[i : i + 50], o))
    for s, a, b in zip(strings, whole, parts):
        want = [expected[s[i : i + 50]] for i in range(len(s) - 49)]
        assert a.tolist() == want and b.tolist() == want


@pytest.mark.parametrize("text", [b"banana", b"a" * 60, b"mississippi" * 9, bytes(range(256)), b"x"])
def test_suffix_array_and_common_prefixes(text):
    symbols = np.frombuffer(text, dtype=np.uint8).astype(np.int16) + 1
    order, rank = suffix_dedup.suffix_array(symbols)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    shared = suffix_dedup.common_prefixes(symbols, order, rank, np.array([0]), np.array([len(text)]))
    for a, b in zip(order[:-1], order[1:]):
        n = 0
        while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert shared[b] == n


def test_empty_table(no_docs):
    assert suffix_dedup.repeated_bytes(no_docs).collect() == []

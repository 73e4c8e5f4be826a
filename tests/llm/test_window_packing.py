import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from articlelake.llm import window_packing
from articlelake.llm.bpe import default_path


@pytest.mark.parametrize("seed", range(60))
def test_closest_sum_is_the_best(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(0, 3) for _ in range(rng.randint(0, 6))}
    room = rng.randint(0, 60)
    taken = window_packing.closest(room, counts)
    every = (sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*(range(c + 1) for c in counts.values())))
    assert sum(n * k for n, k in taken.items()) == max(s for s in every if s <= room)
    assert all(0 < k <= counts[n] for n, k in taken.items())


def laid_out(counts, window):
    """All windows of a plan, checked: every id once, no gaps, and no padding."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for whole, at, rank, n, length, first, before, each, offset in window_packing.plan(counts, window).tolist():
        for i in range(n):
            pieces[whole, rank + i].append((at, length))
            windows[first + (before + i) // each].append((offset + (before + i) % each * length, length))
    assert set(pieces) == {(n, r) for n, c in counts.items() for r in range(c)}
    for (whole, _), parts in pieces.items():
        assert [at for at, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        assert sum(n for _, n in parts) == whole
    assert sorted(windows) == list(range(len(windows)))
    sizes = []
    for parts in windows.values():
        assert [at for at, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        sizes.append(sum(n for _, n in parts))
    assert all(s & (s - 1) == 0 and s <= window for s in sizes)
    assert sum(s < window for s in sizes) == (sum(n * c for n, c in counts.items()) % window).bit_count()
    return pieces


@pytest.mark.parametrize("seed", range(20))
def test_plan_fills_every_window(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 64, 1024])
    laid_out({rng.randint(1, window): rng.randint(0, 40) for _ in range(rng.randint(1, 200))}, window)


def test_documents_are_cut_only_where_nothing_fits():
    pieces = laid_out({600: 10, 424: 10, 200: 5, 24: 1, 1024: 3}, 1024)
    assert all(len(parts) == 1 for parts in pieces.values())
    pieces = laid_out({1000: 64}, 1024)  # every window is filled with a part of another document
    assert sum(len(parts) - 1 for parts in pieces.values()) <= 64 + 20


def test_plan_depends_on_lengths_only():
    much = window_packing.plan({n: 10**9 // n for n in range(1, 1025)})
    assert len(much) < 20_000
    few = window_packing.plan({n: 10**5 // n for n in range(1, 1025)})
    assert len(much) < 3 * len(few)


@pytest.mark.parametrize("window", [1024, 16])
def test_pieces_hold_the_library_ids(spark, docs, planted_rows, window):
    tokenizer = Tokenizer.from_file(default_path())
    held = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in planted_rows]
    found = window_packing.pack_documents(docs, window=window)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    found = found.collect()
    assert sum(r["length"] for r in found) == sum(len(ids) for _, ids in held)
    expected = defaultdict(list)
    for d, ids in held:
        expected[d].append(ids)
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == set(expected)
    for d, parts in by_doc.items():
        cover = sorted((r["start"], r["length"]) for r in parts)
        if len(expected[d]) == 1:
            assert [s for s, _ in cover] == [0, *itertools.accumulate(n for _, n in cover)][:-1]
        for r in parts:
            crcs = [zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for ids in expected[d]]
            assert r["ids_crc32"] in crcs and r["doc_tokens"] in [len(ids) for ids in expected[d]]
    windows = defaultdict(list)
    for r in found:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in windows.values():
        assert [at for at, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1]
        size = sum(n for _, n in parts)
        assert size == window or size & (size - 1) == 0


def test_sequences_hold_the_ids_in_order(spark, docs):
    placed = window_packing.pack_documents(docs, window=64, keep_ids=True)
    by_place = {(r["sequence_id"], r["offset"]): r for r in placed.collect()}
    whole = window_packing.sequences(placed).collect()
    assert {r["sequence_id"] for r in whole} == {s for s, _ in by_place}
    for r in whole:
        ids = np.frombuffer(r["ids"], "<u2")
        for p in r["pieces"]:
            own = by_place[r["sequence_id"], p["offset"]]
            assert zlib.crc32(ids[p["offset"] : p["offset"] + own["length"]].astype("<u4").tobytes()) == own["ids_crc32"]


def test_no_documents(spark, no_docs):
    assert window_packing.pack_documents(no_docs).count() == 0
    alone = spark.createDataFrame([(5, None)], "doc_id long, text string")
    assert [tuple(r)[:3] + tuple(r)[4:] for r in window_packing.pack_documents(alone).collect()] == [(5, 0, 1, 1, 0, 0)]

import random

import numpy as np
import pytest

from articlelake.llm import suffix_dedup


@pytest.mark.parametrize("piece", [1, 60, 500])
def test_documents_are_hashed_a_piece_at_a_time(monkeypatch, piece):
    chosen = random.Random(5)
    texts = [bytes(chosen.choices(b"ab", k=chosen.choice([0, 3, 49, 50, 51, 200, 900]))) for _ in range(40)]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    whole, held, inner = suffix_dedup.stretches(data, offsets, 50), [], suffix_dedup._stretches
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    monkeypatch.setattr(suffix_dedup, "_stretches", lambda d, o, n: held.append((len(d), len(o))) or inner(d, o, n))
    for a, b in zip(whole, suffix_dedup.stretches(data, offsets, 50)):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    assert all(size <= piece or ends == 2 for size, ends in held) and sum(size for size, _ in held) == len(data)
    none = suffix_dedup.stretches(data[:0], np.zeros(1, dtype=np.int64), 50)
    assert [len(x) for x in none] == [0] * 4


def test_runs_of_many_strings_are_packed_together():
    chosen = random.Random(3)
    windows = [[chosen.choice([-1, 7, 2**40]) for _ in range(chosen.randint(1, 9))] for _ in range(60)]
    runs = suffix_dedup._Runs.of(np.concatenate([np.array(w) for w in windows]), np.array([len(w) for w in windows]))
    lots = [[3, 3, 59, 0], [11], list(range(60))]
    got = suffix_dedup._Runs.unpacked([runs.packed(np.array(lot)) for lot in lots], [len(lot) for lot in lots])
    for place, string in enumerate(n for lot in lots for n in lot):
        own = slice(got.first[place], got.first[place] + got.count[place])
        lengths = np.diff(got.ends[own], prepend=0)
        assert np.repeat(got.owners[own], lengths).tolist() == windows[string]
        assert (np.diff(got.owners[own]) != 0).all()

import hashlib
import math

import numpy as np
import pytest

from articlelake.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, row string, position int, code string, error string"


def vectors():
    rng = np.random.default_rng(11)
    data = [(1000 - i, (rng.normal(size=12) * 0.3).tolist(), i % 5 if i % 7 else None) for i in range(400)]
    data += [(2000 + i, data[3][1], 9) for i in range(150)]  # a hot vector
    data += [(3000, None, 1), (3001, [float("nan")] * 12, 1), (3002, [math.inf] + [0.0] * 11, 1), (3003, [None] * 12, 1)]
    data += [(3004, [0.5, 0.25, -0.1], 2), (3005, [], 2), (3006, [0.0] * 12, None), (None, data[7][1], 3)]
    data += [data[5], data[5], (data[5][0], data[6][1], 4)]
    return data


def brute_force(rows, entries, rounds):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(4)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            got = [[] for _ in books[p]]
            for _, v, _ in kept:
                part = v[p * width : (p + 1) * width]
                got[near(part, books[p])[1]].append(part)
            books[p] = [[sum(c) // len(own) for c in zip(*own)] if own else e for own, e in zip(got, books[p])]
    out = []
    for i, v, lab in kept:
        found = [near(v[p * width : (p + 1) * width], books[p]) for p in range(4)]
        out.append((i, lab, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found)))
    totals = {}
    for _, lab, _, e in out:
        totals[lab] = totals.get(lab, 0) + e
    flat = ",".join(str(x) for book in books for e in book for x in e)
    return [(*r, totals[r[1]]) for r in out], hashlib.sha256(flat.encode()).hexdigest()


def by_text(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("entries, rounds, block", [(16, 4, 256), (256, 2, 3), (5, 1, 64), (16, 0, 256)])
def test_equals_brute_force(spark, monkeypatch, entries, rounds, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    frame = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in vectors()], SCHEMA).repartition(3)
    found, books = vector_codes.codes(frame, entries=entries, rounds=rounds)
    expected, sha = brute_force(vectors(), entries, rounds)
    assert by_text(found.collect()) == by_text(expected) and vector_codes.digest(books) == sha


def test_few_rows_empty_table_and_empty_vectors(spark):
    few = [(2, [1.0, 2.0, 3.0, 4.0], 1), (1, [0.0, 0.5, 0.0, 0.0], None)]
    frame = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in few], SCHEMA)
    found, books = vector_codes.codes(frame)
    assert books.shape == (4, 2, 1)
    assert by_text(found.collect()) == by_text([(2, 1, "01010101", 0, 0), (1, None, "00000000", 0, 0)])
    assert vector_codes.codes(frame.limit(0))[0].count() == 0
    empty = spark.createDataFrame([(1, [], 1, "x", 1, "y", "z")], SCHEMA)
    assert [tuple(r) for r in vector_codes.codes(empty)[0].collect()] == [(1, 1, "00000000", 0, 0)]


def test_values_too_large_fail_with_a_message(spark):
    frame = spark.createDataFrame([(1, [3e38] * 4, 1, "x", 1, "y", "z")], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        vector_codes.codes(frame)


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dimensions, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
    keys = [bytes(k) for k in vector_codes.hilbert_keys(points, bits)]
    assert len(set(keys)) == len(points)
    along = points[sorted(range(len(points)), key=keys.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("seed", range(6))
def test_shortlists_keep_every_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    points, book = rng.integers(-20, 20, (60, 3)), rng.integers(-20, 20, (40, 3))
    points = points[np.abs(points - points[0]).max(axis=1) < 6]
    book[7] = book[3]
    listed = vector_codes.shortlist(points.min(axis=0), points.max(axis=0), book)
    entry, distance = vector_codes.nearest(points, book, listed)
    every = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert len(listed) < len(book)


def test_products_beyond_doubles_are_exact():
    big = np.array([[(1 << 28) + 1, 3]])
    assert vector_codes._products(big, big.T)[0, 0] == ((1 << 28) + 1) ** 2 + 9


def test_codes_decode(spark):
    frame = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in vectors()[:50]], SCHEMA)
    found, books = vector_codes.codes(frame, entries=8)
    ints = {i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(int) for i, v, _ in vectors()[:50]}
    for r in found.collect():
        assert ((vector_codes.decoded(r["code"], books) - ints[r["vec_id"]]) ** 2).sum() == r["error"]

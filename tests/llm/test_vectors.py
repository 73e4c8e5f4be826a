import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from articlelake.llm import neighbours, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, row string"


def vectors():
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    hot = data[3][1]
    data += [(200 + i, hot) for i in range(80)]  # copies: ties beyond k
    data += [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [math.inf] * 8), (304, [None] + [1.0] * 7)]
    data += [(305, [1.0, 2.0]), (None, hot), (10, data[10][1]), (20, [1e-30] * 8), (40, [3e38] * 8), (306, [])]
    return data


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in vectors()], SCHEMA).repartition(3)


def usable(zero):
    seen = []
    for i, v in vectors():
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        if (zero or any(v)) and (i, v) not in seen:
            seen.append((i, v))
    return seen


def brute_force(rows, every, k, score):
    out = []
    for i, v in rows:
        if i % every == 0:
            found = sorted((-score(v, w), j) for j, w in rows if j != i)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def inner(v, w):
    total = 0.0
    for a, b in zip(v, w):
        total += a * b
    return total


@pytest.mark.parametrize("blocks", [(4096, 8192), (3, 16)])
def test_nearest_is_exact(frame, blocks):
    found = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, 7, query_block=blocks[0], candidate_block=blocks[1])
    assert sorted(map(tuple, found.collect())) == brute_force(usable(False), 5, 7, inner)


@pytest.mark.parametrize("blocks", [(4096, 8192), (3, 16)])
def test_top_k_is_exact(frame, blocks):
    small = frame.where("vec_id IS NULL OR vec_id <> 40")  # its scores go beyond 64 bits
    found = topk.top_k(small, topk.scaled(F.col("embedding"), 1024), F.col("vec_id") % 10 == 0, 5, query_block=blocks[0], candidate_block=blocks[1])
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in usable(True) if i != 40]
    assert sorted(map(tuple, found.collect())) == brute_force(whole, 10, 5, lambda v, w: sum(a * b for a, b in zip(v, w)))


def test_weights_out_of_range_do_not_fail(frame):
    assert topk.top_k(frame, topk.scaled(F.col("embedding"), 1024), F.col("vec_id") == 40, 5).count() == 2 * 5  # two rows have this id


def test_fewer_candidates_than_k_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0], 1, "", ""), (1, [2.0], 1, "", "")], SCHEMA)
    none = few.limit(0)
    weights = topk.scaled(F.col("embedding"), 1024)
    every = F.col("vec_id") % 1 == 0
    assert sorted(map(tuple, neighbours.nearest(few, every, 20).collect())) == [(0, 1, 1, 2.0), (1, 1, 0, 2.0)]
    assert topk.top_k(few, weights, every, 10).count() == 2
    assert neighbours.nearest(none, every, 20).count() == 0 and topk.top_k(none, weights, every, 10).count() == 0

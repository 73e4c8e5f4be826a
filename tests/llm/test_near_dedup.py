import re
from collections import defaultdict

import numpy as np
import pytest

from articlelake.llm import near_dedup
from tests.llm.conftest import edited, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(folded)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows, percent):
    """Per row (doc_id, set size, component, kept), by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    takes = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    for i in takes:
        for j in takes:
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                top[root(j)] = root(i)
    least = defaultdict(list)
    for i in takes:
        least[root(i)].append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        component = min(least[root(i)]) if i in set(takes) else d
        out.append((d, len(sets[i]), component, d is None or d == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(docs, planted_rows, percent):
    found = near_dedup.near_duplicates(docs, percent=percent).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(planted_rows, percent)


def test_a_group_of_near_copies_in_blocks_and_deepened(spark, monkeypatch):
    """Small limits: several blocks a cluster, and clusters that are crowded."""
    base = prose(1, 120)
    rows = [(i, edited(base, i, 0.03)) for i in range(60)] + [(1000 + i, prose(50 + i, 80)) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    found = near_dedup.near_duplicates(frame, percent=85).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(rows, 85)
    monkeypatch.setattr(near_dedup, "CROWDED", 5)
    deep = near_dedup.near_duplicates(frame, percent=85).collect()
    assert {r["doc_id"] for r in deep} == {i for i, _ in rows}


def test_a_crowded_cluster_loses_no_link(spark, monkeypatch):
    """200 pairs of similarity 0.8 or so, all of which share a passage that makes them one cluster."""
    rows = []
    for i in range(200):
        pair = prose(1, 100) + " " + prose(1000 + i, 12)
        rows += [(2 * i + j, f"{pair} {prose(5000 + 2 * i + j, 12)}") for j in (0, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows, 80)
    assert sum(not kept for *_, kept in expected) > 150
    monkeypatch.setattr(near_dedup, "CROWDED", 5)
    found = near_dedup.near_duplicates(frame, percent=80).collect()
    assert sorted(map(tuple, found), key=str) == expected


def test_similar_sets_share_a_rare_shingle(spark):
    """Of all pairs, in one cluster; an uneven set of frequencies and sets of every small size."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, int(rng.integers(1, 40)), p=np.arange(1, 61) / 1830)) for _ in range(120)]
    sets += [np.setdiff1d(s, rng.choice(s, 2)) for s in sets if len(s) > 3]
    data = [(i, 0, (i, 0), (0, 0), s.tobytes()) for i, s in enumerate(sets)]
    node = "struct<fp1: long, fp2: long>"
    frame = spark.createDataFrame(data, f"fp1 long, fp2 long, component {node}, cluster {node}, shingles binary")
    regions = defaultdict(set)
    for r in near_dedup._by_rare_shingles(frame, 80).collect():
        regions[r["fp1"]].add(r["region"])
    alike = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                alike += 1
                assert regions[i] & regions[j]
    assert alike > 50


def test_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).collect() == []


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, 0, i + 1, 0) for i in range(40)], "a1 long, a2 long, b1 long, b2 long")
    found = near_dedup.components(links).collect()
    assert len(found) == 41 and len({r["component"] for r in found}) == 1

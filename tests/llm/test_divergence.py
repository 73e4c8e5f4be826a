import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from articlelake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, term string, block int, prefix string, n int, state int"


def corpus():
    from tests.llm.conftest import WORDS, prose

    rows = []
    for i in range(90):
        lang = ["en", "de", None, ""][i % 4]
        rows.append((i, prose(i, 60) + " ÉTÉ été Straße x" * (i % 3), lang, f"s{i % 7}" if i % 9 else None))
    rows += [(500, None, "en", "s0"), (501, "", "de", "lonely"), (502, "12 _ []", "xx", "s0"), (502, "12 _ []", "xx", "s1")]
    rows += [(600 + i, "a" * 5000 + " " + "A" * 4999 + "b", "long", f"s{i % 2}") for i in range(4)]
    rows += [(700 + i, " ".join(WORDS[:40]), "hot", "hot") for i in range(30)]
    rows += [(7, "repeated row", "en", "s1")] * 6
    rows.append((800, "\x80\x7f日本 " * 400_000, "en", "s2"))  # beyond one stretch
    return rows


def brute_force(rows, least, top):
    plain = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    in_docs, counts, of_lang = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, _, words in plain:
        in_docs.update((lang, w) for w in set(words))
    kept = defaultdict(set)
    for (lang, w), n in in_docs.items():
        if n >= least:
            kept[lang].add(w)
    for lang, source, words in plain:
        own = [w for w in words if w in kept[lang]]
        counts[lang, source].update(own)
        of_lang[lang].update(own)
    out = []

    def share(found, w, v):
        return 1 + 10**9 * (found[w] + 5) // (sum(found.values()) + 5 * v)

    for (lang, source), found in counts.items():
        v = len(kept[lang])
        pairs = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                far = counts[lang, other]
                pairs.append((-sum(abs(share(found, w, v) - share(far, w, v)) for w in kept[lang]), other))
        own = [(share(of_lang[lang], w, v) - share(found, w, v), w) for w in kept[lang] if found[w]]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted((d, w) for d, w in own if d < 0)[:top])):
            out += [(lang, source, part, item, -d, n + 1) for n, (d, item) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("least, top, block", [(4, 50, 1 << 23), (4, 3, 2000), (30, 50, 1), (1, 10, 5000)])
def test_equals_brute_force(spark, monkeypatch, least, top, block):
    monkeypatch.setattr(divergence, "BLOCK_BYTES", block)
    rows = corpus() if least > 1 else corpus()[:40]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA).repartition(3)
    found = divergence.divergence(docs, least, top)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute_force(rows, least, top)


def test_tiles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_TILE", 2)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 3000)  # and so many buckets
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in corpus()], SCHEMA)
    assert sorted(map(tuple, divergence.divergence(docs, 4).collect())) == brute_force(corpus(), 4, 50)


def test_empty_table_and_no_kept_terms(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert divergence.divergence(none).count() == 0
    rows = [(1, "a b", "en", "s"), (2, None, "en", "t"), (3, "a", "de", None)]
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA)
    found = sorted(map(tuple, divergence.divergence(docs).collect()))
    assert found == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_rare_terms_are_never_sent_whole(spark):
    rows = [(i, f"common zebra{'x' * i}{i}", "en", "s") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(2)
    blocks, name = divergence._blocks(docs.select("lang", "source", "text"))
    level = divergence._first_level(blocks, 1)
    assert {(bytes(r["names"]), r["complete"]) for r in level.collect()} == {(b"comm zebr", False)}
    level = divergence._next_level(blocks, level, 4, 50, 1)
    assert level.count() == 0  # both are in 40 documents
    spark.sql(f"DROP TABLE {name}")
    kept = divergence.kept_counts(docs, 30)
    assert [tuple(r) for r in divergence.counts(kept).collect()] == [("en", "s", "common", 40)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("term_blocks")]


def test_blocks_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, "common", "en", "s") for i in range(40)], "doc_id long, text string, lang string, source string")
    blocks, name = divergence._blocks(docs.select("lang", "source", "text"))
    level = divergence._next_level(blocks, divergence._first_level(blocks, 1), 4, 3, 1)
    plan = level._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(block#" not in plan and "Exchange hashpartitioning(own#" in plan
    spark.sql(f"DROP TABLE {name}")


def test_shares_are_exact():
    rng = np.random.default_rng(3)
    total = rng.integers(0, 1 << 50, 200)
    count = (total * rng.random(200)).astype(np.int64)
    assert divergence.share(count, total, 10**6).tolist() == [1 + 10**9 * (c + 5) // (t + 5 * 10**6) for c, t in zip(count.tolist(), total.tolist())]


def test_long_texts_are_taken_in_stretches(monkeypatch):
    monkeypatch.setattr(divergence, "_STRETCH", 7)
    text = "One twoTHREE-four  fünf " * 20 + "x" * 50
    assert [w.decode() for part in divergence.terms_of(text) for w in part] == TERM.findall(text.translate(LOWER))

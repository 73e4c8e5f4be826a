import random

import pytest
from pyspark.sql import functions as F

from articlelake.functions import packing, text
from articlelake.functions.packing import Sizes
from articlelake.functions.tokens import WORDS
from articlelake.operators import chunk
from articlelake.runtime import stored
from tests.plans import carried

SIZES = Sizes(target=35, maximum=50, overlap=8)


def spec_windows(sizes, target, maximum, overlap):
    """Windows by their definition, every total summed from scratch."""
    out, first, end, n = [], 0, 0, len(sizes)
    while end < n:
        end += 1  # one more unit always joins what was carried over
        while end < n and sum(sizes[first:end]) < target and sum(sizes[first : end + 1]) <= maximum:
            end += 1
        out.append((first + 1, end, sum(sizes[first:end])))
        first = min(q for q in range(first, end + 1) if sum(sizes[q:end]) <= overlap)
    return out


def got_windows(spark, rows, target, maximum, overlap):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s array<int>")
    out = df.select("i", packing.windows("s", Sizes(target, maximum, overlap)).alias("w")).collect()
    return {r.i: [tuple(w) for w in r.w] for r in out}


@pytest.mark.parametrize("sizes", [(35, 50, 8), (10, 10, 3), (5, 20, 0), (1, 2, 1), (20, 30, 29)])
def test_windows_agree_with_their_definition(spark, sizes):
    rng = random.Random(str(sizes))
    top = rng.choice([sizes[1], sizes[1] + 3])
    rows = [[rng.randint(1, top) for _ in range(rng.randint(0, 40))] for _ in range(300)]
    rows += [[1] * 60, [], [sizes[1]] * 5, [3, 9] * 1000]
    got = got_windows(spark, rows, *sizes)
    for i, row in enumerate(rows):
        assert got[i] == spec_windows(row, *sizes), row


@pytest.mark.parametrize("target", range(-1, 5))
@pytest.mark.parametrize("maximum", range(-1, 4))
def test_sizes_are_checked_as_they_are_made(target, maximum):
    for overlap in range(-2, 5):
        if 0 < target <= maximum and 0 <= overlap < maximum:
            assert Sizes(target, maximum, overlap).overlap == overlap
        else:
            with pytest.raises(ValueError, match="not "):
                Sizes(target, maximum, overlap)


def test_every_broken_rule_is_named():
    with pytest.raises(ValueError, match="0 < target.*overlap < maximum"):
        Sizes(0, 3, 3)


def test_overlap_is_the_tail_that_fits(spark):
    assert got_windows(spark, [[20, 4, 3, 30]], 25, 50, 8)[0] == [(1, 3, 27), (2, 4, 37)]
    assert got_windows(spark, [[10, 20, 30]], 25, 50, 8)[0] == [(1, 2, 30), (3, 3, 30)]
    assert got_windows(spark, [[20, 4, 3, 30]], 25, 50, 0)[0] == [(1, 3, 27), (4, 4, 30)]


def test_long_sentence_is_cut_into_capped_parts(spark):
    df = spark.createDataFrame([(" ".join(["word"] * 500),)], "c string")
    units = df.select(WORDS.units(text.sentences(F.col("c")), 70).alias("u")).first().u
    assert [u.tokens for u in units] == [70] * 7 + [10]
    assert " ".join(u.text for u in units) == " ".join(["word"] * 500)


def base_frame(spark, rows):
    schema = (
        "article_id string, title string, url string, published_date date, year int, "
        "quarter_year string, content string, news_site string, "
        "topics array<struct<topic:string,sentiment_score:double,explanation:string>>"
    )
    import datetime

    full = [
        (i, "T", "u", datetime.date(2022, 8, 1), 2022, "2022Q3", c, "s", [("BTO", 0.5, "w")])
        for i, c in rows
    ]
    return spark.createDataFrame(full, schema)


def test_chunk_table(spark):
    sentence = "This sentence has exactly seven small words."
    base = base_frame(spark, [("a", " ".join([sentence] * 40)), ("b", "Short."), ("c", " \t")])
    rows = chunk.chunk_articles(base, WORDS, SIZES).orderBy("article_id", "chunk_index").collect()
    assert rows[0].asDict().keys() == set(chunk.CHUNK_COLUMNS)
    a = [r for r in rows if r.article_id == "a"]
    assert [r.chunk_index for r in a] == list(range(len(a))) and len(a) > 1
    assert [r.chunk_id for r in a] == [f"a:chunk_{i}" for i in range(len(a))]
    assert all(len(r.content_chunk.split()) <= 58 for r in a)
    # each passage opens with the last sentence of the one before it
    assert all(n.content_chunk.startswith(sentence) for n in a[1:])
    assert a[0].retrieval_text.startswith("Title: T\nTopics: BTO\n\nArticle excerpt:\nThis")
    assert [r.content_chunk for r in rows if r.article_id == "b"] == ["Short."]
    assert not [r for r in rows if r.article_id == "c"]
    assert a[0].topics == ["BTO"]


def test_passages_cap_at_maximum_plus_overlap(spark):
    rng = random.Random(3)
    words = lambda n: "W" + "x " * (n - 1) + "e."
    content = " ".join(words(rng.randint(2, 130)) for _ in range(200))
    df = base_frame(spark, [("a", content)])
    chunks = [r.content_chunk for r in chunk.chunk_articles(df, WORDS, SIZES).collect()]
    assert max(len(c.split()) for c in chunks) <= 58
    assert set(content.split()) == {w for c in chunks for w in c.split()}


def test_lineage_is_carried_where_present(spark):
    base = base_frame(spark, [("a", "Text.")])
    assert "batch_id" not in chunk.chunk_articles(base, WORDS).columns
    assert chunk.chunk_articles(base.withColumn("batch_id", F.lit("2022-08")), WORDS).columns[-1] == "batch_id"


def test_numbering_runs_on_across_rows_of_an_id(spark):
    rows = [(f"k{i % 2}", f"Sentence {i}. " * (i % 5 + 1), i) for i in range(60)]
    base = base_frame(spark, [(k, c) for k, c, _ in rows])
    order = F.regexp_extract("content", r"(\d+)", 1).cast("long")
    numbered = chunk.chunk_articles(
        base.withColumn("o", order).withColumn("batch_id", order.cast("string")),
        WORDS, Sizes(2, 4, 0), order_by="o", ranges=3,
    )
    got = {}
    for r in numbered.collect():
        got.setdefault(r.article_id, []).append((r.chunk_index, int(r.batch_id)))
    for pairs in got.values():
        pairs.sort()
        assert [i for i, _ in pairs] == list(range(len(pairs)))
        assert [o for _, o in pairs] == sorted(o for _, o in pairs)


def test_numbering_in_narrow_ranges_agrees_with_one_window(spark):
    rows = [("hot" if i % 3 else f"k{i}", i, p) for i in range(400) for p in range(i % 4)]
    rows += [(None, i, 0) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o long, p int")
    got = chunk.number_across_rows(df, "k", "o", "p", ranges=23).collect()
    expected, counts = {}, {}
    for k, o, p in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        expected[(k, o, p)] = counts.get(k, 0)
        counts[k] = counts.get(k, 0) + 1
    assert {(r.k, r.o, r.p): r.chunk_index for r in got} == expected


def test_numbering_by_sparse_orders_with_ties(spark):
    # every order value is a digest, some rows share one, and one key has most rows
    rows = [("hot" if i % 4 else f"k{i % 3}", f"{(i // 2 * 2 if i % 10 == 1 else i) * 7919 % 10007:08x}", p, f"text {i}") for i in range(300) for p in range(i % 3 + 1)]
    df = spark.createDataFrame(rows, "k string, o string, p int, body string").repartition(5)
    got = chunk.number_across_rows(df, "k", "o", "p", ranges=11)
    assert got.columns == [*df.columns, "chunk_index"]
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.k, []).append((r.chunk_index, r.o, r.p))
    assert sum(map(len, by_key.values())) == len(rows)
    for found in by_key.values():
        found.sort()
        assert [i for i, _, _ in found] == list(range(len(found)))
        assert [(o, p) for _, o, p in found] == sorted((o, p) for _, o, p in found)


def test_no_text_is_sorted(spark):
    df = stored(spark.createDataFrame([("a", 1, 0, "x")], "k string, o long, p int, body string"), "rows")
    numbered = chunk.number_across_rows(df, "k", "o", "p")
    sorts = [columns for columns in carried(numbered, "Sort") if "body" in columns]
    assert len(sorts) == 1  # of rows that share their place with others
    assert not any("body" in columns for columns in carried(numbered, "SortMergeJoin"))


@pytest.mark.parametrize("content, message", [(None, "null_content"), ("a\nb", "multiline_content")])
def test_enforced_content(spark, content, message):
    base = base_frame(spark, [("a", content)])
    with pytest.raises(Exception, match=message):
        chunk.chunk_articles(base, WORDS, enforce=True).collect()


def test_enforced_ids(spark):
    one, two = base_frame(spark, [(None, "A b.")]), base_frame(spark, [(None, "A b c. D e f.")])
    sizes = {"sizes": Sizes(3, 4, 0), "enforce": True}
    assert chunk.chunk_articles(one, WORDS, **sizes).count() == 1
    with pytest.raises(Exception, match="unique_chunk_id"):
        chunk.chunk_articles(two, WORDS, **sizes).collect()


class Letters:
    """A tokenizer of a caller's own: every character counts."""

    def units(self, sentences, max_tokens):
        unit = lambda t: F.struct(t.alias("text"), F.length(t).alias("tokens"))
        return F.transform(sentences, unit)


def test_a_tokenizer_of_ones_own_goes_through_the_same_fold(spark):
    base = base_frame(spark, [("a", "The weather in the north. " * 30)])
    rows = chunk.chunk_articles(base, Letters(), Sizes(60, 90, 30)).collect()
    unit = "The weather in the north."
    spans = spec_windows([len(unit)] * 30, 60, 90, 30)
    assert [r.content_chunk for r in rows] == [" ".join([unit] * (b - a + 1)) for a, b, _ in spans]


def test_statistics(spark):
    base = spark.createDataFrame(
        [("A b c. D e f. G h i.",), ("A b.",), ("  ",), (None,)], "content string"
    )
    s = chunk.chunk_statistics(
        chunk.with_windows(base, F.col("content"), WORDS, Sizes(target=3, maximum=6, overlap=3))
    ).first()
    # windows of the first article: [1], [1,2], [2,3]; of the second: [1]
    assert (s.articles, s.single_chunk_articles, s.median_tokens) == (2, 1, 5.5)
    assert s.boundaries == s.chunks - 2 and s.zero_overlap_boundaries == 0
    lengths = chunk.content_length_statistics(base).first()
    assert (lengths.min_article_len, lengths.max_article_len, lengths.median_article_len) == (2, 20, 4.0)

from datetime import date

import pytest
from pyspark.sql import functions as F

from articlelake.errors import IntegrityError
from articlelake.operators import quality
from articlelake.operators.clean import clean_articles
from articlelake.operators.flatten import flatten_articles
from articlelake.plans.jobs import audited_base, audited_flat

GOOD_PAIR = {
    "topics": "BTO|Rental",
    "sentiment_by_topic": '{"BTO": 1, "Rental": 2}',
    "sentiment_reason_by_topic": '{"BTO": "a", "Rental": "b"}',
}

# guard -> rows, one fault each, with the guards they trip
FAULTS = [
    ({"published_date": "2022-02-30 10:00:00"}, {"missing_published_date": 1}),
    ({"title": "  "}, {"missing_title": 1}),
    ({"title": None}, {"missing_title": 1}),
    ({"topics": None}, {"empty_topics": 1}),
    ({"topics": "  "}, {"empty_topics": 1, "topic_sentiment_mismatch": 1, "topic_reason_mismatch": 1}),
    ({"topics": "BTO| BTO"}, {"duplicate_topics": 1, "topic_sentiment_mismatch": 1, "topic_reason_mismatch": 1}),
    ({"topics": "BTO|"}, {"topic_sentiment_mismatch": 1, "topic_reason_mismatch": 1}),
    ({"sentiment_by_topic": "{bad"}, {"malformed_json": 1}),
    ({"sentiment_by_topic": "[1]"}, {"malformed_json": 1}),
    ({"sentiment_reason_by_topic": ""}, {"malformed_json": 1}),
    ({"sentiment_by_topic": None}, {"topic_sentiment_mismatch": 1}),
    ({"sentiment_by_topic": '{"BTO": null}'}, {"topic_sentiment_mismatch": 1}),
    ({"sentiment_by_topic": '{"BTO": 1, "Rental": 1}'}, {"topic_sentiment_mismatch": 1}),
    ({"sentiment_by_topic": '{"BTO": 1, "Rental": null}'}, {}),
    ({"sentiment_by_topic": '{"BTO": 1, "Unheard": 1}'}, {}),
    ({"sentiment_reason_by_topic": '{"BTO": "a", "Rental": "b"}'}, {"topic_reason_mismatch": 1}),
    ({"exclude_from_housing_analysis": None}, {"row_conservation": 1}),
    ({"published_date": "1/1/2023 9:00"}, {"out_of_batch_range": 1}),
]


@pytest.mark.parametrize("fault, expected", FAULTS)
def test_each_guard(raw_frame, fault, expected):
    raw = raw_frame({"title": "sound", **GOOD_PAIR}, {"title": "faulty", **fault})
    period = (date(2022, 1, 1), date(2022, 12, 31))
    report = {r.guard: r.violations for r in quality.guard_report(raw, period).collect()}
    assert {g: n for g, n in report.items() if n} == expected
    counts = quality.audit_raw(raw, period)
    assert {g: n for g, n in counts.items() if n and g != "base_rows"} == expected


def test_every_excluded_fault_is_ignored(raw_frame):
    rows = [{"title": "x", **f, "article_type": "irrelevant"} for f, _ in FAULTS]
    counts = quality.audit_raw(raw_frame({**GOOD_PAIR}, *rows))
    assert {g: n for g, n in counts.items() if n} == {"base_rows": 1}


def test_duplicate_ids_are_counted_per_id(raw_frame):
    raw = raw_frame({}, {}, {}, {"title": "b"}, {"title": "b"}, {"title": "c"})
    assert quality.audit_raw(raw)["duplicate_article_id"] == 2
    one_null, two_null = {"news_site": None}, [{"news_site": None}] * 2
    assert quality.audit_raw(raw_frame(one_null))["duplicate_article_id"] == 0
    assert quality.audit_raw(raw_frame(*two_null))["duplicate_article_id"] == 1


def test_untagged_values_count_rows_not_keys(raw_frame):
    over = {"sentiment_by_topic": '{"BTO": 1, "Rental": 1, "Resale": 1, "New": 2}'}
    vocabulary = {"title": "v", "topics": "Rental|Resale", "article_type": "irrelevant"}
    raw = raw_frame(vocabulary, *[{"title": str(i), **over} for i in range(5)])
    report = {r.guard: r.violations for r in quality.guard_report(raw).collect()}
    assert report["topic_sentiment_mismatch"] == 5 and report["topic_reason_mismatch"] == 0


def test_guards_fail_in_order_and_name_all(raw_frame):
    # the first two rows have no id, which makes NULL a repeated one
    raw = raw_frame({"title": None}, {"title": "t", "published_date": "?"}, {"title": "u", "topics": None})
    with pytest.raises(IntegrityError) as e:
        audited_base(raw)
    lines = str(e.value).splitlines()
    assert lines[0].startswith("missing_published_date: 1 ")
    assert [line.split(":")[0] for line in lines] == [
        "missing_published_date", "missing_title", "duplicate_article_id", "empty_topics"
    ]


def test_range_guard_shows_offenders(raw_frame, spark):
    base = clean_articles(raw_frame({"title": "in"}, {"title": "out", "published_date": "9/1/2022 8:00"}))
    rows = quality.out_of_range(base, date(2022, 8, 1), date(2022, 8, 31)).collect()
    assert [tuple(map(str, r)) for r in rows] == [("out", "2022-09-01", "example")]


def test_flatten_guard(raw_frame):
    good = clean_articles(raw_frame(GOOD_PAIR))
    assert tuple(quality.flatten_conservation(good, flatten_articles(good)).first()) == (2, 2, True)
    bad = clean_articles(raw_frame(GOOD_PAIR, {"title": "n", "sentiment_by_topic": None}))
    assert tuple(quality.flatten_conservation(bad, flatten_articles(bad)).first()) == (2, 3, False)
    with pytest.raises(IntegrityError, match="flatten_row_count"):
        audited_flat(bad)


def test_content_guards(raw_frame):
    base = clean_articles(raw_frame({}, {"title": "b", "content": None}, {"title": "c", "content": "a\nb"}))
    assert tuple(quality.content_guards(base).first()) == (1, 1)
    assert tuple(quality.content_verdict(base).first()) == (False, False)
    assert tuple(quality.content_verdict(base.limit(0)).first()) == (True, True)


def test_chunk_id_guards(spark):
    chunks = spark.createDataFrame([("a",), ("b",), (None,)], "chunk_id string")
    assert tuple(quality.duplicate_chunk_ids(chunks).first()) == (3, 3, True)
    assert tuple(quality.duplicate_chunk_ids(chunks.union(chunks)).first()) == (6, 3, False)
    base = spark.createDataFrame(
        [("a", "x"), ("a", " "), ("b", "x"), ("b", "y"), ("c", None), ("c", "z")],
        "article_id string, content string",
    )
    assert quality.duplicate_chunk_articles(base).first()[0] == 1


def test_embedding_guards(spark):
    rows = [("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)]
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<float>")
    assert tuple(quality.embedding_guards(df, 2).first()) == (3, 1, 1, 2, 1, False)
    uniform = df.where(F.col("chunk_id") == "a")
    assert tuple(quality.embedding_guards(uniform).first()) == (1, 0, 2, 2, 0, True)

from pyspark.sql import functions as F

from articlelake.operators.clean import clean_articles, discover_topics, sorted_topics
from articlelake.operators.flatten import flatten_articles, topic_quarter_rollup
from articlelake.operators.quality import exclusion_accounting
from articlelake.schemas import BASE_COLUMNS, FLAT_COLUMNS


def test_exclusion_has_three_values(raw_frame):
    raw = raw_frame(
        {"title": "kept"},
        {"title": "flag", "exclude_from_housing_analysis": True},
        {"title": "low", "housing_relevance": "low"},
        {"title": "none", "housing_relevance": "none", "article_type": None},
        {"title": "ad", "article_type": "advertisement_or_sponsored"},
        {"title": "irr", "article_type": "irrelevant", "exclude_from_housing_analysis": None},
        {"title": "unknown flag", "exclude_from_housing_analysis": None},
        {"title": "unknown relevance", "housing_relevance": None},
    )
    assert [r.title for r in clean_articles(raw).collect()] == ["kept"]
    counts = exclusion_accounting(raw).first()
    assert tuple(counts) == (8, 5, 1, 2)


def test_vocabulary_covers_excluded_rows(raw_frame):
    raw = raw_frame(
        {"topics": " Resale | BTO"},
        {"topics": "Rental|", "exclude_from_housing_analysis": True},
        {"topics": None},
        {"topics": "|  |BTO"},
    )
    assert [r.topic for r in sorted_topics(raw).collect()] == ["BTO", "Rental", "Resale"]
    assert discover_topics(raw).count() == 3


def test_base_row(raw_frame):
    raw = raw_frame(
        {
            "title": "  Prices rise ",
            "published_date": "8/5/2022 23:31",
            "topics": "Resale | Affordability",
            "sentiment_by_topic": '{"Resale": 1, "Affordability": -0.5, "Other": 9}',
            "sentiment_reason_by_topic": '{"Resale": "up", "Affordability": "a \\"b\\""}',
        }
    )
    base = clean_articles(raw)
    assert base.columns == BASE_COLUMNS
    row = base.first()
    assert row.title == "Prices rise"
    assert row.article_id == "Prices rise | 2022-08-05 | example"
    assert (row.year, row.quarter_year, str(row.published_date)) == (2022, "2022Q3", "2022-08-05")
    assert [tuple(t) for t in row.topics] == [("Affordability", -0.5, 'a "b"'), ("Resale", 1.0, "up")]
    assert clean_articles(raw, "2022-08").first().batch_id == "2022-08"


def test_both_date_styles_give_one_id(raw_frame):
    raw = raw_frame(
        {"published_date": "2022-08-08T23:31:00+08:00"}, {"published_date": "8/8/2022 23:31"}
    )
    assert clean_articles(raw).select("article_id").distinct().count() == 1


def test_missing_site_gives_no_id(raw_frame):
    assert clean_articles(raw_frame({"news_site": None})).first().article_id is None


def test_flat_table(raw_frame):
    raw = raw_frame(
        {
            "topics": "Resale|Affordability",
            "sentiment_by_topic": '{"Resale": 1, "Affordability": -1}',
            "sentiment_reason_by_topic": '{"Resale": "x", "Affordability": "y"}',
        },
        {"title": "Other"},
    )
    flat = flatten_articles(clean_articles(raw))
    assert flat.columns == FLAT_COLUMNS
    rows = {r.article_topic_key: (r.topic, r.sentiment_score, r.explanation) for r in flat.collect()}
    key = "Title | 2022-08-15 | example | "
    assert rows == {
        key + "Affordability": ("Affordability", -1.0, "y"),
        key + "Resale": ("Resale", 1.0, "x"),
        "Other | 2022-08-15 | example | BTO": ("BTO", 0.5, "why"),
    }
    with_batch = flatten_articles(clean_articles(raw, "2022-08"))
    assert with_batch.columns == FLAT_COLUMNS + ["batch_id"]
    rollup = topic_quarter_rollup(flat).orderBy("topic").collect()
    assert [(r.topic, r.articles, r.negative, r.positive) for r in rollup] == [
        ("Affordability", 1, 1, 0), ("BTO", 1, 0, 1), ("Resale", 1, 0, 1)
    ]


def test_article_without_topics_flattens_to_one_empty_row(raw_frame):
    base = clean_articles(raw_frame({"sentiment_by_topic": None}))
    assert base.first().topics == []
    row = flatten_articles(base).first()
    assert row.topic is None and row.article_topic_key is None
    assert flatten_articles(base.withColumn("topics", F.lit(None).cast(base.schema["topics"].dataType))).count() == 1

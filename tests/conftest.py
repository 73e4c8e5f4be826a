import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from articlelake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


RAW_SCHEMA = (
    "title string, url string, published_date string, content string, news_site string, "
    "housing_relevance string, exclude_from_housing_analysis boolean, article_type string, "
    "topics string, sentiment_by_topic string, sentiment_reason_by_topic string"
)


@pytest.fixture(scope="session")
def raw_frame(spark):
    """Raw articles from partial rows; the defaults are a sound one."""

    def build(*rows):
        default = {
            "title": "Title",
            "url": "https://example.test/1",
            "published_date": "2022-08-15T10:00:00+08:00",
            "content": "One sentence. Another one.",
            "news_site": "example",
            "housing_relevance": "high",
            "exclude_from_housing_analysis": False,
            "article_type": "news",
            "topics": "BTO",
            "sentiment_by_topic": '{"BTO": 0.5}',
            "sentiment_reason_by_topic": '{"BTO": "why"}',
        }
        data = [tuple({**default, **row}.values()) for row in rows]
        return spark.createDataFrame(data, RAW_SCHEMA)

    return build

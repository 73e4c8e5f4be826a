"""Raw export rows to one row per article."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.functions import text, topics
from articlelake.schemas import (
    BASE_COLUMNS,
    EXCLUDED_RELEVANCE,
    EXCLUDED_TYPES,
    KEY_SEPARATOR,
    LINEAGE_COLUMN,
)


def exclusion_mask() -> Column:
    """True where a row is out of scope; NULL where the flags do not tell."""
    return (
        F.col("exclude_from_housing_analysis")
        | F.col("housing_relevance").isin(EXCLUDED_RELEVANCE)
        | F.col("article_type").isin(EXCLUDED_TYPES)
    )


def discover_topics(raw: DataFrame) -> DataFrame:
    """Distinct topic names over all raw rows, excluded ones included, as `topic`.

    Each task reduces its rows to their distinct names before the exchange.
    """
    return (
        raw.select(F.explode(text.split_trimmed(F.col("topics"))).alias("topic"))
        .where(F.col("topic") != "")
        .distinct()
    )


def sorted_topics(raw: DataFrame) -> DataFrame:
    """The topic names in order."""
    return discover_topics(raw).orderBy("topic")


def shape(raw: DataFrame) -> DataFrame:
    """Parsed columns of every raw row, and `excluded`, its exclusion mask.

    Cleaning and auditing both start here and keep the columns they use.
    """
    parsed = raw.select(
        exclusion_mask().alias("excluded"),
        text.trim_unicode(F.col("title")).alias("title"),
        "url",
        text.parse_day(F.col("published_date")).alias("published_date"),
        "content",
        "news_site",
        F.col("topics").alias("topics_text"),
        "sentiment_by_topic",
        "sentiment_reason_by_topic",
        *[c for c in [LINEAGE_COLUMN] if c in raw.columns],
    )
    day = F.col("published_date")
    return parsed.withColumns(
        {
            "year": F.year(day),
            "quarter_year": text.quarter_label(day),
            "article_id": text.joined_key(
                KEY_SEPARATOR, F.col("title"), day.cast("string"), F.col("news_site")
            ),
            "own_topics": text.split_trimmed(F.col("topics_text")),
            "scores": topics.decode(F.col("sentiment_by_topic"), topics.SCORES),
            "reasons": topics.decode(F.col("sentiment_reason_by_topic"), topics.REASONS),
        }
    )


def clean_articles(raw: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Rows in scope, in the base article schema. Row-local: no shuffle."""
    base = (
        shape(raw)
        .where(~F.col("excluded"))
        .withColumn(
            "topics",
            topics.topic_structs(F.col("own_topics"), F.col("scores"), F.col("reasons")),
        )
        .select(BASE_COLUMNS)
    )
    return base if batch_id is None else base.withColumn(LINEAGE_COLUMN, F.lit(batch_id))

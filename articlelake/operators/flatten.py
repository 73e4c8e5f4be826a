"""Base articles to one row per article and topic."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.functions.text import joined_key
from articlelake.schemas import FLAT_COLUMNS, KEY_SEPARATOR, with_lineage


def flatten_articles(base: DataFrame) -> DataFrame:
    """One row per (article, topic), without the content column, which is never read.

    An article without topics gives one row of NULLs, which the flatten guard counts.
    """
    others = [c for c in base.columns if c not in ("topics", "content")]
    return (
        base.select(*others, F.inline_outer("topics"))
        .withColumn(
            "article_topic_key",
            joined_key(KEY_SEPARATOR, F.col("article_id"), F.col("topic")),
        )
        .select(with_lineage(FLAT_COLUMNS, base.columns))
    )


def topic_quarter_rollup(flat: DataFrame) -> DataFrame:
    """Articles and sentiment per quarter and topic: the analytics the flat table is for."""
    return flat.groupBy("quarter_year", "topic").agg(
        F.count("*").alias("articles"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.min("sentiment_score").alias("min_sentiment"),
        F.max("sentiment_score").alias("max_sentiment"),
        F.count_if(F.col("sentiment_score") < 0).alias("negative"),
        F.count_if(F.col("sentiment_score") > 0).alias("positive"),
    )

"""Column lists, value lists and defaults shared by every stage."""

from pyspark.sql import types as T

# --- fixed values (set by the data contract) ---------------------------------
RAW_COLUMNS = [
    "title",
    "url",
    "published_date",
    "content",
    "news_site",
    "housing_relevance",
    "exclude_from_housing_analysis",
    "article_type",
    "topics",
    "sentiment_by_topic",
    "sentiment_reason_by_topic",
]
BASE_COLUMNS = [
    "article_id",
    "title",
    "url",
    "published_date",
    "year",
    "quarter_year",
    "content",
    "news_site",
    "topics",
]
FLAT_COLUMNS = [
    "article_id",
    "article_topic_key",
    "title",
    "url",
    "published_date",
    "year",
    "quarter_year",
    "news_site",
    "topic",
    "sentiment_score",
    "explanation",
]
CHUNK_COLUMNS = [
    "chunk_id",
    "article_id",
    "chunk_index",
    "content_chunk",
    "retrieval_text",
    "title",
    "published_date",
    "news_site",
    "url",
    "topics",
    "year",
]
LINEAGE_COLUMN = "batch_id"

EXCLUDED_RELEVANCE = ["low", "none"]
EXCLUDED_TYPES = ["irrelevant", "advertisement_or_sponsored"]

KEY_SEPARATOR = " | "
TOPIC_SEPARATOR = "|"

STAGES = ["base", "flattened", "chunks", "embeddings"]

TARGET_CHUNK_TOKENS = 350
MAX_CHUNK_TOKENS = 500
OVERLAP_TOKENS = 75

EMBED_BATCH_SIZE = 20
EMBED_REQUESTS_PER_MINUTE = 20
EMBED_TOKENS_PER_MINUTE = 200_000
EMBED_WAITS_SECONDS = (5.0, 10.0, 20.0, 40.0)
EMBED_CHECKPOINT_EVERY = 25
# -----------------------------------------------------------------------------

TOPIC_STRUCT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("explanation", T.StringType()),
    ]
)


def with_lineage(columns: list[str], present: list[str]) -> list[str]:
    """The columns, plus the lineage column where the input carries one."""
    return columns + [c for c in [LINEAGE_COLUMN] if c in present]

"""Raw articles derived from the provided document and label tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.functions.text import collapse_space
from articlelake.runtime import spread
from articlelake.schemas import RAW_COLUMNS

# --- fixed values (the adapter's definition) ---------------------------------
VOCABULARY = ["Affordability", "BTO", "Rental", "Resale"]
ADVERTISING_SOURCE = "src3"
FIRST_DAY = "2022-01-01"
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_articles(
    spark: SparkSession, sf_dir: str, keep_unknown: bool = False, spread_text: bool = False
) -> DataFrame:
    """One raw article per document; unlabelled documents have unknown flags.

    `keep_unknown` sets those flags to keep the row. The `doc_id` stays for reference.
    The label table is joined by the size Spark finds for it, with no hint. Columns a
    query leaves out, the text above all, are pruned from the scan; `spread_text` is for
    queries that work on it.
    """
    documents = table(spark, sf_dir, "documents")
    if spread_text:
        documents = spread(documents, "doc_id")
    labels = table(spark, sf_dir, "labels")
    toxic = "toxic = 1"
    relevance = "CASE quality WHEN 0 THEN 'low' WHEN 1 THEN 'high' END"
    if keep_unknown:
        toxic, relevance = f"coalesce({toxic}, false)", f"coalesce({relevance}, 'high')"
    day = f"date_add(DATE'{FIRST_DAY}', cast(doc_id % 365 AS int))"
    tagged = {
        name: f"(doc_id % 15 + 1) & {1 << i} != 0" for i, name in enumerate(VOCABULARY)
    }

    def listed(values: dict[str, str], separator: str) -> str:
        members = ", ".join(f"CASE WHEN {tagged[t]} THEN {v} END" for t, v in values.items())
        return f"array_join(array({members}), '{separator}')"

    scores = {
        t: f"""concat('"{t}": ', cast((doc_id * 7 + {i * 13}) % 5 - 2 AS string))"""
        for i, t in enumerate(VOCABULARY)
    }
    reasons = {t: f"""'"{t}": "why {t}"'""" for t in VOCABULARY}
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        F.expr("concat('  Doc ', doc_id, ' ')").alias("title"),
        F.expr("concat('https://example.test/', doc_id)").alias("url"),
        F.expr(
            f"""if(doc_id % 2 = 0, concat(cast({day} AS string), 'T23:31:00+08:00'),
                   date_format({day}, 'M/d/yyyy 23:31'))"""
        ).alias("published_date"),
        collapse_space(F.col("text")).alias("content"),
        F.col("source").alias("news_site"),
        F.expr(relevance).alias("housing_relevance"),
        F.expr(toxic).alias("exclude_from_housing_analysis"),
        F.expr(
            f"if(source = '{ADVERTISING_SOURCE}', 'advertisement_or_sponsored', 'news')"
        ).alias("article_type"),
        F.expr(listed({t: f"'{t}'" for t in reversed(VOCABULARY)}, " | ")).alias("topics"),
        F.expr(f"concat('{{', {listed(scores, ', ')}, '}}')").alias("sentiment_by_topic"),
        F.expr(f"concat('{{', {listed(reasons, ', ')}, '}}')").alias(
            "sentiment_reason_by_topic"
        ),
    )


def faulty_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw articles with every kind of fault written into some of them."""
    kind = F.col("doc_id") % 50

    def faults(column: str, values: dict[int, Column | str | None]) -> Column:
        c = F.col(column)
        for k, value in values.items():
            fault = value if isinstance(value, Column) else F.lit(value)
            c = F.when(kind == k, fault).otherwise(c)
        return c

    extra = F.concat(
        F.rtrim(F.col("sentiment_reason_by_topic"), F.lit("}")), F.lit(', "Other": "x"}')
    )
    return raw_articles(spark, sf_dir, keep_unknown=True).withColumns(
        {
            "title": faults("title", {1: "   ", 2: None, 14: "Same story"}),
            "published_date": faults(
                "published_date", {3: "2022-02-30 10:00:00", 14: "8/8/2022 3:05"}
            ),
            "topics": faults(
                "topics", {4: "  ", 5: None, 6: "BTO|BTO", 7: "BTO|", 12: "BTO"}
            ),
            "sentiment_by_topic": faults(
                "sentiment_by_topic",
                {
                    8: "{bad",
                    9: None,
                    10: '{"BTO": null}',
                    12: '{"BTO": 1, "Rental": 2}',
                    17: '{"BTO": 0.5} trailing',
                    18: '{"BTO": 1}{"Rental": 2}',
                },
            ),
            "sentiment_reason_by_topic": faults(
                "sentiment_reason_by_topic", {11: extra, 12: '{"BTO": "a"}'}
            ),
            "exclude_from_housing_analysis": faults(
                "exclude_from_housing_analysis", {13: F.lit(None).cast("boolean")}
            ),
            "content": faults("content", {15: None, 16: F.concat("content", F.lit("\nnext"))}),
        }
    )


def as_raw(df: DataFrame) -> DataFrame:
    return df.select(RAW_COLUMNS)

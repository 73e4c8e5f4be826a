"""Base articles to sentence-aware, token-bounded, overlapping passages."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articlelake.functions import packing, text
from articlelake.functions.packing import Sizes
from articlelake.functions.tokens import Tokenizer
from articlelake.runtime import stored
from articlelake.schemas import (
    CHUNK_COLUMNS,
    MAX_CHUNK_TOKENS,
    OVERLAP_TOKENS,
    TARGET_CHUNK_TOKENS,
    with_lineage,
)

DEFAULT_SIZES = Sizes(TARGET_CHUNK_TOKENS, MAX_CHUNK_TOKENS, OVERLAP_TOKENS)


def checked_content(content: Column) -> Column:
    """The content itself, failing the task on NULL or on a line feed.

    The check rides along with the write: a failed task aborts the job and nothing is
    published, so the corpus is read once.
    """
    return (
        F.when(content.isNull(), F.raise_error(F.lit("null_content: an article has no content")))
        .when(
            content.contains("\n"),
            F.raise_error(F.lit("multiline_content: an article has more than one line")),
        )
        .otherwise(content)
    )


def with_windows(
    df: DataFrame,
    content: Column,
    tokenizer: Tokenizer,
    sizes: Sizes = DEFAULT_SIZES,
) -> DataFrame:
    """Adds `units` and the `windows` packed from them. Row-local: no shuffle."""
    return df.withColumn(
        "units", tokenizer.units(text.sentences(content), sizes.maximum)
    ).withColumn("windows", packing.windows("units.tokens", sizes))


def chunk_articles(
    base: DataFrame,
    tokenizer: Tokenizer,
    sizes: Sizes = DEFAULT_SIZES,
    enforce: bool = False,
    order_by: str | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per passage. The sizes count what the tokenizer counts, so it has no default.

    Passages are numbered by position within their row, which needs no shuffle and is
    the numbering per article as long as article ids are unique. `order_by` names an
    column giving the row order where they are not: numbering then runs on across the
    rows of an id. The passages are read several times for that, so they are written to a
    table first, in the shared folder or wherever `stage` puts it.

    `enforce` fails the job on content the chunker does not take, and on passages that
    would share the NULL id of an article without one.

    The passage texts are built before the explode, so a row carries one passage and
    never the whole article. Blank articles have no passages and drop out.
    """
    content = F.col("content")
    keep = [c for c in base.columns if c not in ("content", "topics", "quarter_year")]
    rows = with_windows(
        base.withColumn("topics", F.col("topics.topic")),
        checked_content(content) if enforce else content,
        tokenizer,
        sizes,
    )
    spans = F.col("windows")
    if enforce:
        spans = F.when(
            F.col("article_id").isNull() & (F.array_size(spans) > 1),
            F.raise_error(F.lit("unique_chunk_id: an article without id has several passages")),
        ).otherwise(spans)
    # exploding the expression and not a column of it: for a plain column the optimizer
    # adds a `size(..) > 0` filter below, which would chunk every article a second time
    rows = rows.select(
        *keep,
        "topics",
        F.posexplode(packing.passages(F.col("units.text"), spans)).alias(
            "position", "content_chunk"
        ),
    )
    if order_by is None:
        rows = rows.withColumn("chunk_index", F.col("position").cast("bigint"))
    else:
        stage = stage or (lambda passages: stored(passages, "passages"))
        rows = number_across_rows(stage(rows), "article_id", order_by, "position", stage, ranges)
    return (
        rows.withColumn("chunk_id", text.chunk_key(F.col("article_id"), F.col("chunk_index")))
        .withColumn(
            "retrieval_text",
            text.retrieval_text(F.col("title"), F.col("topics"), F.col("content_chunk")),
        )
        .select(with_lineage(CHUNK_COLUMNS, base.columns))
    )


def number_across_rows(
    rows: DataFrame,
    key: str,
    order_by: str,
    position: str,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Adds `chunk_index`: a row number from 0 per key, in (order_by, position) order.

    Only (key, order, count) rows are sorted, so no text is. One key may hold a large part
    of the table, and order values may be as sparse as hashes or times, so those rows are
    cut into ranges of about equal numbers of them, whatever their values: running sums
    within a range, plus the sums of the ranges before. Rows then find the number that
    their group starts with by a hash join, and add their position. Where several rows have
    the same order, their passages are numbered by position, in any order at the same one.
    """
    stage = stage or (lambda slim: stored(slim, "numbering"))
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(F.col(key).alias("_key"), F.col(order_by).alias("_order")).agg(
        F.count("*").alias("_rows"), (F.count_distinct(position) < F.count("*")).alias("_tied")
    )
    ranged = counts.repartitionByRange(ranges, "_key", "_order").withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged)  # ranges are chosen from samples: they must not be chosen twice
    running = Window.partitionBy("_key", "_range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(F.col("_key").alias("_of"), F.col("_range").alias("_in"))
        .agg(F.sum("_rows").alias("_held"))
        .withColumn("_offset", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))
    )
    within = ranged.withColumn("_start", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
    starts = within.join(before, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_in")))
    starts = starts.select("_key", "_order", "_tied", (F.col("_offset") + F.col("_start")).alias("_first"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(order_by).eqNullSafe(F.col("_order"))
    placed = rows.join(starts.hint("shuffle_hash"), same)
    alone = placed.where(~F.col("_tied")).withColumn("_row", F.col(position))
    among = Window.partitionBy("_key", "_order").orderBy(position)
    tied = placed.where("_tied").withColumn("_row", F.row_number().over(among) - 1)
    return alone.unionByName(tied).select(
        *rows.columns, (F.col("_first") + F.col("_row")).cast("bigint").alias("chunk_index")
    )


def chunk_statistics(windowed: DataFrame) -> DataFrame:
    """Sizes and overlap of a corpus chunked by `with_windows`, as one row.

    Each article is reduced to a few numbers in place, and medians come from counts per
    size, so only those counts are shuffled.
    """
    w = F.col("windows")
    gaps = F.aggregate(
        w,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("joins")),
        lambda s, x: F.struct(
            x.last.alias("end"),
            (s.joins + F.when((s.end > 0) & (x.first > s.end), 1).otherwise(0)).alias("joins"),
        ),
        lambda s: s.joins,
    )
    total = F.aggregate(
        F.col("units.tokens"), F.lit(0).cast("bigint"), lambda s, n: s + n
    )
    chunked = F.aggregate(
        F.transform(w, lambda x: x.tokens), F.lit(0).cast("bigint"), lambda s, n: s + n
    )
    per_article = windowed.select(
        F.array_size(w).cast("bigint").alias("chunks"),
        total.alias("tokens"),
        chunked.alias("chunk_tokens"),
        gaps.cast("bigint").alias("bare_joins"),
    )
    by_size = per_article.groupBy("tokens").agg(
        F.count("*").alias("articles"),
        F.sum("chunks").alias("chunks"),
        F.sum("chunk_tokens").alias("chunk_tokens"),
        F.sum("bare_joins").alias("bare_joins"),
        F.count_if(F.col("chunks") == 1).alias("single"),
    )
    # blank articles go here: a filter on the windows would be pushed below them and
    # compute them twice
    by_size = by_size.where(F.col("chunks") > 0)
    articles, chunks = F.sum("articles"), F.sum("chunks")
    tokens = F.sum(F.col("tokens") * F.col("articles"))
    return by_size.agg(
        articles.alias("articles"),
        chunks.alias("chunks"),
        F.percentile("tokens", F.lit(0.5), F.col("articles")).alias("median_tokens"),
        F.sum("single").alias("single_chunk_articles"),
        (F.sum("single") / articles).alias("single_chunk_share"),
        (chunks - articles).alias("boundaries"),
        F.sum("bare_joins").alias("zero_overlap_boundaries"),
        F.try_divide(F.sum("bare_joins"), chunks - articles).alias("zero_overlap_share"),
        ((F.sum("chunk_tokens") - tokens) / tokens).alias("duplication_share"),
    )


def content_length_statistics(base: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and median characters of the content, as one row.

    Lengths repeat, so they are counted first: the final step sees distinct lengths.
    """
    n = F.col("n")
    counted = (
        base.select(F.char_length("content").cast("bigint").alias("length"))
        .where(F.col("length").isNotNull())
        .groupBy("length")
        .agg(F.count("*").alias("n"))
    )
    return counted.agg(
        F.min("length").alias("min_article_len"),
        F.max("length").alias("max_article_len"),
        (F.sum(F.col("length") * n) / F.sum(n)).alias("avg_article_len"),
        F.percentile("length", F.lit(0.5), n).alias("median_article_len"),
    )

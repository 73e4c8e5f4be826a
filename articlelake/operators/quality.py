"""Integrity guards: each counts violations, and a job refuses to publish on any.

Row-level guards share one pass over the slim columns they read. Key guards group by the
key alone, with counts combined before the exchange. The article text is in no shuffle.
"""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.errors import IntegrityError
from articlelake.functions import text, topics
from articlelake.operators.clean import discover_topics, exclusion_mask, shape

# --- fixed values: guards in the order in which they are reported ------------
GUARDS = {
    "missing_published_date": "kept rows whose publication date could not be read",
    "missing_title": "kept rows without a title",
    "duplicate_article_id": "article ids shared by several kept rows",
    "empty_topics": "kept rows without any topic",
    "duplicate_topics": "kept rows naming a topic twice",
    "malformed_json": "kept rows with undecodable score or reason JSON",
    "topic_sentiment_mismatch": "kept rows whose scores do not match their topics",
    "topic_reason_mismatch": "kept rows whose reasons do not match their topics",
    "out_of_batch_range": "kept rows dated outside the months of the batch",
    "row_conservation": "raw rows with undecidable exclusion flags",
    "null_content": "articles without content",
    "multiline_content": "articles of more than one line",
    "flatten_row_count": "articles that do not flatten to one row per topic",
    "unique_chunk_id": "article ids that would repeat chunk ids",
    "missing_embedding": "chunks without an embedding",
    "embedding_dimension": "embeddings of an unexpected dimension",
}
# -----------------------------------------------------------------------------


def as_rows(counts: DataFrame) -> DataFrame:
    """A one-row table of counts as (guard, violations) rows."""
    entries = [
        F.struct(F.lit(c).alias("guard"), F.col(c).cast("bigint").alias("violations"))
        for c in counts.columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def _kept() -> Column:
    return ~F.coalesce(F.col("excluded"), F.lit(True))


def exclusion_accounting(raw: DataFrame) -> DataFrame:
    """Raw, excluded, kept and unaccounted rows, as one row."""
    mask = exclusion_mask()
    return raw.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(mask).alias("excluded_rows"),
        F.count_if(~mask).alias("base_rows"),
        F.count_if(mask.isNull()).alias("unaccounted_rows"),
    )


def auditable(raw: DataFrame) -> DataFrame:
    """Shaped rows and how their tags meet the keys of both JSON objects.

    `*_mismatch`: some tag has no value of its own; `other_*`: valued keys that are no
    tags, where that is all that may be wrong.
    """
    own = F.col("own_topics")
    keys = {
        "scores": topics.present_keys(F.col("scores")),
        "reasons": topics.present_keys(F.col("reasons")),
    }
    mismatches = {
        f"{name}_mismatch": F.coalesce(topics.tags_unmatched(own, F.col(f"{name}_keys")), F.lit(False))
        for name in keys
    }
    others = {
        f"other_{name}": F.when(
            ~F.col(f"{name}_mismatch"), topics.untagged_keys(own, F.col(f"{name}_keys"))
        )
        for name in keys
    }
    keyed = shape(raw).withColumns({f"{name}_keys": k for name, k in keys.items()})
    return keyed.withColumns(mismatches).withColumns(others)


def row_guards(rows: DataFrame, period: tuple[date, date] | None = None) -> DataFrame:
    """All guards an auditable row can answer alone, in one pass, as one row of counts.

    The two match guards count tags without a value here; `untagged_*` count rows with a
    value they are not tagged with, which is a violation only inside the vocabulary.
    """
    kept = _kept()

    def count(condition: Column) -> Column:
        return F.count_if(kept & condition)

    counts = {
        "missing_published_date": count(F.col("published_date").isNull()),
        "missing_title": count(F.coalesce("title", F.lit("")) == ""),
        "empty_topics": count(text.is_blank(F.col("topics_text"))),
        "duplicate_topics": count(
            F.array_size("own_topics") != F.array_size(F.array_distinct("own_topics"))
        ),
        "malformed_json": count(F.col("scores").isNull() | F.col("reasons").isNull()),
        "topic_sentiment_mismatch": count(F.col("scores_mismatch")),
        "topic_reason_mismatch": count(F.col("reasons_mismatch")),
        "row_conservation": F.count_if(F.col("excluded").isNull()),
        "untagged_scores": count(F.array_size("other_scores") > 0),
        "untagged_reasons": count(F.array_size("other_reasons") > 0),
        "base_rows": F.count_if(kept),
    }
    if period is not None:
        counts["out_of_batch_range"] = count(~F.col("published_date").between(*period))
    return rows.agg(*[c.alias(name) for name, c in counts.items()])


def untagged_guard(rows: DataFrame, raw: DataFrame) -> DataFrame:
    """Auditable rows valued for a vocabulary topic they are not tagged with, per match guard.

    Rows are counted per distinct set of such keys before the sets meet the vocabulary,
    so neither the rows nor the vocabulary are gathered anywhere.
    """
    sets = (
        rows.where(_kept())
        .select(
            F.expr(
                """inline(filter(array(
                     named_struct('guard', 'topic_sentiment_mismatch', 'keys', other_scores),
                     named_struct('guard', 'topic_reason_mismatch', 'keys', other_reasons)),
                   k -> array_size(k.keys) > 0))"""
            )
        )
        .groupBy("guard", "keys")
        .agg(F.count("*").alias("violations"))
    )
    return (
        sets.select("*", F.explode("keys").alias("topic"))
        .join(discover_topics(raw), "topic", "left_semi")
        .select("guard", "keys", "violations")
        .distinct()
        .groupBy("guard")
        .agg(F.sum("violations").alias("violations"))
    )


def duplicate_values(df: DataFrame, key: str) -> DataFrame:
    """Values of the key found more than once, with their counts; NULL is a value."""
    return df.groupBy(key).count().where(F.col("count") > 1)


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """How many article ids occur more than once."""
    ids = duplicate_values(rows.where(_kept()), "article_id")
    return ids.agg(F.count("*").alias("duplicate_article_id"))


def guard_report(raw: DataFrame, period: tuple[date, date] | None = None) -> DataFrame:
    """(guard, violations) for every guard of the cleaning stage."""
    rows = auditable(raw)
    counts = as_rows(row_guards(rows, period)).where(F.col("guard").isin(list(GUARDS)))
    return (
        counts.unionByName(as_rows(duplicate_ids(rows)))
        .unionByName(untagged_guard(rows, raw))
        .groupBy("guard")
        .agg(F.sum("violations").alias("violations"))
    )


def audit_raw(raw: DataFrame, period: tuple[date, date] | None = None) -> dict[str, int]:
    """The same counts, and `base_rows`, on the driver.

    The vocabulary is consulted only if some row carries an untagged value at all.
    """
    rows = auditable(raw)
    counts = row_guards(rows, period).first().asDict()
    counts.update(duplicate_ids(rows).first().asDict())
    if counts.pop("untagged_scores") + counts.pop("untagged_reasons"):
        for row in untagged_guard(rows, raw).collect():
            counts[row["guard"]] += row["violations"]
    return counts


def out_of_range(base: DataFrame, start: date, end: date) -> DataFrame:
    """Articles published outside the closed interval, for the operator to look at."""
    return base.where(~F.col("published_date").between(F.lit(start), F.lit(end))).select(
        "title", "published_date", "news_site"
    )


def content_guards(base: DataFrame) -> DataFrame:
    """Null and multi-line contents, as one row of counts."""
    return base.agg(
        F.count_if(F.col("content").isNull()).alias("null_content"),
        F.count_if(F.col("content").contains("\n")).alias("multiline_content"),
    )


def content_verdict(base: DataFrame, *by: str) -> DataFrame:
    """Whether all contents are present, and single-line; true on an empty table."""
    return base.groupBy(*by).agg(
        F.coalesce(F.bool_and(F.col("content").isNotNull()), F.lit(True)).alias("no_nulls"),
        F.coalesce(F.bool_and(~F.col("content").contains("\n")), F.lit(True)).alias(
            "single_line"
        ),
    )


def flatten_guard(base: DataFrame) -> DataFrame:
    """Articles with no topics: exactly those that flatten to a row too many."""
    return base.agg(
        F.count_if(F.coalesce(F.array_size("topics"), F.lit(0)) == 0).alias("flatten_row_count")
    )


def flatten_conservation(base: DataFrame, flat: DataFrame) -> DataFrame:
    """Expected and actual article-topic rows, as one row."""
    expected = base.agg(
        F.sum(F.array_size("topics")).cast("bigint").alias("expected_rows"),
        F.lit(0).cast("bigint").alias("actual_rows"),
    )
    actual = flat.agg(
        F.lit(0).cast("bigint").alias("expected_rows"), F.count("*").alias("actual_rows")
    )
    totals = expected.unionByName(actual).agg(
        F.coalesce(F.sum("expected_rows"), F.lit(0)).alias("expected_rows"),
        F.sum("actual_rows").alias("actual_rows"),
    )
    return totals.withColumn("conserved", F.col("expected_rows") == F.col("actual_rows"))


def duplicate_chunk_ids(chunks: DataFrame) -> DataFrame:
    """Rows, distinct chunk ids (NULL is one) and whether they agree, as one row.

    Ids are counted per value and then in total, so a repeated id costs no task more
    than its own counter.
    """
    per_id = chunks.groupBy("chunk_id").agg(F.count("*").alias("rows"))
    return per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("chunks"),
        F.count("*").alias("chunk_ids"),
    ).withColumn("unique", F.col("chunks") == F.col("chunk_ids"))


def duplicate_chunk_articles(base: DataFrame) -> DataFrame:
    """Article ids whose chunk ids would collide, counted before anything is chunked.

    With passages numbered from 0 per row, `id:chunk_N` repeats exactly when two rows
    with text share an id. That is a far smaller exchange than one over all passages.
    A single row without an id is left to the check made while chunking.
    """
    with_text = base.where(text.has_text(F.col("content")))
    return duplicate_values(with_text, "article_id").agg(
        F.count("*").alias("unique_chunk_id")
    )


def embedding_guards(embedded: DataFrame, dimension: int | None = None) -> DataFrame:
    """Rows, missing embeddings and dimensions of an embedded table, as one row."""
    size = F.array_size("embedding").cast("bigint")
    report = embedded.agg(
        F.count("*").alias("chunks"),
        F.count_if(F.col("embedding").isNull()).alias("missing_embedding"),
        F.min(size).alias("min_dimension"),
        F.max(size).alias("max_dimension"),
        F.count_if(size != dimension if dimension else F.lit(False)).alias("wrong_dimension"),
    )
    return report.withColumn(
        "uniform", F.coalesce(F.col("min_dimension") == F.col("max_dimension"), F.lit(False))
    )


def enforce(counts: dict[str, int], detail: dict[str, str] | None = None) -> None:
    """Raise for the first failing guard in order, naming every other one too."""
    failing = [g for g in GUARDS if counts.get(g)]
    if not failing:
        return
    lines = [f"{g}: {counts[g]} {GUARDS[g]}" for g in failing]
    extra = (detail or {}).get(failing[0])
    if extra:
        lines.insert(1, extra)
    raise IntegrityError("\n".join(lines))

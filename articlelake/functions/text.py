"""Column expressions for text, dates and keys. All run in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Unicode White_Space, used when trimming titles and topics
UNICODE_EDGES = r"(?U)^\s+|\s+\z"
# the wider whitespace class used when collapsing article text: White_Space and the
# four separators U+001C to U+001F. Written as one property, it is tested in one step
# per character; spelled out as ranges it is four times slower. A single space is no match:
# it would only be replaced by itself.
TEXT_SPACE = r"(?U)[\s\x1c-\x1f](?:(?<! )[\s\x1c-\x1f]*|[\s\x1c-\x1f]+)"
NON_SPACE = r"(?U)[^\s\x1c-\x1f]"
# a sentence ends in . ! or ? and the next opens with an ASCII capital or digit,
# optionally behind one quote or bracket; runs of space are one space by then. The space is
# looked for first, so that any other character takes one step.
SENTENCE_GAP = r" (?<=[.!?] )(?=[\"'(\[]?[A-Z0-9])"
LOCAL_OFFSET = r"\+08:00\z"
ISO_FORMAT = "yyyy-M-d H:m:s"
MONTH_FIRST_FORMAT = "M/d/yyyy H:m"
# -----------------------------------------------------------------------------


def trim_unicode(c: Column) -> Column:
    """Strip every Unicode whitespace character from both ends."""
    return F.regexp_replace(c, UNICODE_EDGES, "")


def is_blank(c: Column) -> Column:
    """True for NULL and for whitespace only; never NULL."""
    return c.isNull() | (trim_unicode(F.coalesce(c, F.lit(""))) == "")


def collapse_space(c: Column) -> Column:
    """Whitespace runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, TEXT_SPACE, " "))


def has_text(c: Column) -> Column:
    """Whether anything but whitespace occurs; looks no further than the first find."""
    return c.rlike(NON_SPACE)


def sentences(c: Column) -> Column:
    """Sentence-like units of a text; blank text has none, NULL stays NULL."""
    return F.filter(F.split(collapse_space(c), SENTENCE_GAP, -1), lambda s: s != "")


def split_trimmed(c: Column) -> Column:
    """Pipe-separated names, each trimmed; empty segments are kept."""
    return F.transform(F.split(c, r"\|", -1), trim_unicode)


def parse_day(c: Column) -> Column:
    """Local calendar day of an ISO or month-first timestamp, NULL for anything else."""
    local = F.regexp_replace(F.regexp_replace(c, "^([^T]*)T", "$1 "), LOCAL_OFFSET, "")
    return F.coalesce(
        F.try_to_date(local, ISO_FORMAT), F.try_to_date(local, MONTH_FIRST_FORMAT)
    )


def quarter_label(day: Column) -> Column:
    """`2022Q3`."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def joined_key(separator: str, *parts: Column) -> Column:
    """Parts joined by a separator; NULL as soon as one part is NULL."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(separator), part]
    return F.concat(*pieces)


def chunk_key(article_id: Column, index: Column) -> Column:
    return F.concat(article_id, F.lit(":chunk_"), index.cast("string"))


def retrieval_text(title: Column, topics: Column, excerpt: Column) -> Column:
    """The text handed to the embedding model."""
    return F.concat(
        F.lit("Title: "),
        title,
        F.lit("\nTopics: "),
        F.array_join(topics, ", "),
        F.lit("\n\nArticle excerpt:\n"),
        excerpt,
    )

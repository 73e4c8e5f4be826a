"""Column expressions for per-topic JSON objects, held as maps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from articlelake.functions.binding import let

SCORES = "map<string,double>"
REASONS = "map<string,string>"


def decode(text: Column, map_type: str) -> Column:
    """A JSON object as a map; NULL text is the empty object, bad text is NULL.

    The reader stops at the end of a value, whatever follows. So the text is read as the
    first of two elements: only one whole value leaves the closing one in its place.
    """
    enclosed = F.concat(F.lit("["), F.coalesce(text, F.lit("{}")), F.lit(',{"":1}]'))
    return let(
        F.from_json(enclosed, f"array<{map_type}>"),
        lambda both: F.when(
            (F.array_size(both) == 2) & F.map_contains_key(F.get(both, 1), F.lit("")), F.get(both, 0)
        ),
    )


def present_keys(decoded: Column) -> Column:
    """Keys that carry a value."""
    return F.map_keys(F.map_filter(decoded, lambda _, v: v.isNotNull()))


def topic_structs(own: Column, scores: Column, reasons: Column) -> Column:
    """One struct per tagged topic with a score, in topic order.

    Only the article's own tags are looked up. A scored topic outside them fails the
    match guard, so the corpus-wide vocabulary is not needed to build the output.
    """
    scored = F.filter(
        F.sort_array(own), lambda t: F.element_at(scores, t).isNotNull()
    )
    return F.transform(
        scored,
        lambda t: F.struct(
            t.alias("topic"),
            F.element_at(scores, t).alias("sentiment_score"),
            F.element_at(reasons, t).alias("explanation"),
        ),
    )


def tags_unmatched(own: Column, keys: Column) -> Column:
    """True where some tag is blank, repeated or has no value of its own."""
    return (
        F.exists(own, lambda t: (t == "") | ~F.array_contains(keys, t))
        | (F.array_size(own) != F.array_size(F.array_distinct(own)))
    )


def untagged_keys(own: Column, keys: Column) -> Column:
    """Valued keys the article is not tagged with, sorted."""
    return F.sort_array(F.array_except(keys, own))

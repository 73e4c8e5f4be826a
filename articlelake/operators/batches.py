"""Month-range batch ids as a manifest: `2026-06` or `2026-01_to_2026-05`."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.errors import IntegrityError
from articlelake.functions.binding import let
from articlelake.operators import keysets

# --- fixed values ------------------------------------------------------------
BATCH_PATTERN = r"\A\d{4}-\d{2}(_to_\d{4}-\d{2})?\z"
ERRORS = {
    "malformed": "names no month or range of months",
    "month": "names a month that does not exist",
    "cross_year": "reaches over the end of a year: deliver each year by itself",
    "reversed": "ends before it starts",
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Batch:
    batch_id: str
    year: int
    start_date: date
    end_date: date


def _range(batch_id: Column) -> Column:
    """Year, first and last day of an id, or the class of its error, as a struct."""

    def months(n: Column) -> Column:
        year, month = F.get(n, 0), F.get(n, 1)
        return F.struct(
            year.alias("y1"),
            month.alias("m1"),
            F.coalesce(F.get(n, 2), year).alias("y2"),
            F.coalesce(F.get(n, 3), month).alias("m2"),
        )

    def classed(p: Column) -> Column:
        error = (
            F.when(p.y1.isNull(), "malformed")
            .when(~(p.m1.between(1, 12) & p.m2.between(1, 12)), "month")
            .when(p.y1 != p.y2, "cross_year")
            .when(p.m1 > p.m2, "reversed")
        )
        return let(error, lambda e: days(p, e))

    def days(p: Column, error: Column) -> Column:
        valid = error.isNull()
        first, last = F.make_date(p.y1, p.m1, F.lit(1)), F.make_date(p.y2, p.m2, F.lit(1))
        return F.struct(
            F.when(valid, p.y1).alias("year"),
            F.when(valid, first).alias("start_date"),
            F.when(valid, F.last_day(last)).alias("end_date"),
            error.alias("error"),
        )

    digits = F.when(
        batch_id.rlike(BATCH_PATTERN), F.regexp_extract_all(batch_id, F.lit(r"\d+"), F.lit(0))
    )
    numbers = F.transform(F.coalesce(digits, F.array()), lambda d: d.cast("int"))
    return let(numbers, lambda n: let(months(n), classed))


def manifest(ids: DataFrame) -> DataFrame:
    """Distinct `batch_id`s with year, first and last day, or the class of their error."""
    return (
        ids.select("batch_id")
        .distinct()
        .select("batch_id", _range(F.col("batch_id")).alias("range"))
        .select("batch_id", "range.*")
    )


def overlapping(entries: DataFrame) -> DataFrame:
    """Pairs of different batches whose intervals share a day, smaller id first.

    An equi-join on the year with the interval test on top. The manifest holds every id
    once and a year has 78 valid ids (12 * 13 / 2), so no year can grow beyond that.
    """
    one = entries.where(F.col("error").isNull()).alias("a")
    two = entries.where(F.col("error").isNull()).alias("b")
    return one.join(
        two,
        (F.col("a.year") == F.col("b.year"))
        & (F.col("a.batch_id") < F.col("b.batch_id"))
        & (F.col("a.start_date") <= F.col("b.end_date"))
        & (F.col("b.start_date") <= F.col("a.end_date")),
    ).select(
        F.col("a.year").alias("year"),
        F.col("a.batch_id").alias("batch_id"),
        F.col("b.batch_id").alias("other_batch_id"),
    )


def conflicts(entries: DataFrame, batch: Batch) -> DataFrame:
    """Entries that keep a batch out: malformed names and intersecting intervals.

    The same id is a re-run and no conflict.
    """
    meets = (F.col("start_date") <= F.lit(batch.end_date)) & (
        F.lit(batch.start_date) <= F.col("end_date")
    )
    return entries.where(F.col("batch_id") != batch.batch_id).where(
        F.col("error").isNotNull() | meets
    )


def resolve(spark: SparkSession, batch_id: str) -> Batch:
    """The batch an id names; ValueError for an id that names none."""
    row = manifest(spark.createDataFrame([(batch_id,)], "batch_id string")).first()
    if row.error:
        raise ValueError(f"Batch id {batch_id!r} {ERRORS[row.error]}")
    return Batch(row.batch_id, row.year, row.start_date, row.end_date)


def require_no_overlap(entries: DataFrame, batch: Batch) -> None:
    """Raise, naming every malformed name, or else every overlapping batch."""
    rows = conflicts(entries, batch).orderBy("batch_id").collect()
    malformed = [r.batch_id for r in rows if r.error]
    if malformed:
        raise IntegrityError(
            f"cannot tell the months of some deliveries of {batch.year}, their names are no "
            f"batch ids: {malformed}"
        )
    if rows:
        raise IntegrityError(
            f"{batch.batch_id!r} shares months with {[r.batch_id for r in rows]}: retire those "
            "first"
        )


def presence(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Wanted batch ids with whether each is listed."""
    listed = existing.select("batch_id").distinct().withColumn("listed", F.lit(True))
    return (
        wanted.select("batch_id")
        .distinct()
        .join(listed, "batch_id", "left")
        .select("batch_id", F.coalesce("listed", F.lit(False)).alias("listed"))
    )


def key_index(articles: DataFrame) -> DataFrame:
    """What an index keeps of the articles of its batches: each id once per batch, with its hash."""
    return articles.select("article_id", "year", "batch_id").distinct().withColumn("key_hash", F.xxhash64("article_id"))


def repeated_in(articles: DataFrame, index: DataFrame) -> DataFrame:
    """(article_id, batches): ids of a new batch found in others, with the number of batches that hold them.

    `index` has the `key_index` rows of other batches. It is scanned in place: a Bloom filter
    of the new ids picks the rows that may match, and only those are joined. A batch of more
    ids than a filter takes is joined with the index as it is.
    """
    ids = articles.select("article_id").where(F.col("article_id").isNotNull()).distinct()
    count, keys = ids.count(), ["article_id"]
    if keysets.fits(count):
        index = index.where(keysets.build(ids, keys, 0, count).passes(keys))
    found = index.select("article_id", "batch_id").join(ids, "article_id", "left_semi")
    return found.distinct().groupBy("article_id").agg((F.count("*") + 1).alias("batches"))


def cross_batch_duplicates(articles: DataFrame) -> DataFrame:
    """Article ids found in more than one batch."""
    return (
        articles.select("article_id", "batch_id")
        .distinct()
        .groupBy("article_id")
        .agg(F.count("*").alias("batches"))
        .where(F.col("batches") > 1)
    )

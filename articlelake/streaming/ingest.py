"""Deliveries taken up as they arrive: a file stream whose epochs land and run batches.

A delivery is `<batch id>.csv`, a file or a folder of CSV files, anywhere below the folder
watched. It must be moved there as a whole, as with every file stream. The stream knows
paths it has seen by its checkpoint, so a batch is delivered again under a path of its own,
such as `<day>/<batch id>.csv`; the last one to arrive replaces the others.

An epoch does each delivery in turn and then notes it in the journal. A restart repeats the
epoch that was lost: deliveries the journal names under that epoch are skipped, and the one
that was under way is landed and run again, which replaces what it had published. So the
lake is the same as after `land_batch` and `run_batch` by hand, however often a run is lost.

A delivery that fails a guard is noted as refused with its reason and does not hold up the
others. Any other failure stops the stream, to be taken up from there.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from articlelake.errors import IntegrityError
from articlelake.plans import jobs
from articlelake.sources import lake as lakes
from articlelake.sources.lake import Lake

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
JOURNAL_SCHEMA = (
    "epoch long, nth int, delivery string, batch_id string, refused string, rows map<string, long>"
)
_DELIVERY = r"^(.*?/([^/]+)\.csv)(?:/[^/]+)?$"
# what Spark says of a guard that a task raised, of rows that don't fit their header, of other
# headers in one delivery and of a missing column
_FAULTS = ("USER_RAISED_EXCEPTION", "MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD", "CSV header does not conform", "UNRESOLVED_COLUMN")
_KEEP_PATHS = "36500d"  # a path is never forgotten: an old file is not a new delivery


@dataclass(frozen=True)
class Ingest:
    """What a stream of deliveries needs; `checkpoint` must outlive its runs."""

    lake: Lake
    incoming: str
    checkpoint: str
    chunking: jobs.Chunking
    embedding: jobs.Embedding | None = None

    @property
    def journal(self) -> str:
        return f"{self.checkpoint.rstrip('/')}/journal"


def deliveries(files: DataFrame) -> DataFrame:
    """(delivery, batch_id, arrived) of the files of an epoch, one row per delivery."""
    plain = F.coalesce(F.try_url_decode("path"), F.col("path"))
    named = files.select(
        F.regexp_extract(plain, _DELIVERY, 1).alias("delivery"),
        F.regexp_extract(plain, _DELIVERY, 2).alias("batch_id"),
        "modificationTime",
    )
    return (
        named.where(F.col("delivery") != "")
        .groupBy("delivery", "batch_id")
        .agg(F.max("modificationTime").alias("arrived"))
    )


def watch(spark: SparkSession, incoming: str) -> DataFrame:
    """The stream of delivered files: paths and times, no content."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFileAge", _KEEP_PATHS)
        .load(incoming)
        .select("path", "modificationTime")
    )


def journal(spark: SparkSession, ingest: Ingest) -> DataFrame:
    """What was done with every delivery so far, in `epoch` and `nth` order."""
    if not lakes.exists(spark, ingest.journal):
        return spark.createDataFrame([], JOURNAL_SCHEMA)
    return spark.read.schema(JOURNAL_SCHEMA).option("recursiveFileLookup", True).parquet(ingest.journal)


def _refusal(error: Exception) -> str | None:
    """The reason, where the delivery is at fault: a guard, on the driver or in a task, or the CSV itself."""
    if isinstance(error, (IntegrityError, ValueError)):
        return str(error)
    said = str(error).splitlines()
    return next((line for line in said if any(f in line for f in _FAULTS)), None)


def _do(spark: SparkSession, ingest: Ingest, delivery: str, batch_id: str) -> dict[str, int]:
    jobs.land_batch(spark, ingest.lake, batch_id, delivery, overwrite=True)
    return jobs.run_batch(spark, ingest.lake, batch_id, ingest.chunking, ingest.embedding)


def take_up(ingest: Ingest) -> Callable[[DataFrame, int], None]:
    """What an epoch does with its files. Their names are few: a year has 78 batch ids."""

    def epoch(files: DataFrame, number: int) -> None:
        spark = files.sparkSession
        done = journal(spark, ingest).where(F.col("epoch") == number).select("delivery")
        todo = deliveries(files).join(done, "delivery", "left_anti")
        first = done.count()
        for nth, row in enumerate(todo.orderBy("arrived", "delivery").collect(), first):
            refused, rows = None, {}
            try:
                rows = _do(spark, ingest, row.delivery, row.batch_id)
            except Exception as error:
                refused = _refusal(error)
                if refused is None:
                    raise
            entry = [(number, nth, row.delivery, row.batch_id, refused, rows)]
            path = f"{ingest.journal}/epoch={number}/nth={nth}"
            spark.createDataFrame(entry, JOURNAL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    return epoch


def start(spark: SparkSession, ingest: Ingest, every: str | None = None) -> StreamingQuery:
    """Take up what has arrived and end, or with `every` go on watching at that interval."""
    query = (
        watch(spark, ingest.incoming)
        .writeStream.foreachBatch(take_up(ingest))
        .option("checkpointLocation", f"{ingest.checkpoint.rstrip('/')}/stream")
    )
    timed = query.trigger(processingTime=every) if every else query.trigger(availableNow=True)
    return timed.start()


def run(spark: SparkSession, ingest: Ingest) -> None:
    """Take up what has arrived; returns when all of it is journalled."""
    start(spark, ingest).awaitTermination()

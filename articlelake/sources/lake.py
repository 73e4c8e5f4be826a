"""The batch lake: raw deliveries and stage tables partitioned by year and batch.

    <root>/raw/year=2026/2026-06.csv             a file, or a folder of CSV files
    <root>/processed/<stage>/year=2026/batch_id=2026-06/
    <root>/staging/<stage>/year=2026/batch_id=2026-06/
"""

import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from articlelake.operators.batches import Batch
from articlelake.runtime import run_folder
from articlelake.schemas import STAGES

PARTITION_COLUMNS = ["year", "batch_id"]
TARGET_FILE_BYTES = 256 << 20


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete exactly this file or folder; nothing there is no error, a refusal is."""
    files, target = _hadoop(spark, path)
    if not files.delete(target, True) and files.exists(target):
        raise OSError(f"{path} could not be deleted")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    files, old = _hadoop(spark, source)
    new = _hadoop(spark, target)[1]
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished file or folder in the place of another, which goes only then.

    Both lie in one file system, so this renames. If the second rename fails, the old
    content is put back.
    """
    before = f"{target}.before-{uuid.uuid4().hex}"
    replaces = exists(spark, target)
    if replaces:
        _rename(spark, target, before)
    try:
        _rename(spark, staged, target)
    except Exception:
        if replaces:
            _rename(spark, before, target)
        raise
    if replaces:
        remove(spark, before)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A fresh path under the shared folder, removed however the block ends."""
    folder = run_folder(spark, purpose)
    try:
        yield folder
    finally:
        remove(spark, folder)


def publish(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Write beside the target, with all checks that ride along, then take its place."""
    spark, staged = df.sparkSession, f"{target}.staged-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*partition_by or []).parquet(staged)
        swap_in(spark, staged, target)
    finally:
        remove(spark, staged)


def copy_files(spark: SparkSession, source: str, target: str) -> int:
    """Copy the files of a path byte for byte into a folder; returns their number.

    Tasks stream one file each through the file system that pyarrow finds for the path.
    """
    listed = spark.read.format("binaryFile").load(source).select("path", "length")
    n, size = listed.agg(F.count("*"), F.sum("length")).first()

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = _store(path)
                other, folder = _store(target)
                other.create_dir(folder, recursive=True)
                done = 0
                with store.open_input_stream(place) as a, other.open_output_stream(
                    f"{folder}/{place.rsplit('/', 1)[1]}"
                ) as b:
                    while part := a.read(8 << 20):
                        done += b.write(part)
                yield pa.RecordBatch.from_pydict({"copied": pa.array([done], pa.int64())})

    copied = listed.select("path").repartition(max(1, n), "path").mapInArrow(copy, "copied long")
    total = copied.agg(F.sum("copied")).first()[0]
    if total != size:
        raise OSError(f"{total} of {size} bytes of {source} were copied")
    return n


def _store(path: str):
    """A pyarrow file system and the place in it of a path as Hadoop writes it."""
    from pyarrow import fs

    local = re.match(r"(?:file:/*)?(/.*)", path.replace("file:///", "/").replace("file:/", "/"))
    if local:
        return fs.LocalFileSystem(), local[1].rstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/"))


@dataclass(frozen=True)
class Lake:
    root: str

    def raw_folder(self, year: int) -> str:
        return f"{self.root}/raw/year={year}"

    def raw(self, batch: Batch) -> str:
        return f"{self.raw_folder(batch.year)}/{batch.batch_id}.csv"

    def stage(self, stage: str) -> str:
        return f"{self.root}/processed/{stage}"

    def staging(self, stage: str) -> str:
        return f"{self.root}/staging/{stage}"

    def partition(self, stage: str, batch: Batch) -> str:
        return partition_of(self.stage(stage), batch)

    def targets(self, batch: Batch) -> dict[str, str]:
        """Everything one batch owns, raw first."""
        stages = {s: self.partition(s, batch) for s in STAGES}
        return {"raw": self.raw(batch), **stages}


def partition_of(table: str, batch: Batch) -> str:
    return f"{table}/year={batch.year}/batch_id={batch.batch_id}"


def write_partitions(df: DataFrame, table: str) -> int:
    """Replace the partitions the rows fall into, and no other; returns the row count.

    Old files go only when the job commits, so a failed run leaves them in place. The
    count comes from the tasks of the write itself.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMNS)
        .parquet(table)
    )
    return written.get["rows"]


def replace_batch(df: DataFrame, table: str, batch: Batch) -> int:
    """Make the rows the whole content of one batch; returns how many there are."""
    rows = write_partitions(df, table)
    if rows == 0:  # nothing was written over the files of an earlier run
        remove(df.sparkSession, partition_of(table, batch))
    return rows


def read_stage(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """A whole stage table, its partition columns in their places."""
    df = spark.read.parquet(table)
    return df.withColumn("batch_id", F.col("batch_id").cast("string")).select(
        *columns, "batch_id"
    )


def read_batch(spark: SparkSession, table: str, batch: Batch, columns: list[str]) -> DataFrame:
    """One batch of a stage table; only its own folder is listed."""
    df = spark.read.option("basePath", table).parquet(partition_of(table, batch))
    return df.withColumn("batch_id", F.lit(batch.batch_id)).select(*columns, "batch_id")


def raw_batches(spark: SparkSession, lake: Lake, year: int) -> DataFrame:
    """Batch ids delivered for a year: names of `*.csv` directly under its folder.

    Only names are read, no file content.
    """
    folder = lake.raw_folder(year)
    if not exists(spark, folder):
        return spark.createDataFrame([], "batch_id string")
    name = F.regexp_extract("path", rf"/raw/year={year}/([^/]*)\.csv(?:/[^/]*)?\z", 1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.coalesce(F.try_url_decode(name), name).alias("batch_id"))
        .where(F.col("batch_id") != "")
        .distinct()
    )


def inventory(spark: SparkSession, lake: Lake, batch: Batch) -> dict[str, bool]:
    """Which of a batch's raw delivery and stages exist."""
    return {name: exists(spark, path) for name, path in lake.targets(batch).items()}


def stage_inventory(spark: SparkSession, lake: Lake, batch_ids: DataFrame) -> DataFrame:
    """(batch_id, stage) for every stage the given batches have outputs in.

    For re-delivered batches these are the outputs that are stale until reprocessed.
    Only partition names are read.
    """
    found = [
        spark.read.parquet(lake.stage(s))
        .select(F.col("batch_id").cast("string").alias("batch_id"))
        .distinct()
        .withColumn("stage", F.lit(s))
        for s in STAGES
        if exists(spark, lake.stage(s))
    ]
    if not found:
        return spark.createDataFrame([], "batch_id string, stage string")
    return reduce(DataFrame.unionByName, found).join(batch_ids, "batch_id", "left_semi")


def partition_files(spark: SparkSession, table: str) -> DataFrame:
    """(year, batch_id, path, bytes, modified) of every data file of a stage table, from listing alone."""
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(table)
    plain = F.coalesce(F.try_url_decode("path"), F.col("path"))
    place = r"/year=(\d+)/batch_id=([^/]+)/[^/]+\z"
    return listed.select(
        F.regexp_extract(plain, place, 1).cast("int").alias("year"),
        F.regexp_extract(plain, place, 2).alias("batch_id"),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES, worth: int = 2) -> DataFrame:
    """Partitions with their files, bytes, the files they need, and whether they are worth rewriting.

    A partition needs as many files as its bytes fill. It is rewritten where it has `worth`
    times as many, so one that was compacted, or written well, is not touched again.
    """
    needed = F.greatest(F.lit(1), F.ceil(F.sum("bytes") / target_bytes)).cast("long")
    return (
        files.groupBy("year", "batch_id")
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), needed.alias("needed"))
        .withColumn("chosen", F.col("files") >= worth * F.col("needed"))
    )


@dataclass(frozen=True)
class Compacted:
    year: int
    batch_id: str
    files_before: int
    files_after: int
    rewritten: bool  # False where a run published the batch anew meanwhile, which stays


def stage_ages(spark: SparkSession, lake: Lake) -> DataFrame:
    """(batch_id, stage, status) of every delivered batch: `fresh`, `stale` or `missing`.

    A stage is stale where one of its files is older than the newest file it is made from:
    the delivery for `base`, and `base` or `chunks` for those made from them. What is made
    from a stale stage is stale too. Times come from the listing; nothing is read.
    """
    raw = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv")
    plain = F.coalesce(F.try_url_decode("path"), F.col("path"))
    delivered = (
        raw.load(f"{lake.root}/raw")
        .select(F.regexp_extract(plain, r"/year=\d+/([^/]*)\.csv(?:/[^/]*)?\z", 1).alias("batch_id"), "modificationTime")
        .where(F.col("batch_id") != "")
        .groupBy("batch_id")
        .agg(F.max("modificationTime").alias("delivered"))
    )
    found = delivered
    for stage in STAGES:
        if exists(spark, lake.stage(stage)):
            times = partition_files(spark, lake.stage(stage)).groupBy("batch_id")
            times = times.agg(F.min("modified").alias(f"{stage}_first"), F.max("modified").alias(f"{stage}_last"))
            found = found.join(times, "batch_id", "left")
        else:
            nothing = F.lit(None).cast("timestamp")
            found = found.withColumns({f"{stage}_first": nothing, f"{stage}_last": nothing})
    stale = {"base": F.col("base_first") < F.col("delivered")}
    for stage, source in (("flattened", "base"), ("chunks", "base"), ("embeddings", "chunks")):
        stale[stage] = F.coalesce(stale[source], F.lit(True)) | (F.col(f"{stage}_first") < F.col(f"{source}_last"))
    status = {
        s: F.when(F.col(f"{s}_first").isNull(), "missing").when(stale[s], "stale").otherwise("fresh") for s in STAGES
    }
    return found.select(
        "batch_id", F.explode(F.create_map(*(x for s in STAGES for x in (F.lit(s), status[s])))).alias("stage", "status")
    )


def compact(
    spark: SparkSession, table: str, target_bytes: int = TARGET_FILE_BYTES, worth: int = 2, at_once: int = 4
) -> list[Compacted]:
    """Rewrite the partitions of a stage table that have many more files than they need.

    Files are chosen by their sizes from listing; no other partition is read, written or
    moved. Spark packs the small files of a partition into reads of `target_bytes`, and
    each read becomes one file: rows keep their order and nothing is shuffled. A rewritten
    partition takes the place of the files it was made of, and of no others: if a batch was
    published meanwhile, its new files stay. `at_once` partitions are under way together;
    a lost run has compacted some partitions and left the others as they were.
    """
    chosen = compaction_plan(partition_files(spark, table), target_bytes, worth).where("chosen")
    rows = chosen.orderBy(F.desc("bytes")).collect()  # batches, of which a year has 78 at most
    if not rows:
        return []
    packing = {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    with settings(spark, packing), ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda r: _compact_partition(spark, table, r["year"], r["batch_id"]), rows))


def _compact_partition(spark: SparkSession, table: str, year: int, batch_id: str) -> Compacted:
    target = f"{table}/year={year}/batch_id={batch_id}"
    staged = f"{table}.compacting-{uuid.uuid4().hex}"
    moved = f"{table}.compacted-{uuid.uuid4().hex}"
    try:
        before = _data_files(spark, target)
        spark.read.parquet(target).write.parquet(staged)
        same = before == _data_files(spark, target)
        if same:
            _rename(spark, target, moved)
            try:
                same = before == _data_files(spark, moved)  # what was moved is what was read
                _rename(spark, staged if same else moved, target)
            except Exception:
                if not exists(spark, target):
                    _rename(spark, moved, target)
                raise
        return Compacted(year, batch_id, len(before), len(_data_files(spark, target)), same)
    finally:
        remove(spark, staged)
        if exists(spark, target):
            remove(spark, moved)


def _data_files(spark: SparkSession, folder: str) -> set[tuple[str, int, int]]:
    """Name, size and time of the data files directly in a folder."""
    files, target = _hadoop(spark, folder)
    return {
        (f.getPath().getName(), f.getLen(), f.getModificationTime())
        for f in files.listStatus(target)
        if not f.getPath().getName().startswith(("_", "."))
    }


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)

"""What the operators share: stored intermediates, input columns, Arrow rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.runtime import run_folder

BYTES_PER_BATCH = 2 << 20


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends there.

    What reads it twice computes it once, and a lost executor costs only a read.
    """
    path = run_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else the table carries."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )


def filtered(docs: DataFrame, make_judge: Callable[[], Callable[[pa.Array], np.ndarray]], text_column: str = "text") -> DataFrame:
    """Rows whose text the judge of the task keeps; all columns pass through, nothing is shuffled."""
    at = docs.columns.index(text_column)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps = make_judge()
        for batch in slices(batches, BYTES_PER_BATCH // 2):
            yield batch.filter(pa.array(keeps(batch.column(at)), pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_number() -> int:
    return TaskContext.get().partitionId()


def slices(batches: Iterable[pa.RecordBatch], size: int = BYTES_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """The batches cut where they hold more than `size` bytes; a single row is never cut."""
    for batch in batches:
        each = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, each):
            yield batch.slice(start, each)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def numbers(column: pa.Array) -> np.ndarray:
    """Values of a column without nulls."""
    return column.to_numpy(zero_copy_only=False)


def rows(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)

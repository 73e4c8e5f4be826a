"""Session-level helpers: the shared folder and the degree of parallelism."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets one of its own: on a cluster a
    machine-local folder would be invisible to the other machines.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="articlelake-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that they are made once."""
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Use every core on a table with fewer splits than cores, else leave it alone.

    Row-local text work is CPU-bound, so a file of one row group is worth an exchange.
    A large table already has more splits than cores and is not shuffled. Meant for
    plans that only scan: asking others for their splits would run their exchanges.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)

"""A local session with the settings the jobs expect; clusters bring their own."""

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("articlelake")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

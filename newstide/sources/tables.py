"""Readers of stored tables: known schema, pruned partitions, pruned columns."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide.schemas import MATCHED_CSV


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, empty when it has not been written yet."""
    table = spark.read.schema(schema)
    try:
        found = table.parquet(path)
        found.schema  # a remote session looks for the folder only now
        return found
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def spread(frame: DataFrame) -> DataFrame:
    """Use all cores for heavy work on a scan of a few small files.

    A large input has more splits than there are cores and is left as it is.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def days_of(frame: DataFrame, column: str) -> list[dt.date]:
    """The distinct days of a batch: a list no longer than the calendar."""
    return [r[0] for r in frame.select(column).where(F.col(column).isNotNull()).distinct().collect()]


def on_days(frame: DataFrame, column: str, days: list[dt.date]) -> DataFrame:
    """Rows of those days; on a table partitioned by the column only those folders are read."""
    return frame.where(F.col(column).isin(days) if days else F.lit(False))


def read_matched_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MATCHED_CSV).option("header", True).csv(path)


def distinct_keys(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.select(*keys).distinct()


def known(frame: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is in the table."""
    return frame.join(table.select(*keys), list(keys), "left_semi")


def unknown(frame: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not in the table."""
    return frame.join(table.select(*keys), list(keys), "left_anti")


def on_day(frame: DataFrame, symbol: str, day: dt.date, column: str = "pub_date") -> DataFrame:
    """One symbol on one day; both conditions reach the scan."""
    return frame.where((F.col("symbol") == symbol) & (F.col(column) == F.lit(day)))

"""Table writers that can be run again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


#: identities looked up in one scan
LOOKUP = 10


def balanced(frame: DataFrame, *partition_by: str) -> DataFrame:
    """Gather each partition's rows into few files, splitting a partition that is large."""
    return frame.hint("rebalance", *partition_by)


def append(
    frame: DataFrame, path: str, *partition_by: str, cluster: Sequence[str] = (), identities: Sequence[str] = ()
) -> int:
    """Append rows and return how many; counted while writing, not by a second pass.

    Files hold the rows in the order of ``cluster``, so that row groups have narrow ranges of
    these columns, and a Bloom filter per row group for every column of ``identities``, whose
    values ranges cannot tell apart.

    Spark drops the counter together with a plan it finds out to give no rows. Only then is
    the frame asked again whether it is empty; any other failure is raised.
    """
    written = Observation()
    counted = frame.observe(written, F.count(F.lit(1)).alias("n"))
    rows = balanced(counted, *partition_by)
    if cluster:
        rows = rows.sortWithinPartitions(*partition_by, *cluster)
    writer = rows.write.mode("append").partitionBy(*partition_by)
    for column in identities:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # sized by what a row group really holds, up to the largest size allowed
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)
    try:
        return written.get["n"]
    except Py4JJavaError:
        if frame.isEmpty():
            return 0
        raise


def with_identity(table: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The rows of a few identities, looked up ``LOOKUP`` at a time.

    So many are handed to the files as single values, which Bloom filters answer; of longer
    lists Spark hands on the range only.
    """
    wanted = sorted(set(values))
    parts = [
        table.where(F.col(column).isin(wanted[i : i + LOOKUP])) for i in range(0, len(wanted), LOOKUP)
    ]
    return reduce(DataFrame.unionByName, parts) if parts else table.where(F.lit(False))


def replace_batch(frame: DataFrame, path: str, batch_id: str, day: str) -> None:
    """Write one batch's rows, partitioned by day and batch; a rerun replaces its own rows only."""
    tagged = frame.withColumn("batch_id", F.lit(batch_id))
    (
        balanced(tagged, day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day, "batch_id")
        .parquet(path)
    )


def replace_lines(frame: DataFrame, path: str, batch_id: str) -> None:
    """Write one batch's lines of text into a folder of its own; a rerun replaces them."""
    frame.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV files with a header, replacing what the folder held."""
    frame.write.mode("overwrite").option("header", True).csv(path)

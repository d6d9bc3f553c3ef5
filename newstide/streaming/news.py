"""Daily sentiment kept up to date as articles arrive, and matched files consumed once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newstide.operators.daily import daily_counts
from newstide.schemas import MATCHED_CSV
from newstide.sinks.tables import replace_batch


def write_daily_counts(
    articles: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    stream: str = "stream",
) -> StreamingQuery:
    """Add every micro-batch's counts to the counts table.

    Counts add up, so no state is kept between batches: late articles of any day join it,
    and a replayed batch replaces its own counts. Streams into one table, and a stream that
    starts again with a new checkpoint, need names of their own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(daily_counts(classify(batch)), table, f"{stream}-{batch_id}", "pub_date")

    return (
        articles.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def consume_datasets(
    spark: SparkSession,
    folder: str,
    archive: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Hand every new matched CSV file to ``handle`` once and archive it afterwards.

    Rows carry the ``run_date`` of the folder their file is in, if any. The checkpoint says
    what has been consumed; a file is moved by the run after the one that read it.
    """
    run_date = F.try_to_date(F.regexp_extract("_metadata.file_path", r"run_date=(\d{4}-\d{2}-\d{2})", 1))
    rows = (
        spark.readStream.schema(MATCHED_CSV)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", archive)
        .csv(folder)
        .withColumn("run_date", run_date)
    )
    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Bars of event-time windows, kept up to date as trades arrive.

The state of a window is its bar, so it does not grow with the trades; windows older than the
watermark leave the state, and trades that come later than that are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newstide.sinks.tables import replace_batch

KEYS = ["symbol", "start"]
VALUES = ["open", "high", "low", "close", "volume", "trades"]


def window_bars(ticks: DataFrame, width: str, delay: str | None = None) -> DataFrame:
    """A bar per symbol and tumbling window of ``width``: prices, volume and number of trades.

    ``ticks`` are a batch or a stream; a stream needs ``delay``, how much later than the newest
    trade one may come. First and last price are those of the least and greatest ``seq``.
    """
    timely = ticks if delay is None else ticks.withWatermark("ts", delay)
    return (
        timely.groupBy("symbol", F.window("ts", width).alias("window"))
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
            F.count("*").alias("trades"),
        )
        .select("symbol", F.col("window.start").alias("start"), *VALUES)
    )


def write_window_bars(
    ticks: DataFrame,
    table: str,
    checkpoint: str,
    width: str,
    delay: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Write the windows that a micro-batch changes; read them back through ``current_bars``.

    A window that is still open is written again with every batch that adds to it. A replayed
    batch finds the state of the batch before it and replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch.withColumn("bar_date", F.to_date("start")), table, f"{batch_id:09d}", "bar_date")

    writer = (
        window_bars(ticks, width, delay)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def current_bars(written: DataFrame) -> DataFrame:
    """The newest state of every window that has been written."""
    newest = F.max_by(F.struct(*VALUES), "batch_id").alias("bar")
    return written.groupBy(*KEYS).agg(newest).select(*KEYS, "bar.*")


def late_trades(ticks: DataFrame, bars: DataFrame, width: str) -> DataFrame:
    """How many trades of each window came too late: those that ``ticks`` has and its bar lacks."""
    every = window_bars(ticks, width).select(*KEYS, F.col("trades").alias("landed"))
    late = F.col("landed") - F.coalesce("trades", F.lit(0))
    both = every.join(bars.select(*KEYS, "trades"), KEYS, "left")
    return both.select(*KEYS, late.alias("late")).where("late > 0")

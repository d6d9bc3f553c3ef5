"""Trade messages to a table of trades."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from newstide.operators.rows import listed
from newstide.schemas import TRADE_ENVELOPE, TRADE_LIST_DDL
from newstide.sinks.points import trade_points
from newstide.sinks.tables import replace_batch, replace_lines

# what tells messages apart and orders them, from the first to the last that counts
PLACE = {"timestamp": "timestamp", "partition": "int", "offset": "bigint"}


def placed(messages: DataFrame) -> DataFrame:
    """Messages with all columns of their place; those their source does not give are null."""
    missing = {c: F.lit(None).cast(t) for c, t in PLACE.items() if c not in messages.columns}
    return messages.withColumns(missing).select(*PLACE, "value")


def _data(envelopes: DataFrame) -> Column:
    return F.from_json("value", TRADE_ENVELOPE)["data"]


def republished(envelopes: DataFrame) -> DataFrame:
    """The envelopes that carry data, reduced to the list of trades."""
    rest = [c for c in envelopes.columns if c != "value"]
    data = envelopes.select(*rest, _data(envelopes).alias("data")).where(F.col("data").isNotNull())
    return data.select(*rest, F.to_json("data").alias("value"))


def not_republished(envelopes: DataFrame) -> DataFrame:
    """The other envelopes with their ``problem``: control messages and what is no JSON."""
    unread = F.get_json_object("value", "$").isNull()
    problem = F.when(unread, "unreadable envelope").otherwise("no data")
    return envelopes.where(_data(envelopes).isNull()).withColumn("problem", problem)


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send message values to a Kafka topic; needs Spark's Kafka connector."""
    return (
        messages.select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def trade_entries(messages: DataFrame) -> DataFrame:
    """One row per trade of each message, with a ``problem`` where it cannot be used.

    ``seq`` orders trades by when their message was sent, its part of the topic and its
    number there, and by place in the message: offsets of two parts cannot be compared.
    """
    trades = F.from_json("value", TRADE_LIST_DDL)
    t = F.col("trade")
    return listed(placed(messages), *PLACE, "value", trade=trades).select(
        t["s"].alias("symbol"),
        F.timestamp_millis(t["t"]).alias("ts"),
        t["p"].alias("price"),
        t["v"].alias("volume"),
        F.struct(*PLACE, F.coalesce("place", F.lit(0)).alias("place")).alias("seq"),
        F.when(F.col("unread"), "unreadable message")
        .when(t["s"].isNull(), "no symbol")
        .when(t["t"].isNull(), "no time")
        .when(t["p"].isNull(), "no price")
        .alias("problem"),
        "value",
    )


def trade_rows(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("problem").isNull()).drop("problem", "value")


def trade_rejects(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("problem").isNotNull()).select("seq", "problem", "value")


def envelope_rejects(envelopes: DataFrame) -> DataFrame:
    """Envelopes without trades, in the form of rejected trades."""
    bad = not_republished(placed(envelopes))
    return bad.select(F.struct(*PLACE, F.lit(0).alias("place")).alias("seq"), "problem", "value")


def last_writes(trades: DataFrame) -> DataFrame:
    """One trade per symbol and millisecond: the one written last.

    Only numbers are kept per key, so tasks reduce their own rows before the shuffle.
    """
    return trades.groupBy("symbol", "ts").agg(
        F.max_by("price", "seq").alias("price"),
        F.max_by("volume", "seq").alias("volume"),
        F.max("seq").alias("seq"),
    )


def write_trades(
    messages: DataFrame,
    table: str,
    rejects: str,
    checkpoint: str,
    available_now: bool = True,
    enveloped: bool = False,
    points: str | None = None,
) -> StreamingQuery:
    """Keep the trades table up to date; read it back through ``last_writes``.

    A batch that is replayed after a failure replaces the rows it wrote before, so every
    trade is in the table once per batch. ``enveloped`` messages are those of the feed, whose
    other envelopes are kept as rejects; ``points`` is a folder for the batch's trades as
    time-series points.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        entries = trade_entries(republished(batch) if enveloped else batch).persist(StorageLevel.MEMORY_AND_DISK)
        good = last_writes(trade_rows(entries)).withColumn("trade_date", F.to_date("ts"))
        replace_batch(good, table, str(batch_id), "trade_date")
        bad = trade_rejects(entries)
        if enveloped:
            bad = bad.unionByName(envelope_rejects(batch))
        (
            bad.withColumn("batch_id", F.lit(str(batch_id)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(rejects)
        )
        if points:
            replace_lines(trade_points(last_writes(trade_rows(entries))), points, str(batch_id))
        entries.unpersist()
        batch.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def settle_trades(
    messages: DataFrame, table: str, checkpoint: str, delay: str, enveloped: bool = False, available_now: bool = True
) -> StreamingQuery:
    """Write each trade's last write once, when no other can come any more.

    The state has the last write so far of every symbol and millisecond that is not ``delay``
    older than the newest trade; an older one leaves the state and is written, so the table needs
    no reduction when it is read and the state holds ``delay``'s worth of keys. A later write for
    a key that has been written is dropped. A replayed batch starts from the state before it
    and replaces its own rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(batch.withColumn("trade_date", F.to_date("ts")), table, f"{batch_id:09d}", "trade_date")

    entries = trade_entries(republished(messages) if enveloped else messages)
    writer = (
        last_writes(trade_rows(entries).withWatermark("ts", delay))
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def stop_when_idle(query: StreamingQuery, silence: float, poll: float = 0.2) -> bool:
    """Wait until a continuous query has read nothing for ``silence`` seconds and stop it.

    False if the query ended by itself. Batches without rows count as silence; a batch that is
    running does not. The checkpoint says where a query started again goes on.
    """
    batch, since = None, time.monotonic()
    while not query.awaitTermination(poll):
        progress = query.lastProgress
        last = progress["batchId"] if progress and progress["numInputRows"] else batch
        if last != batch or query.status["isTriggerActive"] and query.status["isDataAvailable"]:
            batch, since = last, time.monotonic()
        elif time.monotonic() - since >= silence:
            query.stop()
            return True
    return False


def compact(trades: DataFrame, path: str) -> None:
    """Write the trades of finished days, each key once, by day; a rerun replaces those days."""
    finished = last_writes(trades).withColumn("trade_date", F.to_date("ts"))
    (
        finished.hint("rebalance", "trade_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trade_date")
        .parquet(path)
    )

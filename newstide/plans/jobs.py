"""The jobs: news ingest, price ingest, the daily run, the trade stream.

State that changes is kept as append-only tables next to the data. A run writes its data
first and its ledger entries last, all under its own batch, so a run that failed half-way
or is simply repeated ends with the same tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide import schemas
from newstide.operators import daily, features, increments, least_squares, matching, naive_bayes, news, prices, texts
from newstide.session import remove_folder
from newstide.sinks import points, tables
from newstide.sources import landing
from newstide.sources.streams import file_messages
from newstide.sources.tables import days_of, on_days, read_table
from newstide.streaming.news import consume_datasets
from newstide.streaming.ticks import compact, last_writes, write_trades


class Forecaster(Protocol):
    """A price model: ``least_squares``, ``forecast`` and ``gated_cell`` are such modules."""

    def train(self, rows: DataFrame, path: str, previous: str | None = None) -> object: ...

    def score(self, rows: DataFrame, path: str) -> DataFrame: ...


@dataclass(frozen=True)
class Store:
    """Places of the tables below one shared folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.path(name), getattr(schemas, name.upper()))

    def read_other_batches(self, spark: SparkSession, name: str, batch_id: str) -> DataFrame:
        """A ledger without the entries of this batch, so that a rerun does all its work again."""
        return self.read(spark, name).where(F.col("batch_id") != batch_id)


def ingest_news(
    spark: SparkSession,
    store: Store,
    messages: DataFrame,
    pages: DataFrame,
    batch_id: str,
    tag: str = "div",
    css_class: str | None = "caas-body",
) -> int:
    """Append the articles of landed feed messages that are not stored yet."""
    entries = landing.news_entries(messages)
    # only the days of the batch are looked up in the store, and no texts
    stored = on_days(store.read(spark, "news"), "pub_date", days_of(entries, "pub_date"))
    # pages are worked through for articles that are new
    fresh = news.one_address(news.not_stored(landing.candidates(entries), stored), pages)
    articles = landing.with_article_text(fresh, pages, tag, css_class)
    rows = articles.select("guid", "symbol", "title", "text", "pub_date")
    added = tables.append(rows, store.path("news"), "pub_date", cluster=["symbol"], identities=["guid"])
    bad = landing.rejects(entries).select("symbol", "title", "url", "problem")
    bad.write.mode("overwrite").parquet(store.path(f"news_rejects/batch_id={batch_id}"))
    return added


def ingest_prices(spark: SparkSession, store: Store, messages: DataFrame, batch_id: str) -> int:
    """Append the bars of landed price messages whose symbol and day are not stored yet."""
    entries = landing.price_entries(messages)
    bars = landing.price_rows(entries).drop("problem")
    stored = on_days(store.read(spark, "prices"), "bar_date", days_of(bars, "bar_date"))
    added = tables.append(prices.new_bars(bars, stored), store.path("prices"), "bar_date")
    bad = landing.rejects(entries).select("symbol", "problem")
    bad.write.mode("overwrite").parquet(store.path(f"price_rejects/batch_id={batch_id}"))
    return added


def stored_articles(
    spark: SparkSession, store: Store, guids: Sequence[str], days: Sequence[dt.date] = ()
) -> DataFrame:
    """The stored articles of a few identities, on given days or all.

    Row groups whose Bloom filter has none of them are passed by unread.
    """
    stored = store.read(spark, "news")
    return tables.with_identity(on_days(stored, "pub_date", list(days)) if days else stored, "guid", guids)


def classify_open_news(
    spark: SparkSession,
    store: Store,
    run_date: dt.date,
    model: naive_bayes.NaiveBayesModel,
    words: DataFrame | None = None,
    abbreviations: Sequence[str] = (),
) -> bool:
    """Classify unprocessed articles of closed days; whether there were any."""
    batch_id = run_date.isoformat()
    stored = store.read(spark, "news")
    done = store.read_other_batches(spark, "processed_news", batch_id)
    days = days_of(news.open_days(stored, done, F.lit(run_date)), "pub_date")
    if not days:
        return False
    todo = news.open_news(
        on_days(stored, "pub_date", days), on_days(done, "pub_date", days), F.lit(run_date)
    )
    docs = todo.select("guid", "symbol", "pub_date", "text")
    if words is None:
        tokens = texts.with_stems(docs, abbreviations=abbreviations)
    else:
        tokens = texts.with_corrected_stems(docs, words, store.path(f"work/{batch_id}"), "guid", abbreviations)
    terms = texts.with_terms(tokens)
    scored = naive_bayes.score(terms, model, "guid", "symbol", "pub_date")
    tables.replace_batch(scored, store.path("classified_news"), batch_id, "pub_date")
    if words is not None:
        remove_folder(spark, store.path(f"work/{batch_id}"))

    # the texts are worked through once: counts and ledger come from what was written
    written = store.read(spark, "classified_news").where(F.col("batch_id") == batch_id)
    counts = daily.daily_counts(written)
    tables.replace_batch(counts, store.path("daily_counts"), batch_id, "pub_date")
    tables.replace_batch(
        written.select("guid", "pub_date"), store.path("processed_news"), batch_id, "pub_date"
    )
    return True


def daily_sentiment(spark: SparkSession, store: Store) -> DataFrame:
    """All days so far, with the counts of all batches added up."""
    return daily.with_indicators(daily.merged_counts(store.read(spark, "daily_counts")))


def match_prices(spark: SparkSession, store: Store, run_date: dt.date, max_gap: int = 1) -> str | None:
    """Write the dataset of newly matched days as CSV; its folder, or nothing to match.

    A day is matched with the bar of the day after or, for a larger ``max_gap``, with the next
    bar so many days later at most. A day without such a bar stays open until one arrives.
    """
    batch_id = run_date.isoformat()
    done = store.read_other_batches(spark, "matched_days", batch_id)
    todo = matching.unmatched(daily_sentiment(spark, store), done)
    bars = store.read(spark, "prices")
    matched = matching.match_next_day(todo, bars) if max_gap == 1 else matching.match_next_bar(todo, bars, max_gap)
    if matched.isEmpty():
        return None
    folder = store.path(f"datasets/run_date={batch_id}")
    tables.write_csv(matching.matched_csv_rows(matched), folder)
    tables.replace_batch(
        matched.select("symbol", "articles", "pub_date").distinct(),
        store.path("matched_days"),
        batch_id,
        "pub_date",
    )
    return folder


def take_in_datasets(spark: SparkSession, store: Store) -> None:
    """Add matched files that no run has taken in to the training rows, and archive them.

    A file is taken in once and moved by the run after.
    """

    def keep(rows: DataFrame, batch_id: int) -> None:
        tables.replace_batch(rows, store.path("training_rows"), f"{batch_id:09d}", "run_date")

    consume_datasets(
        spark, store.path("datasets"), store.path("archive"), store.path("checkpoints/datasets"), keep
    ).awaitTermination()


def training_rows(spark: SparkSession, store: Store, run_date: dt.date) -> DataFrame:
    """One row per symbol and day: the last one matched by the runs up to ``run_date``."""
    taken = store.read(spark, "training_rows").where(F.col("run_date") <= F.lit(run_date))
    return features.features_and_targets(matching.last_matched(taken).withColumn("pub_date", F.to_date("_pubDate")))


def last_model(spark: SparkSession, store: Store, run_date: dt.date, own: bool = True) -> str | None:
    """Where the newest finished model of the runs up to (or, not ``own``, before) ``run_date`` is."""
    known = store.read(spark, "trained_models")
    until = F.col("run_date") <= F.lit(run_date) if own else F.col("run_date") < F.lit(run_date)
    newest = known.where(until).agg(F.max_by("path", "run_date").alias("path")).first()
    return newest["path"]


def train_on(
    spark: SparkSession, store: Store, run_date: dt.date, forecaster: Forecaster = least_squares
) -> None:
    """Fit on the rows so far, going on from the model before, into a folder of this run.

    The model counts once it is entered as trained, so a failure leaves the one before.
    """
    path = store.path(f"models/price/run_date={run_date.isoformat()}")
    previous = last_model(spark, store, run_date, own=False)
    forecaster.train(training_rows(spark, store, run_date), path, previous=previous)
    entry = spark.createDataFrame([(path, run_date)], "path string, run_date date")
    tables.replace_batch(entry, store.path("trained_models"), run_date.isoformat(), "run_date")


def train_from_sums(spark: SparkSession, store: Store, run_date: dt.date) -> list[dt.date]:
    """Fit from per-day sums, replacing those of the days this run has matched; which days they are.

    The rows of other days are not read: a run's files hold its own days, and the condition on the
    day passes by the files of other runs. The model is stored and entered as by ``train_on``.
    """
    taken = store.read(spark, "training_rows").where(F.col("run_date") <= F.lit(run_date))
    own = taken.where(F.col("run_date") == F.lit(run_date)).select(F.to_date("_pubDate").alias("pub_date"))
    days = days_of(own, "pub_date")
    changed = taken.where(F.col("_pubDate").isin([d.isoformat() for d in days]) if days else F.lit(False))
    rows = matching.last_matched(changed).withColumn("pub_date", F.to_date("_pubDate"))
    increments.update(features.features_and_targets(rows), store.path("day_sums"), run_date.isoformat())
    path = store.path(f"models/price/run_date={run_date.isoformat()}")
    sums = store.read(spark, "day_sums").where(F.col("batch_id") <= F.lit(run_date.isoformat()))
    increments.train(sums, path)
    entry = spark.createDataFrame([(path, run_date)], "path string, run_date date")
    tables.replace_batch(entry, store.path("trained_models"), run_date.isoformat(), "run_date")
    return days


def predict(
    spark: SparkSession,
    store: Store,
    symbols: DataFrame,
    run_date: dt.date,
    model_path: str,
    forecaster: Forecaster = least_squares,
    max_gap: int = 1,
) -> DataFrame:
    sentiment, bars = daily_sentiment(spark, store), store.read(spark, "prices")
    if max_gap == 1:
        rows = features.serving_rows(symbols, sentiment, bars, run_date)
    else:
        rows = features.serving_rows_of_next_bar(symbols, sentiment, bars, run_date, max_gap)
    return forecaster.score(rows, model_path)


def run_day(
    spark: SparkSession,
    store: Store,
    run_date: dt.date,
    symbols: DataFrame,
    sentiment_model: naive_bayes.NaiveBayesModel,
    words: DataFrame | None = None,
    forecaster: Forecaster = least_squares,
    max_gap: int = 1,
    abbreviations: Sequence[str] = (),
    from_sums: bool = False,
) -> bool:
    """Classify, match, train, predict and publish; later steps only if articles arrived.

    ``from_sums`` fits the default model from sums per day instead of all rows.
    """
    if not classify_open_news(spark, store, run_date, sentiment_model, words, abbreviations):
        return False
    folder = match_prices(spark, store, run_date, max_gap)
    if folder is not None:
        take_in_datasets(spark, store)
        if from_sums:
            train_from_sums(spark, store, run_date)
        else:
            train_on(spark, store, run_date, forecaster)
    model_path = last_model(spark, store, run_date)
    if model_path is not None:
        predictions = predict(spark, store, symbols, run_date, model_path, forecaster, max_gap)
        day = store.path(f"predictions/run_date={run_date.isoformat()}")
        predictions.write.mode("overwrite").parquet(day)
        written = spark.read.schema(schemas.PREDICTIONS).parquet(day)
        points.write_points(points.prediction_points(written), store.path(f"points/run_date={run_date}"))
    return True


def run_trades(
    spark: SparkSession,
    store: Store,
    landed: str,
    source: Callable[[SparkSession, str], DataFrame] = file_messages,
) -> DataFrame:
    """Take in all trade messages there are now; the trades so far, last write per key."""
    query = write_trades(
        source(spark, landed),
        store.path("trades"),
        store.path("trade_rejects"),
        store.path("checkpoints/trades"),
        enveloped=True,
        points=store.path("trade_points"),
    )
    query.awaitTermination()
    return trades(spark, store)


def compact_trades(spark: SparkSession, store: Store, before: dt.date) -> None:
    """Gather the batches of days before ``before`` into one table of days, each key once.

    The days are entered with the last batch they hold, after their data. Later trades of such
    a day are read from their batches until it is compacted again.
    """
    raw = store.read(spark, "trades").withColumn("batch", F.col("batch_id").cast("bigint"))
    through = raw.agg(F.max("batch")).first()[0]
    if through is None:
        return
    finished = raw.where((F.col("trade_date") < F.lit(before)) & (F.col("batch") <= through)).drop("batch")
    compact(finished, store.path("trade_days"))
    days = finished.select("trade_date").distinct().select(F.lit(through).alias("through"), "trade_date")
    tables.replace_batch(days, store.path("compacted_days"), "newest", "trade_date")


def trades(spark: SparkSession, store: Store) -> DataFrame:
    """All trades, last write per key: finished days as compacted, and what their batches have since.

    Batches that a compacted day holds are not read again. Only days with later batches are
    reduced anew, together with their compacted trades.
    """
    raw = store.read(spark, "trades").withColumn("batch", F.col("batch_id").cast("bigint"))
    days = store.read(spark, "trade_days")
    # a number per compacted day reaches the driver, from the partitions and a column of counts
    held: dict[int, list[dt.date]] = {}
    for day, through in store.read(spark, "compacted_days").select("trade_date", "through").collect():
        held.setdefault(through, []).append(day)
    known = [F.col("trade_date").isin(own) & (F.col("batch") <= through) for through, own in held.items()]
    newer = raw.where(~reduce(or_, known)) if known else raw
    finished = [day for own in held.values() for day in own]
    reopened = days_of(on_days(newer, "trade_date", finished), "trade_date")
    again = days.where(F.col("trade_date").isin(reopened) if reopened else F.lit(False))
    settled = days.where(F.col("trade_date").isin([d for d in finished if d not in set(reopened)]) if finished else F.lit(False))
    columns = ["symbol", "ts", "price", "volume", "seq"]
    rest = last_writes(newer.select(columns).unionByName(again.select(columns)))
    return settled.select(rest.columns).unionByName(rest)

"""The registered queries: every operator over the whole benchmark tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newstide import schemas
from newstide.functions.html import article_text
from newstide.functions.identity import article_url
from newstide.functions.porter import stem
from newstide.operators import (
    daily,
    features,
    forecast,
    gated_cell,
    increments,
    least_squares,
    matching,
    naive_bayes,
    nesting,
    news,
    prices,
    sentences as sentence_steps,
    spelling,
    texts,
)
from newstide.schemas import FEATURES, TARGETS, TRADE_LIST_DDL
from newstide.session import work_folder
from newstide.sinks import committed, points, tables
from newstide.sources import drift, fixtures, landing
from newstide.sources.streams import table_rows
from newstide.sources.tables import distinct_keys, known, on_day, read_matched_csv, read_table, spread, unknown
from newstide.streaming import bars as bar_stream
from newstide.streaming import ticks as tick_stream
from newstide.streaming.news import write_daily_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Words that occur at least once in so many documents are taken as spelled correctly: the
# dictionary does not grow with a corpus that is more of the same.
KNOWN_WORD_DOCUMENTS = 125
# The day the daily jobs are run for.
RUN_DATE = dt.date(2024, 1, 16)
MONDAY = dt.date(2024, 1, 15)
# How far ahead of a bar its news may be.
NEXT_BAR_DAYS = 4
# Event-time windows of trades, and how late a trade may come.
BAR_WINDOW, TRADE_DELAY = "1 hour", "1 day"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


BULLISH = ["bullish_indicator", "bullish_indicator_all_posts", "agreement_indicator"]


# --- daily sentiment ------------------------------------------------------------------


@query
def daily_sentiment(spark, sf_dir):
    """Counts, label and indicators per symbol and day."""
    out = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    return rounded(out, *BULLISH)


@query
def incremental_merge(spark, sf_dir):
    """Daily sentiment from the counts of two batches: English articles and all others."""
    classified = fixtures.classified_articles(spark, sf_dir)
    first = daily.daily_counts(classified.where(F.col("lang").eqNullSafe("en")))
    second = daily.daily_counts(classified.where(~F.col("lang").eqNullSafe("en")))
    return rounded(daily.with_indicators(daily.merged_counts(first, second)), *BULLISH)


@query
def unmatched_days(spark, sf_dir):
    """Days of news without a bar on the day after, with bars that are not stored yet missing."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    matched = matching.match_next_day(sentiment, _stored_bars(spark, sf_dir))
    ledger = matched.select("symbol", "pub_date", (F.col("pos_n") + F.col("neg_n")).alias("articles"))
    return matching.unmatched(sentiment, ledger).select("symbol", "pub_date", "articles")


# --- prices ---------------------------------------------------------------------------


def _bars(spark, sf_dir):
    return prices.daily_bars(fixtures.ticks(spark, sf_dir))


def _stored_bars(spark, sf_dir):
    """All bars but those of every third day and of two symbols."""
    bars = _bars(spark, sf_dir)
    return bars.where((F.dayofmonth("bar_date") % 3 != 0) & ~F.col("symbol").isin("src3", "src11"))


@query
def daily_bars(spark, sf_dir):
    return rounded(_bars(spark, sf_dir), "volume")


@query
def latest_open(spark, sf_dir):
    return prices.latest_open(_bars(spark, sf_dir))


@query
def missing_previous_day(spark, sf_dir):
    return prices.without_previous_day(_bars(spark, sf_dir))


@query
def new_price_rows(spark, sf_dir):
    """Bars that a store with gaps does not have."""
    return prices.new_bars(_bars(spark, sf_dir), _stored_bars(spark, sf_dir))


@query
def stored_bars(spark, sf_dir):
    """Bars appended twice to a table: how many rows each time added, and how many it has."""
    folder = work_folder(spark, "prices")
    added = []
    for _ in range(2):
        stored = read_table(spark, folder, schemas.PRICES)
        added.append(tables.append(prices.new_bars(_bars(spark, sf_dir), stored), folder, "bar_date"))
    counts = read_table(spark, folder, schemas.PRICES).agg(F.count(F.lit(1)).alias("stored"))
    return counts.select(F.lit(added[0]).alias("first"), F.lit(added[1]).alias("again"), "stored")


def _price_messages(bars):
    """Bars as feed messages, one per symbol and month so that a message stays small."""
    seconds = F.unix_date("bar_date").cast("bigint") * 86400
    record = F.struct(seconds.alias("date"), "open", "high", "low", "close", "volume")
    return (
        bars.groupBy("symbol", F.trunc("bar_date", "month").alias("month"))
        .agg(F.collect_list(record).alias("prices"))
        .select("symbol", F.to_json(F.struct("prices")).alias("message"))
    )


@query
def price_feed_rows(spark, sf_dir):
    """Price feed messages parsed back to bars."""
    entries = landing.price_entries(_price_messages(_bars(spark, sf_dir)))
    return landing.price_rows(entries)


@query
def feed_drift(spark, sf_dir):
    """Price messages that are stored whole and compared with the feed's schema.

    Every third symbol sends a field more, every fourth its volumes as text, every seventh no list.
    """
    symbol = F.substring("symbol", 4, 9).cast("int")
    seconds = F.unix_date("bar_date").cast("bigint") * 86400
    figures = [seconds.alias("date"), "open", "high", "low", "close"]
    volume = F.col("volume").cast("bigint").alias("volume")
    # fields of one message are of one kind: to_json leaves out the null ones
    record = F.to_json(F.struct(*figures, F.when(symbol % 4 != 0, volume).alias("volume"),
                                F.when(symbol % 3 == 0, F.lit(2)).alias("split")))
    as_text = F.regexp_replace(record, "}$", F.concat(F.lit(',"volume":"'), volume.cast("string"), F.lit('"}')))
    one = F.when(symbol % 4 == 0, as_text).otherwise(record).alias("record")
    listed = (
        _bars(spark, sf_dir)
        .groupBy("symbol", symbol.alias("number"), F.trunc("bar_date", "month").alias("month"))
        .agg(F.array_join(F.collect_list(one), ",").alias("records"))
    )
    whole = F.concat(F.lit('{"prices":['), "records", F.lit("]}"))
    messages = listed.select("symbol", F.when(F.col("number") % 7 == 0, '{"prices":"none"}').otherwise(whole).alias("message"))
    folder = work_folder(spark, "documents")
    drift.documents(messages).write.parquet(folder)
    return drift.drift(read_table(spark, folder, drift.DOCUMENTS), schemas.PRICE_FEED)


@query
def price_feed_rejects(spark, sf_dir):
    """Price records without a figure: every seventh day has no opening price, every fifth no volume."""
    day = F.dayofmonth("bar_date")
    bars = _bars(spark, sf_dir).withColumns(
        {"open": F.when(day % 7 != 0, F.col("open")), "volume": F.when(day % 5 != 0, F.col("volume"))}
    )
    entries = landing.price_entries(_price_messages(bars))
    return landing.rejects(entries).select("symbol", "bar_date", "problem")


# --- matched dataset, features, models --------------------------------------------------


def _matched(spark, sf_dir):
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    return matching.next_day_dataset(sentiment, _bars(spark, sf_dir))


@query
def matched_dataset(spark, sf_dir):
    """A day's sentiment with the bar of the day after."""
    return rounded(_matched(spark, sf_dir), *BULLISH)


def _week_bars(spark, sf_dir):
    """Bars as an exchange has them: none on Saturdays and Sundays."""
    return _bars(spark, sf_dir).where(~F.dayofweek("bar_date").isin(1, 7))


@query
def next_bar_match(spark, sf_dir):
    """A day's sentiment with the symbol's next bar: Friday's and the weekend's with Monday's."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    matched = matching.match_next_bar(sentiment, _week_bars(spark, sf_dir), NEXT_BAR_DAYS)
    return rounded(matched.select("symbol", "pub_date", "bar_date", *matching.INDICATORS, *schemas.BAR), *BULLISH)


@query
def next_bar_serving(spark, sf_dir):
    """The newest sentiment since the bar before, and the open, of a Monday."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    bars = _week_bars(spark, sf_dir)
    symbols = distinct_keys(bars, "symbol")
    return rounded(features.serving_rows_of_next_bar(symbols, sentiment, bars, MONDAY, NEXT_BAR_DAYS), *BULLISH)


@query
def matched_csv(spark, sf_dir):
    """The matched dataset written to CSV and read again."""
    folder = work_folder(spark, "matched-csv")
    tables.write_csv(matching.matched_csv_rows(_matched(spark, sf_dir)), folder)
    return rounded(read_matched_csv(spark, folder), *BULLISH)


@query
def training_rows(spark, sf_dir):
    """Matched days of two runs, the second with more articles: the newest row of each day."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    early = fixtures.classified_articles(spark, sf_dir).where("doc_id % 3 <> 0")
    runs = []
    for number, rows in enumerate((daily.daily_sentiment(early), sentiment.where("symbol < 'src5'"))):
        matched = matching.match_next_day(rows, _bars(spark, sf_dir))
        run_date = F.lit(RUN_DATE + dt.timedelta(days=number)).alias("run_date")
        runs.append(matching.matched_csv_rows(matched).select("*", run_date, F.lit("0").alias("batch_id")))
    return rounded(matching.last_matched(runs[0].unionByName(runs[1])), *BULLISH)


@query
def encoded_features(spark, sf_dir):
    return rounded(features.features_and_targets(_matched(spark, sf_dir)), *BULLISH)


@query
def feature_ranges(spark, sf_dir):
    out = features.feature_ranges(features.features_and_targets(_matched(spark, sf_dir)))
    return rounded(out, "low", "high")


@query
def minmax_features(spark, sf_dir):
    """Features scaled by stored ranges."""
    rows = features.features_and_targets(_matched(spark, sf_dir))
    folder = work_folder(spark, "ranges")
    features.save_ranges(rows, folder)
    out = features.scaled(rows, features.load_ranges(spark, folder)).drop(*TARGETS)
    return rounded(out, *FEATURES)


@query
def serving_features(spark, sf_dir):
    """Yesterday's sentiment and today's open of the known symbols."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    bars = _bars(spark, sf_dir)
    rows = features.serving_rows(distinct_keys(bars, "symbol"), sentiment, bars, RUN_DATE)
    return rounded(rows, *BULLISH)


@query
def symbol_day(spark, sf_dir):
    """The daily sentiment of one symbol on one day."""
    sentiment = daily.daily_sentiment(fixtures.classified_articles(spark, sf_dir))
    return rounded(on_day(sentiment, "src15", dt.date(2024, 1, 16)), *BULLISH)


@query
def open_high_regression(spark, sf_dir):
    """Least-squares lines of the targets on the opening price."""
    out = forecast.open_lines(features.features_and_targets(_matched(spark, sf_dir)))
    return rounded(out, *out.columns, digits=4)


def _stored_rows(spark, sf_dir, name):
    """Training rows, written once because every model pass reads them."""
    folder = work_folder(spark, name)
    rows = features.features_and_targets(_matched(spark, sf_dir))
    rows.write.parquet(f"{folder}/rows")
    return folder, spark.read.schema(rows.schema).parquet(f"{folder}/rows")


@query
def forecast_linear(spark, sf_dir):
    """The default model, fitted and applied to its training days."""
    folder, rows = _stored_rows(spark, sf_dir, "linear")
    least_squares.train(rows, folder)
    return rounded(least_squares.score(rows, folder), *TARGETS, digits=4)


@query
def forecast_incremental(spark, sf_dir):
    """The default model from sums per day, of two runs: the second replaces a day that was incomplete."""
    folder, rows = _stored_rows(spark, sf_dir, "incremental")
    early = (F.col("pub_date") < F.lit(RUN_DATE)) | ((F.col("pub_date") == F.lit(RUN_DATE)) & (F.col("symbol") < "src5"))
    increments.update(rows.where(early), f"{folder}/sums", "1")
    increments.update(rows.where(F.col("pub_date") >= F.lit(RUN_DATE)), f"{folder}/sums", "2")
    increments.train(read_table(spark, f"{folder}/sums", schemas.DAY_SUMS), folder)
    return rounded(least_squares.score(rows, folder), *TARGETS, digits=4)


@query
def day_sums(spark, sf_dir):
    """What a fit needs of each day: rows, range of the opening price, its sum of products with the close."""
    _, rows = _stored_rows(spark, sf_dir, "sums")
    column = {name: i for i, name in enumerate(FEATURES)}["open"]
    place = len(increments.PAIRS) + (column + 1) * len(TARGETS) + TARGETS.index("close")
    out = increments.day_sums(rows).select(
        "pub_date", "n", F.col("lows")[column].alias("low"), F.col("highs")[column].alias("high"),
        F.col("sums")[place].alias("open_close"),
    )
    return rounded(out, "open_close", digits=4)


@query
def forecast_gbt(spark, sf_dir):
    """Boosted trees of Spark ML, fitted, stored, loaded and applied: what must hold of any such fit.

    Per target the days forecast, and whether the squared error is below that of the mean.
    """
    folder, rows = _stored_rows(spark, sf_dir, "trees")
    forecast.train(rows, folder, regressor=lambda t: forecast.boosted_trees(t, rounds=5))
    guesses = [F.col(t).alias(f"guess_{t}") for t in TARGETS]
    both = forecast.score(rows, folder).select("symbol", "pub_date", *guesses).join(rows, ["symbol", "pub_date"])
    facts = [
        F.struct(
            F.lit(t).alias("target"),
            F.count(f"guess_{t}").alias("days"),
            (F.avg(F.pow(F.col(f"guess_{t}") - F.col(t), 2)) < F.var_pop(t)).alias("better"),
        )
        for t in TARGETS
    ]
    return both.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


@query
def gated_scores(spark, sf_dir):
    """The gated cell applied to matched days, with parameters made by a rule of their position."""
    folder, rows = _stored_rows(spark, sf_dir, "gated")
    features.save_ranges(rows, f"{folder}/ranges")
    parameters = [(n * 37 % 101 - 50) / 100 for n in range(gated_cell.N_PARAMETERS)]
    gated_cell.save_parameters(spark, np.array(parameters), f"{folder}/parameters")
    return rounded(gated_cell.score(rows, folder), *TARGETS)


@query
def prediction_points(spark, sf_dir):
    """The default model's forecasts as time-series points."""
    forecasts = forecast_linear(spark, sf_dir)
    return points.prediction_points(forecasts.withColumn("target_date", F.date_add("pub_date", 1)))


# --- news ingest ------------------------------------------------------------------------


@query
def article_guid(spark, sf_dir):
    """Identities and how many articles share each."""
    return fixtures.articles(spark, sf_dir).groupBy("guid").agg(F.count(F.lit(1)).alias("n"))


@query
def distinct_articles(spark, sf_dir):
    """Articles per symbol, copies of an identity counted once."""
    once = news.first_copies(fixtures.articles(spark, sf_dir), "doc_id", "guid")
    return once.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("doc_ids"))


@query
def unseen_articles(spark, sf_dir):
    """Articles a store holding the labelled ones has not seen, each once."""
    every = fixtures.articles(spark, sf_dir)
    store = known(every, fixtures.table(spark, sf_dir, "labels"), "doc_id")
    fresh = news.unseen(every, store, "doc_id")
    return fresh.select("guid", "symbol", "pub_date", F.length("title").alias("title_length"))


@query
def stored_articles(spark, sf_dir):
    """Six identities looked up in a store: those of the first and last document of three sources, changed or not."""
    folder = work_folder(spark, "articles")
    every = news.first_copies(fixtures.articles(spark, sf_dir), "doc_id", "guid").select("guid", "symbol", "doc_id", "pub_date")
    tables.append(every, folder, "pub_date", cluster=["symbol"], identities=["guid"])
    stored = read_table(spark, folder, "guid string, symbol string, doc_id bigint, pub_date date")
    ends = stored.where(F.col("symbol").isin("src1", "src7", "src19")).groupBy("symbol").agg(
        F.min_by("guid", "doc_id").alias("first"), F.max_by("guid", "doc_id").alias("last")
    )
    asked = [g for row in ends.collect() for g in (row["first"], row["last"].replace("0", "f"))]
    return tables.with_identity(stored, "guid", asked)


@query
def open_news(spark, sf_dir):
    """Articles of closed days that are not in the ledger of processed ones."""
    every = fixtures.articles(spark, sf_dir).select("doc_id", "guid", "symbol", "pub_date")
    processed = known(every, fixtures.table(spark, sf_dir, "labels"), "doc_id")
    return news.open_news(every, processed, F.lit(RUN_DATE))


@query
def open_days(spark, sf_dir):
    """Closed days with articles that are not processed: a run goes on only if there are any."""
    once = news.first_copies(fixtures.articles(spark, sf_dir), "doc_id", "guid").select("doc_id", "guid", "pub_date")
    processed = known(once, fixtures.table(spark, sf_dir, "labels"), "doc_id")
    return news.open_days(once, processed, F.lit(RUN_DATE))


@query
def top_n_news(spark, sf_dir):
    """The three newest articles of every symbol."""
    out = news.newest_per_symbol(fixtures.articles(spark, sf_dir), 3, "doc_id")
    return out.select("symbol", "rank", "doc_id", "pub_date")


def _news_documents(spark, sf_dir):
    """Articles nested by symbol; the labelled ones are done, the others are new."""
    labelled = fixtures.table(spark, sf_dir, "labels").select("doc_id", F.lit(0).alias("done"))
    # copies share an identity and so would share a document, however many there are
    once = news.first_copies(fixtures.articles(spark, sf_dir), "doc_id", "guid")
    articles = once.join(labelled, "doc_id", "left")
    return nesting.nested(
        articles,
        ["symbol"],
        nesting.news_item(F.col("done").isNull()),
        nesting.guid_spread(F.col("guid")),
        "listOfNews",
        aim=20,
    )


@query
def nested_news(spark, sf_dir):
    """Nested documents of bounded size, with what is still open in each."""
    still_open = nesting.open_items(F.col("listOfNews"), F.lit(RUN_DATE))
    return _news_documents(spark, sf_dir).select(
        "symbol",
        "part",
        F.size("listOfNews").cast("bigint").alias("articles"),
        F.size(still_open).cast("bigint").alias("open_articles"),
        F.get("listOfNews", F.lit(0))["guid"].alias("first_guid"),
    )


@query
def flattened_news(spark, sf_dir):
    """Nested documents flattened to rows again: none is lost."""
    flat = nesting.flattened(_news_documents(spark, sf_dir))
    return flat.select("guid", "symbol", "pub_date", F.length("text").alias("text_length"))


@query
def unflagged_sources(spark, sf_dir):
    """Labelled sources without a flagged article."""
    documents = fixtures.table(spark, sf_dir, "documents")
    labelled = known(documents, fixtures.table(spark, sf_dir, "labels"), "doc_id")
    toxic = fixtures.table(spark, sf_dir, "labels").where("toxic = 1")
    flagged = known(documents, toxic, "doc_id")
    return unknown(distinct_keys(labelled, "source"), flagged, "source")


def _news_messages(spark, sf_dir):
    """Pages as feed messages: some without a click-through address, some with a bad date."""
    pages = fixtures.table(spark, sf_dir, "pages")
    n = F.col("page_id")
    secure = F.col("url").startswith("https")
    stamp = F.date_format(fixtures.published(n), "yyyy-MM-dd'T'09:30:00'Z'")
    content = F.struct(
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.when(F.col("url").contains("#top"), "yesterday").otherwise(stamp).alias("pubDate"),
        F.struct(F.when(secure, F.col("url")).otherwise("").alias("url")).alias("clickThroughUrl"),
        F.when(F.col("url").contains("ref="), F.lit(None)).otherwise(F.col("url")).alias("previewUrl"),
    )
    messages = pages.select(
        fixtures.tick_symbol(n).alias("symbol"), F.struct(content.alias("content")).alias("entry"), n.alias("n")
    )
    stream = nesting.nested(messages, ["symbol"], F.col("entry"), F.col("n"), "stream", aim=100)
    document = F.struct(F.struct(F.struct("stream").alias("main")).alias("data"))
    return stream.select("symbol", F.to_json(document).alias("message"))


@query
def news_feed_rows(spark, sf_dir):
    """News feed messages parsed to articles, unreadable dates named as such."""
    return landing.news_entries(_news_messages(spark, sf_dir))


@query
def news_feed_articles(spark, sf_dir):
    """Feed messages joined with the fetched pages: the rows the news store gets."""
    entries = landing.news_entries(_news_messages(spark, sf_dir))
    pages = spread(fixtures.table(spark, sf_dir, "pages"))
    once = news.one_address(landing.candidates(entries), pages)
    rows = landing.with_article_text(once, pages, "article", None)
    return rows.select("guid", "symbol", "pub_date", F.length("text").alias("text_length"))


@query
def news_feed_rejects(spark, sf_dir):
    entries = landing.news_entries(_news_messages(spark, sf_dir))
    return landing.rejects(entries).groupBy("symbol", "problem").agg(F.count(F.lit(1)).alias("n"))


@query
def chosen_url(spark, sf_dir):
    """Click-through address or else preview address."""
    url = F.col("url")
    click = F.when(url.startswith("https"), url).otherwise("")
    preview = F.when(url.contains("ref="), F.lit(None)).otherwise(url)
    return fixtures.table(spark, sf_dir, "pages").select("page_id", article_url(click, preview).alias("chosen"))


@query
def page_text(spark, sf_dir):
    """Article text of every page, identified by its hash."""
    text = article_text(F.col("html"), "article", None)
    return (
        spread(fixtures.table(spark, sf_dir, "pages"))
        .select("page_id", text.alias("text"))
        .select("page_id", F.length("text").alias("characters"), F.md5("text").alias("digest"))
    )


# --- text and sentiment -------------------------------------------------------------------


def _documents(spark, sf_dir):
    return spread(fixtures.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def abbreviations(spark, sf_dir):
    """Types that are followed by a period as only abbreviations are, learned from all documents."""
    return rounded(sentence_steps.abbreviations(fixtures.table(spark, sf_dir, "documents")), "score")


@query
def sentences(spark, sf_dir):
    """Sentences of every document, without breaks at the learned abbreviations."""
    folder = work_folder(spark, "abbreviations")
    sentence_steps.save_abbreviations(sentence_steps.abbreviations(fixtures.table(spark, sf_dir, "documents")), folder)
    known = sentence_steps.load_abbreviations(spark, folder)
    own = sentence_steps.sentences(F.col("text"), known)
    return (
        _documents(spark, sf_dir)
        .select("doc_id", own.alias("own"))
        .select("doc_id", F.size("own").alias("n_sentences"), F.md5(F.array_join("own", "\n")).alias("digest"))
    )


@query
def tokens(spark, sf_dir):
    """Content words of every document with their counts."""
    return texts.term_rows(texts.with_terms(texts.with_tokens(_documents(spark, sf_dir))))


@query
def stems(spark, sf_dir):
    """Distinct content words and their stems."""
    every = texts.distinct_tokens(texts.with_tokens(_documents(spark, sf_dir)))
    return every.withColumn("stem", stem(F.col("token")))


@query
def cleaned_text(spark, sf_dir):
    """Documents cleaned and stemmed, identified by their hash."""
    out = texts.cleaned_text(texts.with_stems(_documents(spark, sf_dir)))
    return out.select("doc_id", F.length("cleaned").alias("characters"), F.md5("cleaned").alias("digest"))


def _written(frame, name):
    """A table read several times, written once."""
    spark, folder = frame.sparkSession, work_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


@query
def spell(spark, sf_dir):
    """Stems that are no dictionary word and what they are corrected to."""
    stemmed = _written(texts.with_stems(_documents(spark, sf_dir)), "stems")
    return spelling.corrections(texts.distinct_tokens(stemmed), _known_words(spark, sf_dir, stemmed))


def _known_words(spark, sf_dir, stemmed):
    least = fixtures.table(spark, sf_dir, "documents").count() / KNOWN_WORD_DOCUMENTS
    return _written(spelling.dictionary(stemmed, least), "dictionary")


@query
def corrected_text(spark, sf_dir):
    """Documents cleaned, stemmed and corrected."""
    stemmed = _written(texts.with_stems(_documents(spark, sf_dir)), "stems")
    words = _known_words(spark, sf_dir, stemmed)
    out = texts.corrected_stems(stemmed, words, work_folder(spark, "corrected"))
    return texts.cleaned_text(out).select(
        "doc_id", F.length("cleaned").alias("characters"), F.md5("cleaned").alias("digest")
    )


def _terms(spark, sf_dir):
    """Terms of all documents with symbol and day, written once: the model and its use read them."""
    articles = spread(fixtures.articles(spark, sf_dir).select("doc_id", "symbol", "pub_date", "text"))
    return _written(texts.with_terms(texts.with_stems(articles)), "terms")


def _labelled(spark, sf_dir, docs):
    return docs.join(fixtures.true_sentiment(spark, sf_dir), "doc_id")


def _sentiment_model(spark, labelled_terms):
    folder = work_folder(spark, "sentiment")
    naive_bayes.train(labelled_terms, folder)
    return naive_bayes.load(spark, folder)


@query
def nb_model(spark, sf_dir):
    """Token log-likelihoods of both classes, from the labelled documents."""
    labelled = _labelled(spark, sf_dir, _documents(spark, sf_dir))
    model = _sentiment_model(spark, texts.with_terms(texts.with_stems(labelled)))
    return rounded(model.token_logs(), "pos_log", "neg_log")


@query
def bag_of_words(spark, sf_dir):
    """Term counts of all documents within the model's vocabulary."""
    docs = _terms(spark, sf_dir)
    return texts.bag_of_words(docs, _sentiment_model(spark, _labelled(spark, sf_dir, docs)).tokens).select("doc_id", "token", "n")


@query
def nb_predict(spark, sf_dir):
    """Sentiment of every document by the stored model."""
    docs = _terms(spark, sf_dir)
    scored = naive_bayes.score(docs, _sentiment_model(spark, _labelled(spark, sf_dir, docs)), "doc_id")
    return rounded(scored, "margin", digits=4)


@query
def predicted_daily_sentiment(spark, sf_dir):
    """From texts to daily sentiment: clean, classify, count."""
    docs = _terms(spark, sf_dir)
    scored = naive_bayes.score(docs, _sentiment_model(spark, _labelled(spark, sf_dir, docs)), "doc_id", "symbol", "pub_date")
    return rounded(daily.daily_sentiment(scored), *BULLISH)


# --- ticks --------------------------------------------------------------------------------


@query
def event_json(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return fixtures.table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


def _tick_messages(spark, sf_dir):
    """Ticks as messages with a list of trades, one per symbol and hour."""
    trade = F.struct(F.col("seq"), _trade().alias("trade"))
    ordered = F.transform(F.array_sort(F.collect_list(trade)), lambda x: x["trade"])
    return (
        fixtures.ticks(spark, sf_dir)
        .groupBy("symbol", F.date_trunc("hour", "ts").alias("hour"), F.floor(F.col("seq") / 1000).alias("slice"))
        .agg(F.min("seq").alias("offset"), F.to_json(ordered).alias("value"))
        .select("offset", "value")
    )


@query
def trades_explode(spark, sf_dir):
    """Trade messages parsed to one row per trade."""
    entries = tick_stream.trade_entries(_tick_messages(spark, sf_dir))
    return tick_stream.trade_rows(entries).select(
        "symbol", F.unix_millis("ts").alias("t"), "price", "volume"
    )


def _trade():
    """A tick in the form of a message's trade."""
    return F.struct(
        F.col("symbol").alias("s"),
        F.col("price").alias("p"),
        F.unix_millis("ts").alias("t"),
        F.col("volume").alias("v"),
    )


@query
def republished_messages(spark, sf_dir):
    """Envelopes with data reduced to their trades; those of errors carry none and are dropped."""
    ticks = fixtures.tick_rows(fixtures.table(spark, sf_dir, "events"), "event_type")
    data = F.when(F.col("event_type") != "error", F.array(_trade()))
    envelope = F.to_json(F.struct(data.alias("data"), F.col("event_type").alias("type")))
    out = tick_stream.republished(ticks.select(F.col("seq").alias("offset"), envelope.alias("value")))
    return out.select("offset", F.inline(F.from_json("value", TRADE_LIST_DDL)))


@query
def envelope_rejects(spark, sf_dir):
    """Envelopes that give no trades: those of errors have no data, every fiftieth is cut off."""
    ticks = fixtures.tick_rows(fixtures.table(spark, sf_dir, "events"), "event_type")
    data = F.when(F.col("event_type") != "error", F.array(_trade()))
    envelope = F.to_json(F.struct(data.alias("data"), F.col("event_type").alias("type")))
    cut = F.when(F.col("seq") % 50 == 0, F.substring(envelope, 1, 12)).otherwise(envelope)
    rejects = tick_stream.envelope_rejects(ticks.select(F.col("seq").alias("offset"), cut.alias("value")))
    return rejects.select(F.col("seq.offset").alias("offset"), "problem")


@query
def last_writes(spark, sf_dir):
    """One trade per symbol and hour-long key: the one written last."""
    hourly = fixtures.ticks(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    out = tick_stream.last_writes(hourly)
    return out.select("symbol", F.unix_millis("ts").alias("t"), "price", "volume", "seq")


@query
def committed_points(spark, sf_dir):
    """Ticks as points through the sink that commits, a batch written twice, and read again."""
    folder = work_folder(spark, "committed")
    every = fixtures.ticks(spark, sf_dir)
    committed.write_lines(points.trade_points(every.where("seq % 2 = 0")), folder, "even")
    for _ in range(2):
        committed.write_lines(points.trade_points(every.where("seq % 2 = 1")), folder, "odd")
    return committed.read_lines(spark, folder)


@query
def trade_points(spark, sf_dir):
    return points.trade_points(fixtures.ticks(spark, sf_dir))


def _streamed_trades(spark, sf_dir):
    """The trades table the ticks make when they are streamed through the trade sink."""
    folder = work_folder(spark, "trades")
    schema = fixtures.table(spark, sf_dir, "events").schema
    events = table_rows(spark, sf_dir, schema, "events.parquet")
    messages = fixtures.tick_rows(events).select(
        F.col("seq").alias("offset"), F.to_json(F.array(_trade())).alias("value")
    )
    tick_stream.write_trades(
        messages, f"{folder}/trades", f"{folder}/rejects", f"{folder}/checkpoint"
    ).awaitTermination()
    return folder, read_table(spark, f"{folder}/trades", schemas.TRADES)


@query
def stream_trades(spark, sf_dir):
    """The ticks table streamed through the trade sink."""
    _, written = _streamed_trades(spark, sf_dir)
    return tick_stream.last_writes(written).select("symbol", F.unix_millis("ts").alias("t"), "price", "volume")


@query
def settled_trades(spark, sf_dir):
    """Streamed trades that are final, each key written once as it leaves the state."""
    folder = work_folder(spark, "settled")
    schema = fixtures.table(spark, sf_dir, "events").schema
    ticks = fixtures.tick_rows(table_rows(spark, sf_dir, schema, "events.parquet"))
    messages = ticks.select(F.col("seq").alias("offset"), F.to_json(F.array(_trade())).alias("value"))
    tick_stream.settle_trades(messages, f"{folder}/trades", f"{folder}/checkpoint", TRADE_DELAY).awaitTermination()
    written = read_table(spark, f"{folder}/trades", schemas.TRADES)
    return written.select("symbol", F.unix_millis("ts").alias("t"), "price", "volume")


@query
def stream_bars(spark, sf_dir):
    """Bars of event-time windows from ticks arriving as a stream."""
    folder = work_folder(spark, "window-bars")
    schema = fixtures.table(spark, sf_dir, "events").schema
    ticks = fixtures.tick_rows(table_rows(spark, sf_dir, schema, "events.parquet"))
    bar_stream.write_window_bars(
        ticks, f"{folder}/bars", f"{folder}/checkpoint", BAR_WINDOW, TRADE_DELAY
    ).awaitTermination()
    written = read_table(spark, f"{folder}/bars", schemas.WINDOW_BARS)
    bars = bar_stream.current_bars(written).withColumn("t", F.unix_millis("start")).drop("start")
    return rounded(bars, "volume")


@query
def compacted_trades(spark, sf_dir):
    """Streamed trades gathered into one table of days."""
    folder, written = _streamed_trades(spark, sf_dir)
    tick_stream.compact(written, f"{folder}/days")
    days = read_table(spark, f"{folder}/days", schemas.TRADE_DAYS)
    return days.select("symbol", F.unix_millis("ts").alias("t"), "price", "volume")


@query
def stream_daily_sentiment(spark, sf_dir):
    """Daily sentiment from documents arriving as a stream."""
    folder = work_folder(spark, "daily")
    schema = fixtures.table(spark, sf_dir, "documents").schema
    arriving = table_rows(spark, sf_dir, schema, "documents.parquet").select(
        "doc_id", F.col("source").alias("symbol"), fixtures.published(F.col("doc_id")).alias("pub_date")
    )
    truth = fixtures.true_sentiment(spark, sf_dir)
    label = F.when(F.col("positive"), "positive").otherwise("negative")

    def classify(batch):
        return batch.join(truth, "doc_id").withColumn("sentiment", label)

    write_daily_counts(arriving, classify, f"{folder}/counts", f"{folder}/checkpoint").awaitTermination()
    counts = read_table(spark, f"{folder}/counts", schemas.DAILY_COUNTS)
    return rounded(daily.with_indicators(daily.merged_counts(counts)), *BULLISH)

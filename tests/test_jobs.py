import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newstide.operators import naive_bayes, texts
from newstide.plans import jobs
from newstide.plans.jobs import Store

SYMBOLS = ["A", "B"]


def day(n):
    return dt.date(2024, 4, 1) + dt.timedelta(days=n)


def news_message(symbol, items):
    stream = [
        {"content": {"title": t, "pubDate": f"{d}T08:00:00Z", "clickThroughUrl": {"url": f"{symbol}/{t}"}}} for t, d in items
    ]
    return (symbol, json.dumps({"data": {"main": {"stream": stream}}}))


def page(symbol, title, text):
    return (f"{symbol}/{title}", f'<div class="caas-body"><p>{text}</p></div>')


def prices_message(symbol, days):
    record = lambda n: {
        "date": (day(n) - dt.date(1970, 1, 1)).days * 86400, "open": 10.0 + n, "high": 12.0 + n, "low": 9.0 + n, "close": 11.0 + n, "volume": 100.0,
    }
    return (symbol, json.dumps({"prices": [record(n) for n in days]}))


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    rows = [(True, ["gain", "rise"]), (False, ["loss", "fall"])]
    naive_bayes.train(texts.with_terms(spark.createDataFrame(rows, "positive boolean, tokens array<string>")), path)
    return naive_bayes.load(spark, path)


def ingest(spark, store, batch, items):
    """``items``: symbol, title, day, text."""
    messages = [news_message(s, [(t, d) for s2, t, d, _ in items if s2 == s]) for s in SYMBOLS]
    pages = [page(s, t, x) for s, t, _, x in items]
    return jobs.ingest_news(
        spark, store, spark.createDataFrame(messages, "symbol string, message string"),
        spark.createDataFrame(pages, "url string, html string"), batch,
    )


def symbols(spark):
    return spark.createDataFrame([(s,) for s in SYMBOLS], "symbol string")


FIRST = [("A", "a1", day(0), "gains rise"), ("A", "a2", day(0), "loss"), ("B", "b1", day(0), "fall"), ("B", "b2", day(2), "rise")]


def snapshot(spark, store):
    daily = jobs.daily_sentiment(spark, store)
    return sorted((r.symbol, r.pub_date, r.pos_n, r.neg_n) for r in daily.collect())


def test_ingest_is_idempotent(spark, tmp_path):
    store = Store(str(tmp_path))
    assert ingest(spark, store, "1", FIRST) == 4
    assert ingest(spark, store, "1", FIRST) == 0
    assert ingest(spark, store, "2", [*FIRST, ("A", "a3", day(0), "late gain")]) == 1
    frame = spark.createDataFrame([prices_message("A", [0, 1])], "symbol string, message string")
    assert jobs.ingest_prices(spark, store, frame, "1") == 2
    more = spark.createDataFrame([prices_message("A", [1, 2]), prices_message("B", [0, 1])], "symbol string, message string")
    assert jobs.ingest_prices(spark, store, more, "2") == 3
    assert store.read(spark, "prices").count() == 5


def test_a_bar_without_prices_does_not_block_the_real_one(spark, tmp_path):
    store = Store(str(tmp_path))
    symbol, text = prices_message("A", [0])
    for batch, message in enumerate([text.replace("10.0", "null", 1), text]):
        frame = spark.createDataFrame([(symbol, message)], "symbol string, message string")
        assert jobs.ingest_prices(spark, store, frame, str(batch)) == batch
    assert [r.open for r in store.read(spark, "prices").collect()] == [10.0]
    assert [r.problem for r in spark.read.parquet(store.path("price_rejects")).collect()] == ["no open"]


def test_days_run_in_order_and_again(spark, tmp_path, model):
    store = Store(str(tmp_path))
    ingest(spark, store, "1", FIRST)
    frame = spark.createDataFrame([prices_message(s, [0, 1, 2, 3]) for s in SYMBOLS], "symbol string, message string")
    jobs.ingest_prices(spark, store, frame, "1")

    assert jobs.run_day(spark, store, day(1), symbols(spark), model)
    # the article of a day that is not over waits
    assert snapshot(spark, store) == [("A", day(0), 1, 1), ("B", day(0), 0, 1)]
    dataset = spark.read.option("header", True).csv(store.path(f"datasets/run_date={day(1)}"))
    assert sorted((r["_pubDate"], r.symbol, float(r.open)) for r in dataset.collect()) == [
        (str(day(0)), "A", 11.0), (str(day(0)), "B", 11.0),
    ]
    lines = [r.value for r in spark.read.text(store.path(f"points/run_date={day(1)}")).collect()]
    assert len(lines) == 2 and all(x.startswith("stock_predictions,symbol=") and f"date={day(1)}" in x for x in lines)

    # a repeated run finds its own work again and changes nothing
    before = snapshot(spark, store)
    assert jobs.run_day(spark, store, day(1), symbols(spark), model)
    assert snapshot(spark, store) == before
    assert store.read(spark, "processed_news").count() == 3

    # a late article is counted with its day, which is matched again
    ingest(spark, store, "2", [("A", "a4", day(0), "gain gain")])
    assert jobs.run_day(spark, store, day(2), symbols(spark), model)
    assert snapshot(spark, store)[0] == ("A", day(0), 2, 1)
    late = spark.read.option("header", True).csv(store.path(f"datasets/run_date={day(2)}"))
    assert [r.symbol for r in late.collect()] == ["A"]
    # the day is trained on once, with its newest figures; an earlier run sees the earlier ones
    rows = {(r.symbol, r.pub_date): r.bullish_indicator for r in jobs.training_rows(spark, store, day(2)).collect()}
    assert len(rows) == jobs.training_rows(spark, store, day(2)).count() == 2
    assert rows["A", day(0)] == pytest.approx(1 / 3)
    early = {(r.symbol, r.pub_date): r.bullish_indicator for r in jobs.training_rows(spark, store, day(1)).collect()}
    assert early == {("A", day(0)): 0.0, ("B", day(0)): -1.0}
    # each run has a model of its own, and the files of the first were archived by the second
    assert jobs.last_model(spark, store, day(1)).endswith(f"run_date={day(1)}")
    assert jobs.last_model(spark, store, day(2)).endswith(f"run_date={day(2)}")
    assert jobs.last_model(spark, store, day(1), own=False) is None
    taken = store.read(spark, "training_rows").count()
    jobs.take_in_datasets(spark, store)
    assert store.read(spark, "training_rows").count() == taken
    assert any((tmp_path / "archive").rglob("*.csv"))

    # the article that waited
    assert jobs.run_day(spark, store, day(3), symbols(spark), model)
    assert ("B", day(2), 1, 0) in snapshot(spark, store)
    # no articles: later steps do not run
    assert not jobs.run_day(spark, store, day(4), symbols(spark), model)
    assert store.read(spark, "processed_news").agg(F.countDistinct("guid")).first()[0] == 5


def test_spelling_is_part_of_the_run_when_a_dictionary_is_given(spark, tmp_path, model):
    store = Store(str(tmp_path))
    ingest(spark, store, "1", [("A", "a1", day(0), "lss and fll")])
    words = spark.createDataFrame([("loss", 3), ("fall", 2)], "word string, freq bigint")
    assert jobs.classify_open_news(spark, store, day(1), model, words)
    assert snapshot(spark, store) == [("A", day(0), 0, 1)]

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from newstide.functions.identity import article_guid, article_url
from newstide.operators import daily, features, matching, nesting, news, prices

DAY = dt.date(2024, 4, 30)


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.mark.parametrize(
    "pos, neg, bullish, all_posts, agreement, label",
    [
        (11, 3, 0.5714285714285714, 1.5474572577726913, 0.17934819335171015, "positive"),
        (4, 4, 0.0, 0.0, 0.0, "neutral"),
        (0, 1, -1.0, -0.6931471805599453, 1.0, "negative"),
        (2, 0, 1.0, 1.0986122886681098, 1.0, "positive"),
        (0, 0, 0.0, 0.0, 0.0, "neutral"),
    ],
)
def test_known_indicators(spark, pos, neg, bullish, all_posts, agreement, label):
    counts = spark.createDataFrame([(pos, neg)], "pos_n bigint, neg_n bigint")
    row = daily.with_indicators(counts).first()
    assert row.sentiment == label
    assert row.bullish_indicator == pytest.approx(bullish, abs=1e-15)
    assert row.bullish_indicator_all_posts == pytest.approx(all_posts, abs=1e-15)
    assert row.agreement_indicator == pytest.approx(agreement, abs=1e-15)


def random_articles(spark, n=400):
    rng = random.Random(3)
    # a third of all articles are of one symbol
    rows = [
        (i, rng.choice(["HOT", f"S{i % 7}", f"S{i % 5}"]), day(rng.randint(0, 4)), rng.choice(["positive", "negative"]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id int, symbol string, pub_date date, sentiment string")


def test_any_split_merges_to_the_whole(spark):
    articles = random_articles(spark)
    whole = daily.daily_counts(articles)
    parts = [daily.daily_counts(articles.where(F.col("id") % 3 == r)) for r in range(3)]
    merged = daily.merged_counts(*parts)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    bounds = daily.with_indicators(whole).agg(
        F.max(F.abs("bullish_indicator")), F.min("agreement_indicator"), F.max("agreement_indicator")
    ).first()
    assert bounds[0] <= 1 and bounds[1] >= 0 and bounds[2] <= 1


def bars_frame(spark, rows):
    return spark.createDataFrame(
        [(s, d, o, o + 2, o - 2, o + 1, 100.0) for s, d, o in rows],
        "symbol string, bar_date date, open double, high double, low double, close double, volume double",
    )


def test_matches_the_next_day_only(spark):
    counts = spark.createDataFrame(
        [("A", day(0), 1, 0), ("A", day(3), 0, 1), ("B", day(0), 1, 1)],
        "symbol string, pub_date date, pos_n bigint, neg_n bigint",
    )
    sentiment = daily.with_indicators(counts)
    bars = bars_frame(spark, [("A", day(0), 9.0), ("A", day(1), 10.0), ("B", day(2), 7.0), ("A", day(5), 8.0)])
    out = matching.next_day_dataset(sentiment, bars).collect()
    assert [(r.symbol, r.pub_date, r.open) for r in out] == [("A", day(0), 10.0)]


def test_a_day_with_new_articles_is_unmatched_again(spark):
    counts = spark.createDataFrame(
        [("A", day(0), 2, 0), ("B", day(0), 1, 0)], "symbol string, pub_date date, pos_n bigint, neg_n bigint"
    )
    ledger = spark.createDataFrame(
        [("A", day(0), 1), ("B", day(0), 1)], "symbol string, pub_date date, articles bigint"
    )
    assert [r.symbol for r in matching.unmatched(daily.with_indicators(counts), ledger).collect()] == ["A"]


def test_new_bars_look_at_symbol_and_day(spark):
    stored = bars_frame(spark, [("OLD", day(0), 1.0), ("OLD", day(1), 2.0)])
    arrived = bars_frame(spark, [("OLD", day(0), 1.0), ("NEW", day(0), 5.0), ("NEW", day(1), 6.0), ("NEW", day(1), 6.0)])
    out = prices.new_bars(arrived, stored).collect()
    assert sorted((r.symbol, r.bar_date) for r in out) == [("NEW", day(0)), ("NEW", day(1))]


def test_daily_bars_and_latest_open(spark):
    at = dt.datetime(2024, 4, 30, 10)
    ticks = spark.createDataFrame(
        [("A", at, 5.0, 1.0, 2), ("A", at, 4.0, 1.0, 1), ("A", at, 9.0, None, 3), ("A", at + dt.timedelta(days=1), 7.0, 2.0, 4)],
        "symbol string, ts timestamp, price double, volume double, seq bigint",
    )
    bars = prices.daily_bars(ticks)
    first = bars.where(F.col("bar_date") == F.lit(DAY)).first()
    assert (first.open, first.high, first.low, first.close, first.volume) == (4.0, 9.0, 4.0, 9.0, 2.0)
    assert prices.latest_open(bars).first().open == 7.0


def test_guid_matches_sha256_of_the_parts(spark):
    import hashlib

    frame = spark.createDataFrame([("T", "A", DAY), (None, "A", DAY)], "t string, s string, d date")
    got = [r[0] for r in frame.select(article_guid(F.col("t"), F.col("s"), F.col("d"))).collect()]
    assert got == [hashlib.sha256(x.encode()).hexdigest() for x in ("T|A|2024-04-30", "None|A|2024-04-30")]


def test_url_choice(spark):
    frame = spark.createDataFrame([("c", "p"), ("", "p"), (None, "p"), ("", ""), (None, None)], "c string, p string")
    got = [r[0] for r in frame.select(article_url(F.col("c"), F.col("p"))).collect()]
    assert got == ["c", "p", "p", None, None]


NEWS = "guid string, symbol string, pub_date date, title string, text string"


def test_unseen_is_distinct_in_the_batch_too(spark):
    batch = spark.createDataFrame(
        [(3, "a", "S", DAY, "t", "x"), (4, "a", "S", DAY, "t", "y"), (1, "b", "S", DAY, "t", ""), (2, "c", "S", DAY, "t", "z")],
        "n int, " + NEWS,
    )
    store = spark.createDataFrame([("c", "S", DAY, "t", "z")], NEWS)
    assert sorted((r.guid, r.text) for r in news.unseen(batch, store, "n").collect()) == [("a", "x"), ("b", "")]


def test_open_news_leaves_today_and_processed(spark):
    rows = [("a", "S", day(-1), "t", "x"), ("b", "S", day(0), "t", "x"), ("c", "S", day(-1), "t", "x")]
    ledger = spark.createDataFrame([("c", day(-1))], "guid string, pub_date date")
    out = news.open_news(spark.createDataFrame(rows, NEWS), ledger, F.lit(DAY)).collect()
    assert [r.guid for r in out] == ["a"]


def test_open_days_have_more_articles_than_processed(spark):
    rows = [("a", "S", day(-1), "t", "x"), ("b", "S", day(-2), "t", "x"), ("c", "S", day(-2), "t", "x"), ("d", "S", day(0), "t", "x")]
    ledger = spark.createDataFrame([("a", day(-1)), ("b", day(-2))], "guid string, pub_date date")
    out = news.open_days(spark.createDataFrame(rows, NEWS), ledger, F.lit(DAY)).collect()
    assert [r.pub_date for r in out] == [day(-2)]


def test_newest_per_symbol_limits_before_the_shuffle(spark):
    rows = [(f"{i:03d}", "HOT", day(i % 3), "t", "x") for i in range(50)] + [("z", "S", DAY, "t", "x")]
    out = news.newest_per_symbol(spark.createDataFrame(rows, NEWS), 2)
    assert sorted((r.symbol, r["rank"], r.guid) for r in out.collect()) == [
        ("HOT", 1, "002"), ("HOT", 2, "005"), ("S", 1, "z"),
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_nested_documents_are_bounded_and_complete(spark):
    rows = [(i, "HOT" if i % 3 else f"S{i % 4}") for i in range(900)]
    frame = spark.createDataFrame(rows, "n bigint, symbol string")
    out = nesting.nested(frame, ["symbol"], F.col("n"), F.col("n"), "items", aim=50).collect()
    assert sorted(n for r in out for n in r["items"]) == list(range(900))
    assert max(len(r["items"]) for r in out) <= 100 and len({r.symbol for r in out}) == 5


def test_open_items_of_nested_news(spark):
    item = lambda g, d, new: (g, d, "t", "A", "x", new)
    docs = spark.createDataFrame(
        [("A", [item("a", "2024-04-29", 1), item("b", "2024-04-30", 1), item("c", "2024-04-29", 0), item("d", "soon", 1)])],
        "symbol string, listOfNews array<struct<guid:string,_pubDate:string,_title:string,_symbol:string,_TextNew:string,is_new:int>>",
    )
    kept = docs.select(nesting.open_items(F.col("listOfNews"), F.lit(DAY)).alias("n")).first().n
    assert [n.guid for n in kept] == ["a"]
    assert {r.guid: r.pub_date for r in nesting.flattened(docs).collect()}["d"] is None


def test_scaling_uses_stored_ranges_and_constant_columns_are_zero(spark, tmp_path):
    schema = "symbol string, sentiment int, bullish_indicator double, bullish_indicator_all_posts double, agreement_indicator double, open double"
    train = spark.createDataFrame([("A", 1, 0.5, 1.0, 0.1, 10.0), ("A", 1, -0.5, 2.0, 0.3, 30.0)], schema)
    features.save_ranges(train, str(tmp_path / "r"))
    ranges = features.load_ranges(spark, str(tmp_path / "r"))
    single = spark.createDataFrame([("A", 1, 0.0, 1.5, 0.1, 15.0)], schema)
    row = features.scaled(single, ranges).first()
    assert (row.sentiment, row.bullish_indicator, row.bullish_indicator_all_posts, row.open) == (0.0, 0.5, 0.5, 0.25)
    assert math.isclose(row.agreement_indicator, 0.0)


def test_serving_rows_need_news_and_price(spark):
    counts = spark.createDataFrame(
        [("A", day(-1), 1, 1), ("B", day(-1), 1, 0), ("C", day(-1), 1, 0), ("A", day(-2), 1, 0)],
        "symbol string, pub_date date, pos_n bigint, neg_n bigint",
    )
    bars = bars_frame(spark, [("A", day(0), 3.0), ("A", day(-1), 2.0), ("C", day(0), 4.0)])
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    out = features.serving_rows(symbols, daily.with_indicators(counts), bars, DAY).collect()
    # a neutral day counts as 0, and the bar of the run's day is predicted
    assert [(r.symbol, r.target_date, r.sentiment, r.open) for r in out] == [("A", DAY, 0, 3.0)]

import datetime as dt

import pytest
from test_jobs import day, ingest, model, prices_message, symbols  # noqa: F401

from newstide.operators import features, matching
from newstide.plans import jobs
from newstide.plans.jobs import Store

FRIDAY = dt.date(2024, 1, 5)


def on(n):
    return FRIDAY + dt.timedelta(days=n)


def bars(spark, *days):
    rows = [(s, on(n), float(n), n + 1.0, n - 1.0, n + 0.5, 9.0) for s, n in days]
    return spark.createDataFrame(rows, "symbol string, bar_date date, open double, high double, low double, close double, volume double")


def news(spark, *days):
    rows = [(s, on(n), "positive", 1.0, float(n), 1.0) for s, n in days]
    return spark.createDataFrame(rows, "symbol string, pub_date date, " + ", ".join(
        f"{c} {'string' if c == 'sentiment' else 'double'}" for c in matching.INDICATORS))


def pairs(frame):
    return sorted((r.symbol, (r.pub_date - FRIDAY).days, (r.bar_date - FRIDAY).days) for r in frame.collect())


def test_friday_and_the_weekend_meet_monday(spark):
    given = news(spark, ("A", -1), ("A", 0), ("A", 1), ("A", 2), ("A", 3), ("B", 0), ("A", 4))
    found = matching.match_next_bar(given, bars(spark, ("A", -1), ("A", 0), ("A", 3), ("A", 4), ("B", 1)), 4)
    assert pairs(found) == [("A", -1, 0), ("A", 0, 3), ("A", 1, 3), ("A", 2, 3), ("A", 3, 4), ("B", 0, 1)]


def test_against_a_search_in_all_bars(spark):
    days = [("A", n) for n in (0, 1, 2, 6, 7, 13, 14, 30)] + [("B", n) for n in range(0, 30, 5)] + [("C", 9)]
    given = news(spark, *[(s, n) for s in "ABCD" for n in range(-6, 33)])
    for gap in (1, 3, 10):
        want = []
        for s in "ABC":
            own = sorted(n for t, n in days if t == s)
            want += [(s, n, b) for n in range(-6, 33) for b in [min((b for b in own if b > n), default=99)] if b - n <= gap]
        assert pairs(matching.match_next_bar(given, bars(spark, *days, *days), gap).distinct()) == sorted(want)


def test_a_gap_of_one_day_is_the_day_after(spark):
    given, stored = news(spark, *[("A", n) for n in range(9)]), bars(spark, ("A", 1), ("A", 2), ("A", 5), ("A", 6))
    one = matching.match_next_bar(given, stored, 1).select("symbol", "pub_date", "open").collect()
    assert sorted(one) == sorted(matching.match_next_day(given, stored).select("symbol", "pub_date", "open").collect())


def test_no_nested_loop_in_the_plan(spark):
    plan = matching.match_next_bar(news(spark, ("A", 0)), bars(spark, ("A", 3)), 4)._jdf.queryExecution().executedPlan()
    assert "NestedLoop" not in plan.toString() and "Cartesian" not in plan.toString()


def test_serving_takes_the_newest_day_since_the_bar_before(spark):
    stored = bars(spark, ("A", 0), ("A", 3), ("B", -9), ("B", 3), ("C", 3))
    given = news(spark, ("A", -1), ("A", 0), ("A", 2), ("B", -2), ("B", 1), ("C", -30), ("D", 2))
    known = spark.createDataFrame([(s,) for s in "ABCD"], "symbol string")
    rows = features.serving_rows_of_next_bar(known, given, stored, on(3), 4).collect()
    # the second indicator is the news day's number
    assert sorted((r.symbol, r.bullish_indicator_all_posts, r.open) for r in rows) == [("A", 2.0, 3.0), ("B", 1.0, 3.0)]
    assert all(r.target_date == on(3) and r.sentiment == 1 for r in rows)


def test_a_run_matches_weekend_news_once_the_bar_is_there(spark, tmp_path, model):  # noqa: F811
    store = Store(str(tmp_path))
    ingest(spark, store, "0", [("A", "a", day(0), "gain"), ("A", "b", day(1), "gain"), ("B", "c", day(0), "loss")])
    price = lambda s, *n: spark.createDataFrame([prices_message(s, n)], "symbol string, message string")
    jobs.ingest_prices(spark, store, price("A", 0), "0")
    assert jobs.run_day(spark, store, day(2), symbols(spark), model, max_gap=4)
    assert store.read(spark, "matched_days").count() == 0
    jobs.ingest_prices(spark, store, price("A", 3), "1")
    jobs.match_prices(spark, store, day(3), max_gap=4)
    matched = store.read(spark, "matched_days").collect()
    assert sorted((r.symbol, r.pub_date) for r in matched) == [("A", day(0)), ("A", day(1))]


@pytest.mark.parametrize("gap", [1, 4])
def test_empty_tables(spark, gap):
    assert matching.match_next_bar(news(spark), bars(spark, ("A", 1)), gap).count() == 0
    assert matching.match_next_bar(news(spark, ("A", 0)), bars(spark), gap).count() == 0

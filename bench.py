"""Headline queries, timed: one JSON line with seconds per query and their sum.

Every query runs once to warm up and then BENCH_RUNS times; the median counts. Results go
to Spark's no-op sink, so whole results are computed but none is collected.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newstide.plans.queries import QUERIES  # noqa: E402
from newstide.session import local_session, release  # noqa: E402

HEADLINES = [
    "daily_sentiment", "incremental_merge", "daily_bars", "latest_open", "missing_previous_day",
    "new_price_rows", "matched_dataset", "unmatched_days", "minmax_features", "serving_features",
    "open_high_regression", "forecast_linear", "article_guid", "distinct_articles", "unseen_articles",
    "open_news", "top_n_news", "nested_news", "news_feed_articles", "page_text", "tokens", "stems",
    "cleaned_text", "spell", "corrected_text", "nb_model", "bag_of_words", "nb_predict", "predicted_daily_sentiment",
    "trades_explode", "last_writes", "stream_trades", "stream_daily_sentiment",
]


def timed(spark, sf_dir, name):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    release(spark)
    return took


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    parallel = int(cores) if cores.isdigit() else 8
    spark = local_session(cores, shuffle_partitions=parallel, memory="16g")
    seconds = {}
    for name in only or HEADLINES:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

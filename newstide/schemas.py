"""Explicit schemas, in DDL, of every table and message. Nothing in the package infers one."""

from __future__ import annotations

# The shapes in which the feeds deliver their messages.
NEWS_FEED = (
    "data struct<main:struct<stream:array<struct<content:struct<"
    "title:string,pubDate:string,clickThroughUrl:struct<url:string>,previewUrl:string>>>>>"
)
PRICE_FEED = (
    "prices array<struct<date:bigint,open:double,high:double,low:double,close:double,volume:double>>"
)
TRADE_LIST_DDL = "array<struct<s:string,p:double,t:bigint,v:double>>"
TRADE_ENVELOPE = f"data {TRADE_LIST_DDL}, type string"

# Tables.
NEWS = "guid string, symbol string, pub_date date, title string, text string"
NEWS_ITEM_DDL = "struct<guid:string,_pubDate:string,_title:string,_symbol:string,_TextNew:string,is_new:int>"
PRICES = (
    "symbol string, bar_date date, open double, high double, low double, close double, volume double"
)
DAILY_COUNTS = "symbol string, pos_n bigint, neg_n bigint, pub_date date, batch_id string"
CLASSIFIED_NEWS = (
    "guid string, symbol string, margin double, sentiment string, pub_date date, batch_id string"
)
PROCESSED_NEWS = "guid string, pub_date date, batch_id string"
TRAINED_MODELS = "path string, run_date date, batch_id string"
DAY_SUMS = "n bigint, lows array<double>, highs array<double>, sums array<double>, pub_date date, batch_id string"
MATCHED_DAYS = "symbol string, articles bigint, pub_date date, batch_id string"
# a trade's position in the stream: when its message was sent, its part of the topic, its
# number there, and the trade's place in the message
POSITION = "struct<timestamp:timestamp,partition:int,offset:bigint,place:int>"
TRADES = (
    f"symbol string, ts timestamp, price double, volume double, seq {POSITION}, "
    "trade_date date, batch_id string"
)
TRADE_DAYS = f"symbol string, ts timestamp, price double, volume double, seq {POSITION}, trade_date date"
# batches of trades that a day's compacted trades hold
COMPACTED_DAYS = "through bigint, trade_date date, batch_id string"
WINDOW_BARS = (
    "symbol string, start timestamp, open double, high double, low double, close double, volume double, "
    "trades bigint, bar_date date, batch_id string"
)
LANDED_MESSAGES = "timestamp timestamp, partition int, offset bigint, value string"
PREDICTIONS = (
    "symbol string, target_date date, high double, low double, close double, volume double"
)

# A bar's figures.
BAR = ["open", "high", "low", "close", "volume"]

# The matched dataset as it is exchanged in CSV, and what models read and predict.
MATCHED_CSV = (
    "_pubDate string, symbol string, sentiment string, bullish_indicator double, "
    "bullish_indicator_all_posts double, agreement_indicator double, open double, "
    "high double, low double, close double, volume double"
)

FEATURES = [
    "sentiment",
    "bullish_indicator",
    "bullish_indicator_all_posts",
    "agreement_indicator",
    "open",
]
TARGETS = ["high", "low", "close", "volume"]

# Matched rows as they were taken in for training, by the run that matched them.
TRAINING_ROWS = f"{MATCHED_CSV}, run_date date, batch_id string"

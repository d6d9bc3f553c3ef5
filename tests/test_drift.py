import json

from pyspark.sql import functions as F

from newstide.schemas import NEWS_FEED, PRICE_FEED
from newstide.sources import drift

RECORD = {"date": 1, "open": 1.5, "high": 2, "low": 1.0, "close": 1e9, "volume": 3.0}


def landed(spark, tmp_path, *messages):
    rows = [("A", m if isinstance(m, str) or m is None else json.dumps(m)) for m in messages]
    drift.documents(spark.createDataFrame(rows, "symbol string, message string")).write.mode("overwrite").parquet(str(tmp_path / "d"))
    return spark.read.schema(drift.DOCUMENTS).parquet(str(tmp_path / "d"))


def found(frame, schema=PRICE_FEED):
    return {(r.path, r.problem): r.messages for r in drift.drift(frame, schema).collect()}


def test_messages_as_expected(spark, tmp_path):
    fields = [{k: v} for k, v in RECORD.items()]
    assert found(landed(spark, tmp_path, {"prices": [RECORD]}, {"prices": fields}, {"prices": []}, {}, {"prices": None})) == {}


def test_differences_by_path(spark, tmp_path):
    frame = landed(
        spark, tmp_path, {"prices": [RECORD, RECORD | {"split": {"to": 2, "from": [1]}}]}, {"prices": [RECORD | {"split": 2}]},
        {"prices": [RECORD | {"volume": "3"}]}, {"prices": {"date": 1}}, {"prices": [RECORD], "odd name, a: b": True}, "x", None,
        {"prices": [RECORD | {"volume": "3"}, RECORD]}, [1],
    )
    assert found(frame) == {
        ("$.prices[*].split", "unknown field"): 2, ("$.prices[*].volume", "text instead of number"): 1,
        ("$.prices", "object instead of list"): 1, ("$.odd name, a: b", "unknown field"): 1,
        ("$", "unreadable message"): 2, ("$.prices[*].volume", "other instead of number"): 1, ("$", "list instead of object"): 1,
    }


def test_a_new_field_loses_nothing(spark, tmp_path):
    frame = landed(spark, tmp_path, {"prices": [RECORD | {"split": 4}], "note": {"by": "é", "at": [1, {"x": None}]}})
    split = F.variant_get("document", "$.prices[0].split", "int")
    row = frame.select(split.alias("split"), F.to_json("document").alias("whole")).first()
    assert row.split == 4
    assert json.loads(row.whole) == {"prices": [RECORD | {"split": 4}], "note": {"by": "é", "at": [1, {"x": None}]}}


def test_nested_feeds_and_empty_tables(spark, tmp_path):
    item = {"content": {"title": "t", "pubDate": "d", "clickThroughUrl": {"url": "u", "site": "s"}, "previewUrl": None}}
    frame = landed(spark, tmp_path, {"data": {"main": {"stream": [item], "next": {"page": 2}}}})
    path = "$.data.main.stream[*].content.clickThroughUrl.site"
    assert found(frame, NEWS_FEED) == {(path, "unknown field"): 1, ("$.data.main.next", "unknown field"): 1}
    assert found(frame.where("false")) == {}
